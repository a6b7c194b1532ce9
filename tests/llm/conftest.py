import pytest
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                     T.StructField("n_chars", T.LongType())])


def frame(spark, texts, ids=None, lang="en"):
    ids = list(range(len(texts))) if ids is None else ids
    return spark.createDataFrame([(i, t, lang, "s", None if t is None else len(t)) for i, t in zip(ids, texts)], DOCS)


@pytest.fixture(scope="session")
def edge(spark):
    """Nulls in any column, empty and long texts, ties, repeated rows."""
    base = " ".join(f"w{i} Common" for i in range(40))
    other = base.replace("w7 ", "changed ")
    texts = [None, "", "   \n\t", "one two", base, other, base, "x\n" + base + "\nshared license line\n" + "é" * 30,
             "Shared License Line \n mail a.b@c.de, +1 (234) 555-6789 and 10.0.0.300 or 10.0.0.25 4111 1111 1111 1111",
             "a " * 5000, "same words here again", "same words here again"]
    docs = frame(spark, [*texts, "orphan text without any id", "orphan text without any id"],
                 [*range(10), 10, 10, None, None])
    return docs.withColumns({"n_words": docs["doc_id"], "th": docs["text"], "doc": docs["lang"]})


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], DOCS)
