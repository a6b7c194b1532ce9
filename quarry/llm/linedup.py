"""Line dedup across documents, by range-partitioned line hashes.

Each line becomes ``(128-bit key hash, doc_id, position)``; its text does not
travel.  The hashes are range-partitioned and sorted by hash, document and
position, as one written run per partition.  The range bounds are on the whole
sort key, so a line that a third of the documents share is cut over many runs
like any other.  The first document of every key is a grouped minimum over the
runs, joined back to them; the order inside a run is not used for it.  Later holders of a key become bits
of sparse 64-line words; a document's bitmap is the list of its non-zero words.

Defined results: a null or empty text is one empty line; rows without a
``doc_id`` count as one document after all others; rows that repeat another row
keep and lose the same lines; a text that loses all its lines becomes empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import SPACES, ascii_lower, materialize, with_text_hash

MIN_CHARS = 10


def line_index(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """One row per line with a key of at least ``min_chars`` code points, in
    sorted runs (a written table)."""
    lines = with_text_hash(docs).select("doc_id", "th", F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n"))
                                        .alias("pos", "line"))
    lines = lines.select("doc_id", "th", "pos", F.btrim("line", F.lit(SPACES)).alias("key"))
    lines = lines.where(F.char_length("key") >= min_chars).withColumn("key", ascii_lower(F.col("key")))
    lines = lines.select(F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(11), F.col("key")).alias("h2"),
                         "doc_id", "th", "pos")
    # Written first, so that the range sampling reads hashes and not texts.
    lines = materialize(lines, "line_hashes")
    order = ["h1", "h2", "doc_id", "th", "pos"]
    return materialize(lines.repartitionByRange(*order).sortWithinPartitions(*order), "line_runs")


def drop_bitmaps(runs: DataFrame) -> DataFrame:
    """``doc_id, th, words, n_dropped``: the dropped lines of each document that
    has any, as sorted ``(word, bits)`` pairs; all other lines are kept."""
    first = (runs.groupBy("h1", "h2").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"),
                                          F.count("*").alias("n"), F.count("doc_id").alias("named"))
             .where("first < last or (named < n and named > 0)").select("h1", "h2", "first"))
    # Written, so that the join reads plain exchanges and a hot line's key splits.
    drop = runs.join(materialize(first, "first_holders"), ["h1", "h2"]).where("doc_id is null or doc_id > first")
    words = (drop.groupBy("doc_id", "th", F.shiftright("pos", 6).alias("word"))
             .agg(F.bit_or(F.expr("shiftleft(1L, pos % 64)")).alias("bits")))
    return words.groupBy("doc_id", "th").agg(
        F.sort_array(F.collect_list(F.struct("word", "bits"))).alias("words"),
        F.sum(F.bit_count("bits")).cast("long").alias("n_dropped"))


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame, text: str = "kept_text") -> DataFrame:
    """``docs`` with the kept text, the number of lines and of dropped lines."""
    a = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), "doc_id",
                    F.xxhash64("text").alias("th"), F.coalesce("text", F.lit("")).alias("t"))
    b = bitmaps.select(F.col("doc_id").alias("b_id"), F.col("th").alias("b_th"), "words", "n_dropped")
    a = a.join(b, a["doc_id"].eqNullSafe(b["b_id"]) & (a["th"] == b["b_th"]), "left")
    zeros = F.lit(0).cast("long")
    a = a.withColumn("dense", F.when(F.col("words").isNotNull(), F.flatten(F.transform("words", lambda e, i: F.concat(
        F.array_repeat(zeros, e["word"] - F.coalesce(F.get("words", i - 1)["word"], F.lit(-1)) - 1),
        F.array(e["bits"]))))))
    kept = F.when(F.col("dense").isNull(), F.col("t")).otherwise(F.array_join(F.filter(
        F.split("t", "\n"), lambda x, i: F.getbit(F.coalesce(F.get("dense", F.shiftright(i, 6)), zeros),
                                                  F.pmod(i, F.lit(64))) == 0), "\n"))
    return a.select("doc", kept.alias(text), F.size(F.split("t", "\n")).cast("long").alias("n_lines"),
                    F.coalesce("n_dropped", zeros).alias("n_dropped"))


def line_dedup(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """``doc_id, n_lines, n_dropped, kept_sha256`` of every document."""
    docs = docs.select("doc_id", "text")
    out = apply_bitmaps(docs, materialize(drop_bitmaps(line_index(docs, min_chars)), "line_bitmaps"))
    return out.select("doc.doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def drop_lines(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """``docs`` with repeated lines gone from ``text`` (a null text stays null);
    ``n_chars`` follows if there is such a column."""
    out = apply_bitmaps(docs, materialize(drop_bitmaps(line_index(docs.select("doc_id", "text"), min_chars)),
                                          "line_bitmaps"))
    out = out.select("doc", F.when(F.col("doc.text").isNotNull(), F.col("kept_text")).alias("new_text"))
    cols = []
    for f in docs.schema.fields:
        c = F.col(f"doc.`{f.name}`")
        if f.name == "text":
            c = F.col("new_text")
        elif f.name == "n_chars":
            c = F.char_length("new_text").cast(f.dataType)
        cols.append(c.alias(f.name))
    return out.select(*cols)
