"""Shared ids and repeated rows in near-duplicate detection."""

from tests.llm.conftest import frame
from tests.llm.test_operators import rows

from quarry.llm import neardup

A = " ".join(f"alpha{i}" for i in range(40))
B = " ".join(f"beta{i}" for i in range(40))
C = " ".join(f"gamma{i}" for i in range(40))


def test_rows_that_share_an_id_are_one_document(spark):
    docs = frame(spark, [A, A, B, B.replace("beta20", "x"), C, C, None], [1, 5, 5, 9, 3, 3, 9])
    got = {(r["doc_id"], r["n_shingles"]): r["component_id"] for r in neardup.near_duplicates(docs).collect()}
    assert got == {(1, 36): 1, (5, 36): 1, (9, 36): 1, (3, 36): 3, (9, 0): 9}


def test_keep_one_keeps_one_of_equal_rows(spark):
    docs = frame(spark, [A, A, A, B, B, C, C + " more", A, None, None], [1, 1, 2, 4, 4, 6, 6, None, 8, 8])
    got = [(r["doc_id"], r["text"]) for r in neardup.keep_one(docs).collect()]
    assert sorted(got, key=repr) == sorted([(1, A), (4, B), (6, C), (6, C + " more"), (None, A), (8, None)], key=repr)
    assert neardup.keep_one(docs).columns == docs.columns


def test_keep_one_of_an_empty_table(spark, nothing):
    assert rows(neardup.keep_one(nothing)) == []
