import pandas as pd
import pytest
from pyspark.sql import functions as F

from quarry.ml import features as mf

ROWS = [(1, "b", "x"), (2, "a", None), (3, None, "y"), (4, "c", "x"), (4, "c", "x"), (5, "", "z")]


@pytest.mark.parametrize("bound", [0, 200_000])
def test_equals_get_dummies(spark, monkeypatch, bound):
    monkeypatch.setattr(mf, "BROADCAST_LEVELS", bound)
    df = spark.createDataFrame(ROWS, "id int, u string, w string")
    got = sorted((r.id, r.features.toArray().tolist()) for r in mf.one_hot_sparse(df).collect())
    frame = pd.DataFrame(ROWS, columns=["id", "u", "w"])
    want = pd.get_dummies(frame, columns=["u", "w"], drop_first=True, dtype=float)
    assert got == sorted((i, v) for i, *v in want.itertuples(index=False) for v in [list(v)])


def test_columns_without_a_kept_level_and_unseen_levels(spark):
    df = spark.createDataFrame([(1, "only", None), (2, None, None)], "id int, u string, w string")
    assert [r.features.size for r in mf.one_hot_sparse(df).collect()] == [0, 0]
    assert mf.one_hot_sparse(df.limit(0)).count() == 0
    seen = spark.createDataFrame(ROWS, "id int, u string, w string")
    levels = mf.level_dictionary(seen, ["u", "w"])
    row = mf.one_hot_sparse(df.filter("id = 1"), ["u", "w"], levels=levels).first()
    assert row.features.size == 5 and row.features.numNonzeros() == 0


def test_a_million_levels(spark):
    df = spark.range(1_000_000).select("id", F.format_string("v%07d", "id").alias("u"), F.lit("k").alias("w"))
    out = mf.one_hot_sparse(df, ["u", "w"]).withColumn("v", F.unwrap_udt("features"))
    got = out.agg(F.count_if(F.size("v.indices") == 0).alias("none"), F.min("v.size").alias("size"), F.count_if(
        (F.size("v.indices") == 1) & (F.get("v.indices", F.lit(0)) == F.col("id") - 1)).alias("right")).first()
    assert (got["none"], got["size"], got["right"]) == (1, 999_999, 999_999)
