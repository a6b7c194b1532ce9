"""Feature engineering."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.operators.keys import surrogate_key
from quarry.operators.relational import columns_of_type
from quarry.session import materialize, ship_package

#: A column's dictionary is broadcast up to this many levels.
BROADCAST_LEVELS = 200_000


def category_levels(df: DataFrame, cols: Sequence[str], max_levels: int = 10_000) -> dict[str, list[str]]:
    """Distinct non-null levels per text column, sorted.  One distinct job;
    the result is bounded by the category cardinality, and an encoding that
    would need more than ``max_levels`` columns is refused (a wide one-hot of
    a high-cardinality column is not a sensible frame)."""
    long = df.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in cols
    ]))).filter(F.col("value").isNotNull()).distinct()
    rows = long.limit(max_levels + 1).collect()
    if len(rows) > max_levels:
        raise ValueError(f"more than {max_levels} category levels in {list(cols)}")
    levels: dict[str, list[str]] = {c: [] for c in cols}
    for r in rows:
        levels[r["column_name"]].append(r["value"])
    return {c: sorted(v) for c, v in levels.items()}


def dummy_name(col: str, level: str) -> str:
    return f"{col}_{level}"


def one_hot_drop_first(df: DataFrame, text_cols: Sequence[str] | None = None,
                       levels: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """M1: ``pd.get_dummies(df, drop_first=True)`` in wide form: every other
    column first, in order, then ``{col}_{level}`` 0/1 columns for each text
    column, the alphabetically first level dropped.  NULL text gives all 0."""
    text_cols = list(text_cols) if text_cols is not None else columns_of_type(df, "string")
    levels = dict(levels) if levels is not None else category_levels(df, text_cols)
    keep = [c for c in df.columns if c not in text_cols]
    dummies = [
        F.when(F.col(c) == F.lit(v), 1).otherwise(0).alias(dummy_name(c, v))
        for c in text_cols for v in sorted(levels[c])[1:]
    ]
    return df.select(*keep, *dummies)


def dummy_columns(levels: Mapping[str, Sequence[str]], text_cols: Sequence[str]) -> list[str]:
    return [dummy_name(c, v) for c in text_cols for v in sorted(levels[c])[1:]]


def level_dictionary(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``column_index, column_name, value, feature_index`` of every level, as a written
    table: levels in alphabetical order by column, numbered from 0 without a column's
    first, whose ``feature_index`` is NULL.  Numbering is distributed (see ``keys``)."""
    long = df.select(F.inline(F.array(*[
        F.struct(F.lit(i).alias("column_index"), F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value"))
        for i, c in enumerate(cols)]))).filter(F.col("value").isNotNull()).distinct()
    numbered = materialize(surrogate_key(long, ["column_index", "value"], "place", start=0), "levels")
    # One row per column that has levels: its first place, and how many columns up to it.
    firsts = {r["column_index"]: r["place"] for r in
              numbered.groupBy("column_index").agg(F.min("place").alias("place")).collect()}
    passed = F.lit(0)
    first = F.lit(False)
    for i, place in firsts.items():
        passed = passed + (F.col("column_index") >= i).cast("int")
        first = first | (F.col("place") == place)
    return numbered.select("column_index", "column_name", "value",
                           F.when(~first, F.col("place") - passed).cast("int").alias("feature_index"))


def one_hot_sparse(df: DataFrame, text_cols: Sequence[str] | None = None, output: str = "features",
                   levels: DataFrame | None = None) -> DataFrame:
    """M1: ``get_dummies(drop_first=True)`` with one sparse vector column in place of
    the text columns.  The dictionary is a joined table of any size (broadcast only
    up to ``BROADCAST_LEVELS`` counted levels); each text column is one join of its
    own, so rows are never regrouped.  NULL, a column's first level and a level that
    a given ``levels`` table lacks are all zero."""
    text_cols = list(text_cols) if text_cols is not None else columns_of_type(df, "string")
    levels = levels if levels is not None else level_dictionary(df, text_cols)
    counted = {r["column_name"]: (r["n"], r["top"]) for r in levels.groupBy("column_name").agg(
        F.count(F.lit(1)).alias("n"), F.max("feature_index").alias("top")).collect()}
    size = 1 + max((top for _, top in counted.values() if top is not None), default=-1)
    out = df
    for i, c in enumerate(text_cols):
        side = levels.filter((F.col("column_name") == c) & F.col("feature_index").isNotNull()).select(
            F.col("value").alias(f"_level{i}"), F.col("feature_index").alias(f"_index{i}"))
        if counted.get(c, (0, None))[0] <= BROADCAST_LEVELS:
            side = F.broadcast(side)
        out = out.join(side, F.col(c).cast("string") == F.col(f"_level{i}"), "left").drop(f"_level{i}")
    held = F.array_sort(F.array_compact(F.array(*[F.col(f"_index{i}") for i in range(len(text_cols))])))
    vector = F.struct(F.lit(0).cast("byte").alias("type"), F.lit(size).alias("size"), held.alias("indices"),
                      F.transform(held, lambda _: F.lit(1.0)).alias("values"))
    keep = [c for c in df.columns if c not in text_cols]
    rows = out.select(*keep, vector.alias(output))
    ship_package(df.sparkSession)
    # The struct is a vector's storage as it is; the pass only gives it the vector's type.
    schema = T.StructType([*rows.schema.fields[:-1], T.StructField(output, VectorUDT())])
    return rows.mapInArrow(_as_is, schema)


def _as_is(batches):
    yield from batches


def assemble(df: DataFrame, feature_cols: Sequence[str], label: str, keep: Sequence[str] = ()) -> DataFrame:
    """M2: target split from the features; a ``features`` vector whose
    metadata keeps the column names."""
    va = VectorAssembler(inputCols=list(feature_cols), outputCol="features", handleInvalid="error")
    return va.transform(df).select(*keep, "features", F.col(label).cast("double").alias("label"))


def _draw(key: str, seed: int, n: int) -> Column:
    """A number below ``n`` from the first 32 bits of an MD5 of seed and key: the
    same on any partitioning, cluster size or SQL engine."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))
    return F.pmod(F.conv(F.substring(digest, 1, 8), 16, 10).cast("long"), F.lit(n))


def split_column(df: DataFrame, key: str, test_percent: int = 20, seed: int = 42) -> DataFrame:
    """M3: seeded 80/20 split by a hash of the row key -- the same rows on any
    partitioning or cluster size (``randomSplit`` depends on partitioning)."""
    return df.withColumn("split", F.when(_draw(key, seed, 100) < test_percent, "test").otherwise("train"))


def fold_column(df: DataFrame, key: str, k: int = 5, seed: int = 7) -> DataFrame:
    """Fold number 0..k-1 by a hash of the row key (for CV and stacking)."""
    return df.withColumn("fold", _draw(key, seed, k).cast("int"))
