"""Cleaning and normalising jobs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions.scalar import lowercase_columns, strip
from quarry.operators.keys import surrogate_key
from quarry.operators.profile import column_medians, column_modes, duplicate_count, null_counts
from quarry.operators.relational import columns_of_type, fill_constants


def impute_values(df: DataFrame, exact: bool = True) -> dict[str, object]:
    """The constants behind ``fillna``: text columns take their mode (tie ->
    smallest), numeric columns their median.  Two aggregate jobs whose
    results are one value per column (a bounded collect)."""
    text = columns_of_type(df, "string")
    nums = columns_of_type(df, "numeric")
    values: dict[str, object] = {}
    if text:
        for row in column_modes(df, text).collect():
            values[row["column_name"]] = row["mode_value"]
    if nums:
        for row in column_medians(df, nums, method="exact" if exact else "approx").collect():
            values[row["column_name"]] = row["median"]
    return values


def impute(df: DataFrame, values: Mapping[str, object] | None = None) -> DataFrame:
    """Fill missing values with the computed constants."""
    return fill_constants(df, impute_values(df) if values is None else values)


def strip_text(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """F2 over every text column (pandas ``str.strip`` semantics)."""
    cols = set(columns_of_type(df, "string") if cols is None else cols)
    return df.select(*[(strip(c) if c in cols else F.col(c)).alias(c) for c in df.columns])


def clean_table(df: DataFrame) -> DataFrame:
    """B1: lower-case names -> drop duplicate rows -> impute (mode / median,
    taken on the *unstripped* text) -> strip text.  Order as the reference."""
    lowered = lowercase_columns(df)
    deduped = lowered.dropDuplicates()
    filled = impute(deduped)
    return strip_text(filled)


def validate_clean(df: DataFrame) -> DataFrame:
    """Nulls left, duplicates left (stripping can re-create them) and shape,
    as one row."""
    nulls = null_counts(df).filter(F.col("column_name") == "*").select(F.col("n_null").alias("nulls_left"))
    dups = duplicate_count(df).select(F.col("n_rows"), F.col("n_duplicates").alias("duplicates_left"))
    return dups.select(
        F.col("n_rows"), F.lit(len(df.columns)).alias("n_cols"),
        nulls.select("nulls_left").scalar().alias("nulls_left"), F.col("duplicates_left"))


def normalize_tables(wide: DataFrame, parts: Mapping[str, Sequence[str]], order_by: Sequence[str],
                     key: str = "row_id") -> dict[str, DataFrame]:
    """B2: generate the shared key once on the wide rows (materialised inside
    ``surrogate_key``, so every part sees the same numbering), then project
    each vertical part."""
    keyed = surrogate_key(wide, order_by, key=key)
    return {name: keyed.select(key, *cols) for name, cols in parts.items()}


def store_bucketed(parts: Mapping[str, DataFrame], database: str, location: str, key: str = "row_id",
                   buckets: int | None = None) -> dict[str, DataFrame]:
    """Write each part as a table bucketed and sorted by the shared key, one
    file per bucket (``repartition`` by the same hash first).  Joins of these
    tables on the key then read co-partitioned, pre-sorted buckets: no
    shuffle and no sort at reassembly time, however often it runs."""
    spark = next(iter(parts.values())).sparkSession
    if buckets is None:
        # about a million rows per bucket, at most spark.sql.shuffle.partitions
        rows = next(iter(parts.values())).count()
        buckets = max(1, min(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // 1_000_000)))
    n = buckets
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{location}'")
    out = {}
    for name, df in parts.items():
        (df.repartition(n, key).write.bucketBy(n, key).sortBy(key)
         .option("path", f"{location}/{name}").saveAsTable(f"{database}.{name}"))
        out[name] = spark.table(f"{database}.{name}")
    return out


def reassemble(parts: Mapping[str, DataFrame], key: str = "row_id") -> DataFrame:
    """Inner joins of the vertical parts on the shared key (shuffle-free
    when the parts come from ``store_bucketed``)."""
    frames = list(parts.values())
    out = frames[0]
    for f in frames[1:]:
        out = out.join(f, key, "inner")
    return out
