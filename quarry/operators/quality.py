"""Constraint checks as data.

Every rule yields violation rows ``(table_name, rule, row_key, column_name,
bad_value, n)`` so a load can quarantine instead of abort.  Row rules run in
one scan per table: each row carries an array of candidate violations that is
filtered and exploded (``inline``); group rules (unique, primary key) are
grouped aggregates whose map-side combine absorbs a hot key.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.spec import TableSpec

VIOLATION_COLS = ["table_name", "rule", "row_key", "column_name", "bad_value", "n"]


def _key(key_cols: Sequence[str]) -> Column:
    return F.concat_ws("|", *[F.col(k).cast("string") for k in key_cols]) if key_cols else F.lit(None)


def _row_rules(df: DataFrame, table: str, key_cols: Sequence[str],
               rules: list[tuple[str, str, Column]]) -> DataFrame:
    """``rules`` = (rule, column, violated?) evaluated in one pass."""
    key = _key(key_cols)
    cands = F.array(*[
        F.when(bad, F.struct(F.lit(rule).alias("rule"), F.lit(col).alias("column_name"),
                             F.col(col).cast("string").alias("bad_value")))
        for rule, col, bad in rules
    ])
    return (
        df.select(key.alias("row_key"), F.filter(cands, lambda x: x.isNotNull()).alias("_v"))
        .filter(F.size("_v") > 0)
        .select(F.lit(table).alias("table_name"), "row_key", F.inline("_v"))
        .select(*VIOLATION_COLS[:-1], F.lit(1).cast("bigint").alias("n"))
    )


def check_not_null(df: DataFrame, table: str, cols: Sequence[str], key_cols: Sequence[str]) -> DataFrame:
    """C1."""
    return _row_rules(df, table, key_cols, [("not_null", c, F.col(c).isNull()) for c in cols])


def check_range(df: DataFrame, table: str, ranges: Mapping[str, tuple[float, float]],
                key_cols: Sequence[str]) -> DataFrame:
    """``NOT (c BETWEEN lo AND hi)``; NULL passes, as in a SQL CHECK."""
    return _row_rules(df, table, key_cols,
                      [("range", c, ~F.col(c).between(lo, hi)) for c, (lo, hi) in ranges.items()])


def check_min(df: DataFrame, table: str, minimums: Mapping[str, float], key_cols: Sequence[str]) -> DataFrame:
    """``c >= minimum``."""
    return _row_rules(df, table, key_cols, [("min", c, F.col(c) < F.lit(m)) for c, m in minimums.items()])


def check_unique(df: DataFrame, table: str, cols: Sequence[str], rule: str = "unique") -> DataFrame:
    """C4: a (composite) value present more than once; NULLs are exempt."""
    cols = list(cols)
    nonnull = df
    for c in cols:
        nonnull = nonnull.filter(F.col(c).isNotNull())
    dup = nonnull.groupBy(*cols).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
    return dup.select(
        F.lit(table).alias("table_name"), F.lit(rule).alias("rule"), F.lit(None).cast("string").alias("row_key"),
        F.lit(",".join(cols)).alias("column_name"), _key(cols).alias("bad_value"), F.col("n"),
    )


def check_primary_key(df: DataFrame, table: str, key_cols: Sequence[str]) -> DataFrame:
    """The key is not null (per row) and unique (per key value)."""
    nulls = _row_rules(df, table, key_cols, [("pk_not_null", c, F.col(c).isNull()) for c in key_cols])
    return nulls.unionByName(check_unique(df, table, key_cols, rule="pk_unique"))


def check_spec(df: DataFrame, spec: TableSpec, key_cols: Sequence[str] | None = None) -> DataFrame:
    """Every rule of a ``TableSpec`` over one table, as one violation frame."""
    key_cols = list(key_cols or spec.primary_key)
    rules = [("not_null", c, F.col(c).isNull()) for c in spec.not_null]
    rules += [("range", c, ~F.col(c).between(lo, hi)) for c, (lo, hi) in spec.ranges.items()]
    rules += [("min", c, F.col(c) < F.lit(m)) for c, m in spec.minimums.items()]
    out = _row_rules(df, spec.name, key_cols, rules) if rules else None
    parts = [check_unique(df, spec.name, [c]) for c in spec.unique]
    if spec.primary_key and not spec.generated_key:
        parts.append(check_primary_key(df, spec.name, list(spec.primary_key)))
    for p in parts:
        out = p if out is None else out.unionByName(p)
    return out


def reconcile_counts(targets: Mapping[str, DataFrame], source: DataFrame) -> DataFrame:
    """Each target's row count against the source's."""
    src = source.select(F.count(F.lit(1))).scalar()
    parts = [
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
        for name, df in targets.items()
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("source_rows", src).withColumn("matches", F.col("n_rows") == F.col("source_rows"))
