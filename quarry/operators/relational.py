"""Projections, filters, joins and small relational helpers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def is_numeric(dt: T.DataType) -> bool:
    return isinstance(dt, T.NumericType)


def columns_of_type(df: DataFrame, kind: str) -> list[str]:
    """Column names by family: ``numeric`` or ``string`` (pandas ``object``)."""
    if kind == "numeric":
        return [f.name for f in df.schema.fields if is_numeric(f.dataType)]
    if kind == "string":
        return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    raise ValueError(f"unknown column kind {kind!r}")


def select_by_type(df: DataFrame, kind: str) -> DataFrame:
    return df.select(*columns_of_type(df, kind))


def optional_filters(df: DataFrame, equals: Mapping[str, object] | None = None,
                     at_most: Mapping[str, object] | None = None) -> DataFrame:
    """Add one conjunct per *truthy* argument: ``None``, ``''`` and ``0`` mean
    "no filter", exactly like ``if specialty:`` / ``if max_fee:``.  ``<=``
    drops NULL values as SQL does."""
    out = df
    for col, value in (equals or {}).items():
        if value:
            out = out.filter(F.col(col) == F.lit(value))
    for col, value in (at_most or {}).items():
        if value:
            out = out.filter(F.col(col) <= F.lit(value))
    return out


def key_lookup(df: DataFrame, col: str, value) -> DataFrame:
    """Rows of one key; ``value`` may be a literal or a scalar-subquery Column."""
    v = value if isinstance(value, Column) else F.lit(value)
    return df.filter(F.col(col) == v)


def key_lookup_sql(df: DataFrame, col: str, value) -> DataFrame:
    """P6 as SQL with a bound parameter -- the prepared-statement form
    (``WHERE col = ?``) without string concatenation of the value."""
    return df.sparkSession.sql(f"SELECT * FROM {{t}} WHERE `{col}` = :k", args={"k": value}, t=df)


def filter_project(df: DataFrame, predicate: Column, *cols: str) -> DataFrame:
    return df.filter(predicate).select(*cols)


def override_column(df: DataFrame, col: str, value) -> DataFrame:
    """Scenario copy: one column set to a constant, type kept."""
    dtype = df.schema[col].dataType
    return df.withColumn(col, F.lit(value).cast(dtype))


def apply_defaults(df: DataFrame, schema: T.StructType, defaults: Mapping[str, object]) -> DataFrame:
    """Conform ``df`` to ``schema``: a column that is *absent* gets its default
    (or NULL); an explicit NULL that is present stays NULL, as in SQL."""
    cols = []
    for f in schema.fields:
        if f.name in df.columns:
            cols.append(F.col(f.name).cast(f.dataType).alias(f.name))
        else:
            cols.append(F.lit(defaults.get(f.name)).cast(f.dataType).alias(f.name))
    return df.select(*cols)


def fill_constants(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Replace NULL (and NaN for floating columns) with per-column constants."""
    out = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if f.name in values and values[f.name] is not None:
            missing = c.isNull()
            if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
                missing = missing | F.isnan(c)
            c = F.when(missing, F.lit(values[f.name]).cast(f.dataType)).otherwise(c)
        out.append(c.alias(f.name))
    return df.select(*out)


def fk_orphans(child: DataFrame, parent: DataFrame, fk: str | Sequence[str],
               pk: str | Sequence[str] | None = None) -> DataFrame:
    """Child rows whose (non-null) foreign key has no parent row.

    A left-anti join: the parent side is reduced to its distinct keys, so a
    hot child key never meets more than one parent row.
    """
    fks = [fk] if isinstance(fk, str) else list(fk)
    pks = fks if pk is None else ([pk] if isinstance(pk, str) else list(pk))
    keys = parent.select(*[F.col(p).alias(f"_pk{i}") for i, p in enumerate(pks)]).distinct()
    cond = [F.col(f) == F.col(f"_pk{i}") for i, f in enumerate(fks)]
    nonnull = F.lit(True)
    for f in fks:
        nonnull = nonnull & F.col(f).isNotNull()
    return child.filter(nonnull).join(keys, cond, "left_anti")


def conflict_counts(requests: DataFrame, held: DataFrame, keys: Sequence[str],
                    status_col: str = "status", cancelled: str = "Cancelled",
                    id_col: str = "request_id") -> DataFrame:
    """Per request, the number of held rows on the same keys whose status is
    ``!= cancelled`` (3-valued: a NULL status does not count)."""
    active = (
        held.filter(F.col(status_col) != F.lit(cancelled))
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("n_conflicts"))
    )
    return (
        requests.select(id_col, *keys)
        .join(active, list(keys), "left")
        .select(id_col, *keys, F.coalesce("n_conflicts", F.lit(0)).alias("n_conflicts"))
    )
