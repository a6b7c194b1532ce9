"""Scans, sinks and table management.

Inputs are paths (the reference downloads a zip first; that network step is
not rebuilt).  Writes are set-based; a row loop never appears.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.spec import TableSpec

# The strings pandas.read_csv treats as missing by default.
PANDAS_NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]


def read_csv(spark: SparkSession, path: str, schema: T.StructType, sep: str = ",",
             null_tokens: Sequence[str] = PANDAS_NA_TOKENS) -> DataFrame:
    """Header CSV with an explicit schema.

    Every field is scanned as text, the pandas missing-value tokens become
    NULL (``nullValue`` accepts one token only), then each column is cast to
    its declared type; a malformed number fails in ANSI mode as ``int()``
    would.  Column pruning and filters above still reach the scan.
    """
    text_schema = T.StructType([T.StructField(f.name, T.StringType(), True) for f in schema.fields])
    raw = (
        spark.read.option("header", True).option("sep", sep).option("nullValue", None)
        .option("emptyValue", "").option("mode", "FAILFAST").schema(text_schema).csv(path)
    )
    tokens = list(null_tokens)
    cols = []
    for f in schema.fields:
        c = F.col(f.name)
        c = F.when(c.isin(tokens), F.lit(None)).otherwise(c) if tokens else c
        cols.append(c.cast(f.dataType).alias(f.name))
    return raw.select(*cols)


def write_csv(df: DataFrame, path: str, sep: str = ",", mode: str = "overwrite") -> str:
    """S3: a header CSV without an index column (a directory of parts)."""
    df.write.mode(mode).option("header", True).option("sep", sep).csv(path)
    return path


def land_raw(spark: SparkSession, src_path: str, raw_path: str, sep: str = ",") -> DataFrame:
    """Keep an untouched copy: the source read as text and written once
    (``errorifexists``: a landed copy is never rewritten)."""
    raw = spark.read.option("header", True).option("sep", sep).option("inferSchema", False).csv(src_path)
    raw.write.mode("errorifexists").parquet(raw_path)
    return spark.read.parquet(raw_path)


def create_tables(spark: SparkSession, specs: Iterable[TableSpec], database: str,
                  location: str) -> list[str]:
    """``CREATE TABLE IF NOT EXISTS .. USING parquet`` per spec, with
    column DEFAULTs; keys and checks become validation jobs (quality.py)."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{location}'")
    names = []
    for spec in specs:
        spark.sql(spec.ddl().replace(f"TABLE IF NOT EXISTS {spec.name}",
                                     f"TABLE IF NOT EXISTS {database}.{spec.name}"))
        names.append(f"{database}.{spec.name}")
    return names


def conform(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Columns of ``spec`` in order and type; absent ones take their default."""
    cols = []
    for f in spec.schema.fields:
        if f.name in df.columns:
            cols.append(F.col(f.name).cast(f.dataType).alias(f.name))
        else:
            cols.append(F.lit(spec.defaults.get(f.name)).cast(f.dataType).alias(f.name))
    return df.select(*cols)


def overwrite_reload(tables: Sequence[tuple[str, DataFrame]]) -> None:
    """Replace the content of each table, parents first, so a reload is
    idempotent (the reference deletes child-first and keeps counting ids)."""
    for name, df in tables:
        df.write.mode("overwrite").insertInto(name, overwrite=True)


def bulk_append(name: str, df: DataFrame) -> None:
    """Set-based insert."""
    df.write.insertInto(name)


def list_tables(spark: SparkSession, database: str, required: Sequence[str]) -> DataFrame:
    """The catalog's tables against a required list."""
    present = {t.name for t in spark.catalog.listTables(database)}
    rows = [(name, name in present) for name in required]
    return spark.createDataFrame(rows, "table_name string, present boolean")


def day_spine(df: DataFrame, ts_col: str) -> DataFrame:
    """One row per calendar day between the first and last day of
    ``ts_col`` (``sequence`` + ``explode`` with column bounds), numbered from 1."""
    bounds = df.agg(F.min(F.to_date(ts_col)).alias("lo"), F.max(F.to_date(ts_col)).alias("hi"))
    return bounds.select(F.explode(F.sequence("lo", "hi")).alias("day"), "lo").select(
        (F.datediff("day", "lo") + 1).alias("day_index"), "day")


def integer_range(spark: SparkSession, start: int, stop: int) -> DataFrame:
    """S10 with literal bounds: ``range(start, stop)``."""
    return spark.range(start, stop).withColumnRenamed("id", "value")
