"""Column types of a text file from its values.

A field is one of five kinds, each a bit: truth value, integer, number, other
text, missing.  The kinds a column holds are the ``bit_or`` of its fields, so one
aggregate over one scan folds every column, in any order and partitioning, and
nothing but one row of bits reaches the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.sources.io import PANDAS_NA_TOKENS, read_csv

BOOLEAN, INTEGER, NUMBER, TEXT, MISSING = 1, 2, 4, 8, 16
#: The spellings pandas.read_csv takes for truth values.
TRUE_TOKENS, FALSE_TOKENS = ["True", "TRUE", "true"], ["False", "FALSE", "false"]
_INTEGER = r"^[ \t]*[+-]?[0-9]+[ \t]*$"
_NUMBER = r"^[ \t]*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?[ \t]*$"
_INFINITY = r"(?i)^[+-]?inf(inity)?$"


def kind(value: Column, null_tokens: Sequence[str] = PANDAS_NA_TOKENS) -> Column:
    """The kind of one text field.  An integer beyond 64 bits is text, as turning it
    into a number would change it."""
    whole = F.when(value.try_cast("bigint").isNotNull(), INTEGER).otherwise(TEXT)
    missing = value.isNull() | value.isin(list(null_tokens)) if null_tokens else value.isNull()
    return (F.when(missing, MISSING).when(value.rlike(_INTEGER), whole)
            .when(value.rlike(_NUMBER) | value.rlike(_INFINITY), NUMBER)
            .when(value.isin(TRUE_TOKENS + FALSE_TOKENS), BOOLEAN).otherwise(TEXT))


def type_of(kinds: int) -> T.DataType:
    """The narrowest type that holds every kind: integers widen to numbers, any
    other mixture is text; a column without values is a number.  Missing values
    are nulls and widen nothing (pandas makes integers with gaps floats and truth
    values with gaps objects)."""
    held = kinds & ~MISSING
    if held in (0, NUMBER, NUMBER | INTEGER):
        return T.DoubleType()
    return {INTEGER: T.LongType(), BOOLEAN: T.BooleanType()}.get(held, T.StringType())


def scan_text(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """Every field as text, an empty one as NULL; columns named by the header."""
    return (spark.read.option("header", True).option("sep", sep).option("inferSchema", False)
            .option("mode", "FAILFAST").csv(path))


def infer_schema(text: DataFrame, null_tokens: Sequence[str] = PANDAS_NA_TOKENS) -> T.StructType:
    """The schema of a frame of text columns, by one aggregate over all its rows."""
    found = text.agg(*[F.bit_or(kind(F.col(f"`{c}`"), null_tokens)).alias(f"k{i}")
                       for i, c in enumerate(text.columns)]).first()
    return T.StructType([T.StructField(c, type_of(k or 0)) for c, k in zip(text.columns, found)])


def read_csv_inferred(spark: SparkSession, path: str, sep: str = ",",
                      null_tokens: Sequence[str] = PANDAS_NA_TOKENS) -> DataFrame:
    """A header CSV whose types come from all its values: two scans, one for the
    types and one, prunable, for the rows."""
    return read_csv(spark, path, infer_schema(scan_text(spark, path, sep), null_tokens), sep, null_tokens)


def type_report(text: DataFrame, null_tokens: Sequence[str] = PANDAS_NA_TOKENS) -> DataFrame:
    """``column_name, data_type, n_rows, n_missing`` per column, in one scan."""
    spark = text.sparkSession
    aggs = [F.count(F.lit(1)).alias("n")]
    for i, c in enumerate(text.columns):
        k = kind(F.col(f"`{c}`"), null_tokens)
        aggs += [F.bit_or(k).alias(f"k{i}"), F.count_if(k == MISSING).alias(f"m{i}")]
    row = text.agg(*aggs).first()
    out = [(c, type_of(row[f"k{i}"] or 0).simpleString(), row["n"], row[f"m{i}"]) for i, c in enumerate(text.columns)]
    return spark.createDataFrame(out, "column_name string, data_type string, n_rows bigint, n_missing bigint")
