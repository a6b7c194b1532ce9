"""Helpers shared by the training-data operators.

Rows of ``documents`` are told apart by ``(doc_id, text hash)``: repeated rows
share that key and get the same result, and a null or repeated ``doc_id`` never
multiplies rows in a join.
"""

from __future__ import annotations

import ctypes
from functools import wraps

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.session import materialize, ship_package

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()
#: ``[\x20\x09-\x0D]`` as characters and as a Java pattern of a run of them.
SPACES = " \t\n\x0b\x0c\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"

#: A side is broadcast only when its written table has at most this many rows
#: and bytes; beyond that the same join shuffles.
BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 48_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(c: Column) -> Column:
    """A-Z to a-z, every other character as it is.

    ``lower`` does exactly that on a text of ASCII alone, at memory speed.
    """
    return F.when(F.octet_length(c) == F.char_length(c), F.lower(c)).otherwise(F.translate(c, UPPER, LOWER))


def words_of(c: Column, separators: str = SPACE_RUN) -> Column:
    """Words of a text (null: none) split at runs of ``separators``."""
    return F.array_remove(F.split(F.coalesce(c, F.lit("")), separators), "")


def with_text_hash(docs: DataFrame, name: str = "th") -> DataFrame:
    return docs.select("doc_id", "text", F.xxhash64("text").alias(name))


def small_side(df: DataFrame, row_bytes: int = 48) -> DataFrame:
    """``df`` (a written table) with a broadcast hint if its counted rows, at
    ``row_bytes`` each, stay under the bound; unhinted otherwise."""
    most = min(BROADCAST_ROWS, BROADCAST_BYTES // row_bytes)
    return F.broadcast(df) if df.count() <= most else df


def null_safe(left: DataFrame, right: DataFrame, *names: str) -> Column:
    cond = None
    for n in names:
        c = left[n].eqNullSafe(right[n])
        cond = c if cond is None else cond & c
    return cond


def total(c: Column) -> Column:
    """Sum of an array of integers, as a long."""
    return F.aggregate(c, F.lit(0).cast("long"), lambda acc, x: acc + x)


__all__ = ["LOWER", "SPACES", "SPACE_RUN", "UPPER", "ascii_lower", "materialize", "null_safe", "ship_package", "small_side",
           "table", "total", "with_text_hash", "words_of"]


def give_back() -> None:
    """Free memory of this Python worker back to the machine: workers outlive a
    task, and what its allocators keep comes on top of the next stage's."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not glibc
        pass


def giving_back(work):
    """``work``, an iterator of batches to batches, with ``give_back`` at its end."""

    @wraps(work)
    def run(batches):
        yield from work(batches)
        give_back()

    return run
