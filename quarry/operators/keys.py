"""Consecutive surrogate keys without a one-partition window.

A global ``row_number() OVER (ORDER BY ..)`` moves every row into a single
task.  Instead:

1. range-partition by the order (plus a tie-break that lets Spark split a
   run of identical rows across partitions, so a hot value cannot pin one
   task) and sort inside each partition;
2. number rows inside each partition (``monotonically_increasing_id`` keeps
   the partition id in its upper 31 bits, so the lower bits are the local
   position) and freeze this by writing the numbered rows as a parquet table
   in the shared checkpoint folder, so a lost executor cannot renumber
   anything (one pass; a reliable RDD checkpoint would compute it twice);
3. count rows per partition -- one row per partition, a proven bound -- turn
   the counts into offsets and broadcast them back.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.session import checkpoint_root, scratch_path


def _asc(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).asc_nulls_first()


def surrogate_key(df: DataFrame, order_by: Sequence[str | Column], key: str = "row_id",
                  start: int | Column = 1, num_partitions: int | None = None) -> DataFrame:
    """Add ``key`` = start, start+1, ... in ``order_by`` order (nulls first).

    ``start`` may be a scalar-subquery Column such as ``max(id) + 1`` of an
    existing table.  Rows equal in every ``order_by`` column get distinct,
    arbitrary keys among themselves.
    """
    spark = df.sparkSession
    checkpoint_root(spark)
    order = [_asc(c) for c in order_by] + [F.col("_qk_tie").asc()]
    tied = df.withColumn("_qk_tie", F.monotonically_increasing_id())
    # without an explicit count AQE sizes the range partitions from the data
    # (coalescing keeps them contiguous and in order, which the numbering needs)
    ranged = tied.repartitionByRange(num_partitions, *order) if num_partitions else tied.repartitionByRange(*order)
    numbered = (
        ranged
        .sortWithinPartitions(*order)
        .withColumn("_qk_part", F.spark_partition_id())
        .withColumn("_qk_pos", F.monotonically_increasing_id()
                    - F.shiftleft(F.spark_partition_id().cast("bigint"), 33))
        .drop("_qk_tie")
    )
    path = scratch_path(spark, "surrogate_key")
    numbered.write.parquet(path)
    numbered = spark.read.parquet(path)
    sizes = numbered.groupBy("_qk_part").agg(F.count(F.lit(1)).alias("_qk_n"))
    offsets = sizes.select(
        "_qk_part",
        (F.sum("_qk_n").over(Window.orderBy("_qk_part").rowsBetween(Window.unboundedPreceding, -1)))
        .alias("_qk_off"),
    ).fillna(0, subset=["_qk_off"])
    start_col = start if isinstance(start, Column) else F.lit(start)
    return (
        numbered.join(F.broadcast(offsets), "_qk_part")
        .withColumn(key, (start_col + F.col("_qk_off") + F.col("_qk_pos")).cast("bigint"))
        .drop("_qk_part", "_qk_pos", "_qk_off")
    )
