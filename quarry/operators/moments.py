"""Pairwise-complete co-moments of many columns in one scan.

A plan with one covariance per pair has p² expressions, which generated code
cannot hold for a wide table.  Here a block of rows becomes two matrices, the
values ``x`` (0 where missing) and the mask ``m``; four matrix products give the
count, sums, squares and products of every pair over the rows where both are
present.  They are kept as central moments, so that blocks and tasks merge
without cancellation, and travel as one row per column and task.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.session import ship_package

#: Columns of the matrix computed by one scan; a task holds 6 * 8 bytes for each of
#: them and each column.
BLOCK = 512
#: Values of a row block.
VALUES = 1 << 21
#: Tasks' rows of one column are added in this many groups first.
SALTS = 64
PARTS = ("n", "mx", "my", "sxx", "syy", "sxy")
STATE = "i int, salt int, " + ", ".join(f"{p} array<double>" for p in PARTS)


def block_moments(x: np.ndarray, rows: slice) -> list[np.ndarray]:
    """``n, mean x, mean y, Sxx, Syy, Sxy`` of columns ``rows`` (x) against all (y)."""
    m = ~np.isnan(x)
    count = m.sum(0)
    filled = np.where(m, x, 0.0)
    shift = filled.sum(0) / np.maximum(count, 1)
    # A column of one value has no rounding left in its differences.
    lo, hi = np.where(m, x, np.inf).min(0), np.where(m, x, -np.inf).max(0)
    shift = np.where(lo == hi, lo, shift)
    d = np.where(m, x - shift, 0.0)
    m = m.astype(np.float64)
    n = m[:, rows].T @ m
    k = np.maximum(n, 1)
    sx, sy = d[:, rows].T @ m, m[:, rows].T @ d
    qx, qy = (d[:, rows] ** 2).T @ m, m[:, rows].T @ d ** 2
    sxx, syy = qx - sx * sx / k, qy - sy * sy / k
    # Rounding of a pair whose present values are all equal.
    sxx[sxx < 1e-14 * qx], syy[syy < 1e-14 * qy] = 0.0, 0.0
    return [n, shift[rows, None] + sx / k, shift[None, :] + sy / k, sxx, syy, d[:, rows].T @ d - sx * sy / k]


def merge(a: list[np.ndarray] | None, b: list[np.ndarray]) -> list[np.ndarray]:
    """The moments of two disjoint sets of rows as those of their union."""
    if a is None:
        return b
    n = a[0] + b[0]
    k = np.maximum(n, 1)
    # A side without rows has no mean to differ from.
    both = (a[0] > 0) & (b[0] > 0)
    dx, dy = np.where(both, b[1] - a[1], 0.0), np.where(both, b[2] - a[2], 0.0)
    w = a[0] * b[0] / k
    mx = np.where(a[0] > 0, a[1], b[1]) + dx * b[0] / k
    my = np.where(a[0] > 0, a[2], b[2]) + dy * b[0] / k
    return [n, mx, my, a[3] + b[3] + dx * dx * w, a[4] + b[4] + dy * dy * w, a[5] + b[5] + dx * dy * w]


def _scan(lo: int, hi: int):
    def run(batches):
        state = None
        part = TaskContext.get().partitionId()
        for b in batches:
            step = max(1, VALUES // b.num_columns)
            for at in range(0, b.num_rows, step):
                piece = b.slice(at, step)
                x = np.column_stack([c.to_numpy(zero_copy_only=False).astype(np.float64) for c in piece.columns])
                with np.errstate(invalid="ignore"):
                    state = merge(state, block_moments(x, slice(lo, hi)))
        if state is not None:
            for i in range(lo, hi):
                yield pa.RecordBatch.from_pydict(
                    {"i": pa.array([i], pa.int32()), "salt": pa.array([part % SALTS], pa.int32())}
                    | {p: pa.array([s[i - lo]], pa.list_(pa.float64())) for p, s in zip(PARTS, state)})

    return run


def _add(rows: pa.Table) -> pa.Table:
    state = None
    for r in range(rows.num_rows):
        with np.errstate(invalid="ignore"):
            state = merge(state, [np.asarray(rows.column(p)[r].values, np.float64) for p in PARTS])
    return pa.Table.from_pydict(
        {"i": pa.array([rows.column("i")[0].as_py()], pa.int32()), "salt": pa.array([0], pa.int32())}
        | {p: pa.array([s], pa.list_(pa.float64())) for p, s in zip(PARTS, state)})


def co_moments(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``i, j, n, mx, my, sxx, syy, sxy`` of every pair of column positions: count,
    means and central moments over the rows where both are present (NaN counts as
    missing).  One scan for up to ``BLOCK`` columns, one more for each further
    block.  No rows for an empty table."""
    spark = df.sparkSession
    ship_package(spark)
    x = df.select(*[F.col(c).cast("double").alias(f"c{k}") for k, c in enumerate(cols)])
    out = None
    for lo in range(0, len(cols), BLOCK):
        tasks = x.mapInArrow(_scan(lo, min(lo + BLOCK, len(cols))), STATE)
        some = tasks.groupBy("i", "salt").applyInArrow(_add, STATE)
        rows = some.groupBy("i").applyInArrow(_add, STATE)
        out = rows if out is None else out.unionByName(rows)
    return out.select("i", F.posexplode(F.arrays_zip(*PARTS)).alias("j", "s")).select("i", "j", "s.*")


def correlation(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pearson r of every pair, pairwise-complete, long form (``col_a, col_b,
    r``) with both orders and the diagonal.  NULL where fewer than two rows have
    both values, where either is constant on those rows, for a column that holds
    an infinite value, and everywhere on an empty table."""
    cols = list(cols)
    moments = co_moments(df, cols)
    names = F.array(*[F.lit(c) for c in cols])
    r = F.try_divide("sxy", F.sqrt("sxx") * F.sqrt("syy"))
    r = F.when(F.col("i") == F.col("j"), F.lit(1.0)).otherwise(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), r)))
    finite = ~F.isnan("sxx") & ~F.isnan("syy") & ~F.isnan("sxy")
    known = moments.select(
        "i", "j", F.when((F.col("n") > 1) & (F.col("sxx") > 0) & (F.col("syy") > 0) & finite, r).alias("r"))
    pairs = df.sparkSession.range(len(cols)).select(
        F.col("id").cast("int").alias("i"),
        F.explode(F.sequence(F.lit(0), F.lit(len(cols) - 1))).alias("j"))
    return pairs.join(known, ["i", "j"], "left").select(
        F.element_at(names, F.col("i") + 1).alias("col_a"), F.element_at(names, F.col("j") + 1).alias("col_b"), "r")
