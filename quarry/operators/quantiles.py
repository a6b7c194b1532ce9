"""Exact quantiles by radix selection (used by A6, A7, A11, A13, A14, B1, B6, P8).

Spark's exact ``percentile`` merges a value -> count map of the whole group in
one task, which grows with the group's distinct values.  Here every value gets a
64-bit key in the order of the values (``with_ordered_key``), and the key's digits of
16 bits are found one after the other, the first digit first:

1. count the values of every group by their first digit; the running counts
   (at most 65,536 a group) say which digit each wanted rank falls under, and
   its rank there;
2. count the values that share the digits found so far by their next digit, and
   so on.  When few enough values share them, the rest of the key is one digit.

Every round is one grouped count, with partial sums per task before the shuffle;
nothing is gathered but the wanted ranks of a group (two for every quantile).
After the first round only values under the wanted digits are counted, so the
later rounds are a scan and a filter.  The order statistics at floor(r) and
floor(r)+1, r = p*(n-1), are then interpolated like NumPy's ``linear`` method.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.session import materialize

DIGIT = 16
#: Wanted digits of so many groups are held as literal rows; more are written.
STATE_ROWS = 4096


def with_ordered_key(df: DataFrame, value: str, key: str) -> DataFrame:
    """``df`` with a long for every non-null double ``value``, in the order of the doubles:
    the bits of its absolute value, negated for a negative one.  The two zeros
    have one key; NaN comes last, as Spark sorts it.

    The steps are projections of their own, so that none is computed twice.
    """
    x = F.col(value)
    tiny = F.col("_a") < F.lit(2.0 ** -1022)
    whole = F.floor(F.log2(F.when(tiny | (F.col("_a") == float("inf")), F.lit(1.0)).otherwise(F.col("_a"))))
    steps = df.withColumn("_a", F.abs(x)).withColumn("_e", whole.cast("int"))
    # 2 ** (52 - e) in two factors, as it passes the largest double for small values.
    steps = steps.withColumn("_h", F.floor((F.lit(52) - F.col("_e")) / 2).cast("int")).withColumn(
        "_p", F.pow(F.lit(2.0), F.col("_h")))
    steps = steps.withColumn("_m", F.col("_a") * F.col("_p") * F.col("_p") * F.when(
        (F.lit(52) - F.col("_e")) % 2 == 0, F.lit(1.0)).otherwise(F.lit(2.0)))
    # log2 may round to the next whole number near a power of two.
    off = F.when(F.col("_m") >= F.lit(2.0 ** 53), 1).when(F.col("_m") < F.lit(2.0 ** 52), -1).otherwise(0)
    steps = steps.withColumn("_o", off)
    m = F.when(F.col("_o") > 0, F.col("_m") / 2).when(F.col("_o") < 0, F.col("_m") * 2).otherwise(F.col("_m"))
    normal = F.shiftleft((F.col("_e") + F.col("_o") + 1023).cast("long"), 52) + (m.cast("long") - F.lit(1 << 52))
    subnormal = (F.col("_a") * F.lit(2.0 ** 537) * F.lit(2.0 ** 537)).cast("long")
    steps = steps.withColumn("_s", F.when(F.isnan("_a"), F.lit(0x7FF8 << 48)).when(
        F.col("_a") == float("inf"), F.lit(0x7FF0 << 48)).when(tiny, subnormal).otherwise(normal))
    signed = F.when(x < 0, -F.col("_s")).otherwise(F.col("_s"))
    # Never null for a value; said so, or a join on it would compute it once more as a filter.
    return steps.select(*df.columns, F.coalesce(signed, F.lit(0).cast("long")).alias(key))


def _lerp(a: Column, b: Column, t: Column) -> Column:
    """NumPy's ``_lerp``: a + (b-a)t, evaluated from b when t >= 0.5."""
    d = b - a
    return F.when(t >= 0.5, b - d * (F.lit(1.0) - t)).otherwise(a + d * t)


def _found(counts: DataFrame, by: Sequence[str]) -> DataFrame:
    """The digits under which wanted ranks fall.  ``counts``: by..., the digits so
    far (``above``), ``digit``, ``cnt``, ``low`` (smallest value) and ``want``, the
    group's wanted ``(t, rank)``."""
    so_far = Window.partitionBy(*by, "above").orderBy("digit")
    run = counts.withColumn("upto", F.sum("cnt").over(so_far))
    before = F.col("upto") - F.col("cnt")
    own = F.transform(F.filter("want", lambda w: (w["rank"] >= before) & (w["rank"] < F.col("upto"))),
                      lambda w: F.struct(w["t"].alias("t"), (w["rank"] - before).alias("rank")))
    return run.withColumn("want", own).where(F.size("want") > 0)


def _held(state: DataFrame) -> tuple[DataFrame, int, bool]:
    """``state`` computed once, the largest count in it, and whether it is small:
    as literal rows if it has few, as a table otherwise."""
    # Sorted, as a plain limit tries one partition after the other.
    rows = state.orderBy("above").limit(STATE_ROWS + 1).collect()
    if len(rows) <= STATE_ROWS:
        return (state.sparkSession.createDataFrame(rows, state.schema), max((r["cnt"] for r in rows), default=0), True)
    written = materialize(state, "quantile_digits")
    return written, written.agg(F.max("cnt")).first()[0], False


def exact_quantiles(df: DataFrame, value: str, probs: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """(by..., n, q) with ``q[i]`` the exact linear-interpolated quantile
    ``probs[i]`` of the non-null values of ``value`` per group.  A NULL group is a
    group."""
    by = [f"_g{i}" for i in range(len(by))] if (names := list(by)) else []
    probs = [float(p) for p in probs]
    x = df.select(*[F.col(c).alias(g) for c, g in zip(names, by)], F.col(value).cast("double").alias("_x"))
    x = with_ordered_key(x.where(F.col("_x").isNotNull()), "_x", "_key")

    # The first digit; a group's count gives the ranks it wants.
    shift = 64 - DIGIT
    first = x.groupBy(*by, F.shiftright("_key", shift).alias("digit")).agg(F.count("*").alias("cnt"), F.min("_x").alias("low"))
    n = F.sum("cnt").over(Window.partitionBy(*by))
    p = F.array(*[F.lit(v) for v in probs])
    rank = F.transform(p, lambda v: F.floor(v * (F.col("n") - 1)).cast("long"))
    wanted = F.flatten(F.transform(rank, lambda r, i: F.array(
        F.struct((2 * i).alias("t"), r.alias("rank")),
        F.struct((2 * i + 1).alias("t"), F.least(r + 1, F.col("n") - 1).alias("rank")))))
    state = _found(first.withColumn("n", n).select("*", F.lit(0).cast("long").alias("above"), wanted.alias("want")), by)
    state = state.select(*by, "n", F.col("digit").alias("above"), "cnt", "low", "want")
    held, most, small = _held(state)
    while shift > 0:
        # Few values left: the rest of the key is one digit.
        step = shift if most <= 1 << DIGIT else DIGIT
        side = held.select(*[F.col(g).alias(f"s{g}") for g in by], F.col("above").alias("sabove"), "n", "want")
        side = F.broadcast(side) if small else side

        def wanted_by(prefix: Column) -> Column:
            return reduce(and_, (F.col(g).eqNullSafe(F.col(f"s{g}")) for g in by), prefix == F.col("sabove"))

        left = x.join(side.drop("n", "want"), wanted_by(F.shiftright("_key", shift)))
        rest = F.shiftright("_key", shift - step) - F.shiftleft(F.col("sabove"), step)
        counts = left.groupBy(*by, F.col("sabove").alias("above"), rest.alias("digit")).agg(
            F.count("*").alias("cnt"), F.min("_x").alias("low"))
        # The wanted ranks come to the counted digits, not to the values.
        counts = counts.join(side, wanted_by(F.col("above"))).select(*by, "above", "digit", "cnt", "low", "n", "want")
        state = _found(counts, by).select(
            *by, "n", (F.shiftleft("above", step) + F.col("digit")).alias("above"), "cnt", "low", "want")
        shift -= step
        if shift:
            held, most, small = _held(state)
    # One value under every key: its smallest.
    per = state.select(*by, "n", F.explode("want").alias("w"), "low").groupBy(*by, "n").agg(
        F.map_from_entries(F.collect_list(F.struct("w.t", "low"))).alias("v"))
    r = F.transform(p, lambda v: v * (F.col("n") - 1))
    q = F.transform(r, lambda v, i: _lerp(F.col("v")[2 * i], F.col("v")[2 * i + 1], v - F.floor(v)))
    return per.select(*[F.col(g).alias(c) for g, c in zip(by, names)], "n", q.alias("q"))
