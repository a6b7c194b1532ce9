"""Profiling aggregates.

Rules kept throughout: one scan per family of statistics (all columns in one
``agg``), long result forms through ``explode(array(struct))``, and no
per-value collection into the driver.  Frequency questions (mode, value
counts) are grouped aggregates, so map-side partial aggregation absorbs a hot
value before the shuffle.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.operators.moments import correlation
from quarry.operators.quantiles import exact_quantiles
from quarry.operators.relational import columns_of_type
from quarry.session import materialize

#: Fences of up to this many groups are broadcast.
BROADCAST_GROUPS = 200_000


def _long(df: DataFrame, structs: list[Column]) -> DataFrame:
    """One wide aggregate row -> one row per struct."""
    return df.select(F.inline(F.array(*structs)))


# ---------------------------------------------------------------- counts ----

def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """A1: row count per table, one ``unionByName`` of one-row aggregates."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
        for name, df in tables.items()
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _missing(df: DataFrame, name: str) -> Column:
    c = F.col(name)
    dt = df.schema[name].dataType
    if isinstance(dt, (T.DoubleType, T.FloatType)):
        return c.isNull() | F.isnan(c)
    return c.isNull()


def null_counts(df: DataFrame, with_total: bool = True) -> DataFrame:
    """A3: missing values per column (NULL, and NaN for floating columns, as
    pandas ``isnull`` counts them), plus a ``*`` row with the total."""
    aggs = [F.count_if(_missing(df, c)).alias(f"n{i}") for i, c in enumerate(df.columns)]
    wide = df.agg(*aggs)
    structs = [F.struct(F.lit(c).alias("column_name"), F.col(f"n{i}").alias("n_null"))
               for i, c in enumerate(df.columns)]
    if with_total:
        total = sum((F.col(f"n{i}") for i in range(len(df.columns))), F.lit(0).cast("bigint"))
        structs.append(F.struct(F.lit("*").alias("column_name"), total.alias("n_null")))
    return _long(wide, structs)


def duplicate_count(df: DataFrame) -> DataFrame:
    """A4: rows beyond the first of each group of equal rows (NULL equals
    NULL, NaN equals NaN), in one grouped aggregate."""
    groups = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n"))
    return groups.agg(
        F.sum("_n").cast("bigint").alias("n_rows"),
        F.count(F.lit(1)).alias("n_distinct"),
        F.sum(F.col("_n") - 1).cast("bigint").alias("n_duplicates"),
    )


def distinct_rows(df: DataFrame) -> DataFrame:
    """D1."""
    return df.dropDuplicates()


# ---------------------------------------------------------- frequencies ----

def column_modes(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """A5: most frequent non-null value per column; a tie goes to the smallest
    value.  Values are compared as text, so use it on text columns (typed
    single-column variant: ``mode_of``)."""
    cols = list(cols) if cols is not None else columns_of_type(df, "string")
    long = _long(df, [F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value"))
                      for c in cols]).filter(F.col("value").isNotNull())
    counts = long.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))
    best = counts.groupBy("column_name").agg(F.min(F.struct((-F.col("n")).alias("neg_n"), "value")).alias("m"))
    return best.select("column_name", F.col("m.value").alias("mode_value"), (-F.col("m.neg_n")).alias("mode_count"))


def mode_of(df: DataFrame, col: str) -> DataFrame:
    """Typed mode of one column: one row ``(mode_value, mode_count)``."""
    counts = df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    m = counts.agg(F.min(F.struct((-F.col("n")).alias("neg_n"), F.col(col).alias("v"))).alias("m"))
    return m.select(F.col("m.v").alias("mode_value"), (-F.col("m.neg_n")).alias("mode_count"))


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """Frequency of each non-null value, most frequent first."""
    return (
        df.filter(F.col(col).isNotNull())
        .groupBy(col)
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.desc("count"), F.asc(col))
    )


def category_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Counts behind several bar charts, long form (column, value, count)."""
    long = _long(df, [F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value"))
                      for c in cols]).filter(F.col("value").isNotNull())
    return long.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("count"))


def table_profile(df: DataFrame) -> DataFrame:
    """A10: per column type and non-null count, with table shape."""
    wide = df.agg(F.count(F.lit(1)).alias("_rows"),
                  *[F.count(F.col(c)).alias(f"nn{i}") for i, c in enumerate(df.columns)])
    structs = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(f.name).alias("column_name"),
            F.lit(f.dataType.simpleString()).alias("data_type"),
            F.col(f"nn{i}").alias("non_null"),
        )
        for i, f in enumerate(df.schema.fields)
    ]
    ncols = len(df.columns)
    return wide.select("_rows", F.inline(F.array(*structs))).select(
        "position", "column_name", "data_type", "non_null",
        F.col("_rows").alias("n_rows"), F.lit(ncols).alias("n_cols"))


# ------------------------------------------------------------ quantiles ----

def quantile_columns(col: str, probs: Sequence[float], exact: bool = True,
                     accuracy: int = 100_000) -> Column:
    """Aggregate expression: array of quantiles (linear interpolation).
    ``exact=True`` is Spark's ``percentile`` (its merge state grows with the
    group's distinct values -- fine for low-cardinality columns);
    ``exact=False`` is the bounded ``percentile_approx`` sketch.  Whole-table
    exact quantiles go through ``quantiles`` instead."""
    arr = F.array(*[F.lit(float(p)) for p in probs])
    if exact:
        return F.percentile(F.col(col), arr)
    return F.percentile_approx(F.col(col), arr, accuracy).cast("array<double>")


def quantiles(df: DataFrame, col: str, probs: Sequence[float], by: Sequence[str] = (),
              method: str = "exact", accuracy: int = 10_000) -> DataFrame:
    """(by..., n, q array) per group.  ``exact``: radix selection
    (``operators.quantiles``); ``approx``: one-pass sketch."""
    if method == "exact":
        return exact_quantiles(df, col, probs, by)
    x = F.col(col).cast("double")
    data = df.filter(x.isNotNull())
    agg = [F.count(F.lit(1)).alias("n"), quantile_columns(col, probs, exact=(method == "percentile")).alias("q")]
    return data.groupBy(*by).agg(*agg) if by else data.agg(*agg)


def _long_values(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column_name, x) for every value of ``cols`` -- lets many columns share
    one grouped quantile job."""
    return _long(df, [F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("x")) for c in cols])


def describe_numeric(df: DataFrame, cols: Sequence[str] | None = None, method: str = "exact") -> DataFrame:
    """Count, mean, sample std, min, quartiles, max per numeric column;
    moments in one aggregate pass, quartiles of all columns in one grouped
    quantile job over the unpivoted values; long form, one row per column."""
    cols = list(cols) if cols is not None else columns_of_type(df, "numeric")
    aggs = []
    for i, c in enumerate(cols):
        x = F.col(c).cast("double")
        aggs += [
            F.count(x).alias(f"n{i}"), F.avg(x).alias(f"mean{i}"), F.stddev_samp(x).alias(f"std{i}"),
            F.min(x).alias(f"min{i}"), F.max(x).alias(f"max{i}"),
        ]
    wide = df.agg(*aggs)
    structs = [
        F.struct(
            F.lit(c).alias("column_name"), F.col(f"n{i}").alias("count"), F.col(f"mean{i}").alias("mean"),
            F.col(f"std{i}").alias("std"), F.col(f"min{i}").alias("min"), F.col(f"max{i}").alias("max"),
        )
        for i, c in enumerate(cols)
    ]
    q = quantiles(_long_values(df, cols), "x", [0.25, 0.5, 0.75], by=["column_name"], method=method)
    return _long(wide, structs).join(q.drop("n"), "column_name", "left").select(
        "column_name", "count", "mean", "std", "min", F.col("q")[0].alias("p25"), F.col("q")[1].alias("p50"),
        F.col("q")[2].alias("p75"), "max")


def column_medians(df: DataFrame, cols: Sequence[str], method: str = "exact") -> DataFrame:
    """Median per column (nulls skipped), long form."""
    names = df.sparkSession.createDataFrame([(c,) for c in cols], "column_name string")
    q = quantiles(_long_values(df, cols), "x", [0.5], by=["column_name"], method=method)
    return F.broadcast(names).join(q, "column_name", "left").select(
        "column_name", F.col("q")[0].alias("median"))


# ------------------------------------------------------------ histogram ----

def _numpy_auto_bins(n: int, lo: float, hi: float, q25: float, q75: float) -> int:
    """NumPy's ``bins='auto'``: the smaller of the Sturges and
    Freedman-Diaconis widths (FD only when it is non-zero)."""
    ptp = hi - lo
    sturges = ptp / (math.log2(n) + 1.0)
    fd = 2.0 * (q75 - q25) * n ** (-1.0 / 3.0)
    width = min(fd, sturges) if fd else sturges
    return int(math.ceil(ptp / width)) if width else 1


def histogram(df: DataFrame, col: str, bins: int | str = "auto", exact: bool = True) -> DataFrame:
    """Bin counts of ``col`` the way ``numpy.histogram`` forms them:
    equal-width bins over [min, max], the maximum falls in the last bin, empty
    bins are reported with count 0.

    Pass 1 is one aggregate row (n, min, max, quartiles); pass 2 bins every
    value with built-in arithmetic and counts per bin.
    """
    x = F.col(col).cast("double")
    stats = df.filter(x.isNotNull()).agg(F.count(x).alias("n"), F.min(x).alias("lo"), F.max(x).alias("hi")).first()
    if stats is None or not stats["n"]:
        return df.sparkSession.createDataFrame([], "bin int, lo double, hi double, count bigint")
    lo, hi = float(stats["lo"]), float(stats["hi"])
    if lo == hi:
        lo, hi = lo - 0.5, hi + 0.5
    if bins == "auto":
        q = quantiles(df, col, [0.25, 0.75], method="exact" if exact else "approx").first()["q"]
        k = _numpy_auto_bins(int(stats["n"]), lo, hi, float(q[0]), float(q[1]))
    else:
        k = int(bins)
    step = (hi - lo) / k
    norm = k / (hi - lo)

    def edge(i: Column) -> Column:
        return F.when(i == k, F.lit(hi)).otherwise(i.cast("double") * F.lit(step) + F.lit(lo))

    v = F.col("x")
    guess = F.least(F.floor((v - F.lit(lo)) * F.lit(norm)).cast("int"), F.lit(k - 1))
    binned = (
        df.select(x.alias("x")).filter(F.col("x").isNotNull())
        .withColumn("b", guess.alias("b"))
        .withColumn("b", F.when(v < edge(F.col("b")), F.col("b") - 1)
                    .when((v >= edge(F.col("b") + 1)) & (F.col("b") != k - 1), F.col("b") + 1)
                    .otherwise(F.col("b")))
    )
    counts = binned.groupBy("b").agg(F.count(F.lit(1)).alias("count"))
    all_bins = df.sparkSession.range(k).select(F.col("id").cast("int").alias("b"))
    return (
        all_bins.join(counts, "b", "left")
        .select(F.col("b").alias("bin"), edge(F.col("b")).alias("lo"), edge(F.col("b") + 1).alias("hi"),
                F.coalesce("count", F.lit(0).cast("bigint")).alias("count"))
    )


# ------------------------------------------------------------------ KDE ----

#: Terms of the kernel's expansion.  Cells are half a bandwidth wide, so a value lies
#: at most d = 1/4 bandwidth from its cell's centre, and by Cramer's bound on Hermite
#: polynomials the terms left out add less than 2 * d^15 / sqrt(15!) < 2e-15 of a
#: kernel's height for each value.
KDE_TERMS = 15
KDE_CELL = 0.5
#: A cell reaches this many bandwidths: beyond, a kernel is below 3e-18.
KDE_REACH = 9.0


def kde_curve(df: DataFrame, col: str, gridsize: int = 200, cut: float = 3.0,
              bw_adjust: float = 1.0) -> DataFrame:
    """Gaussian KDE with Scott's bandwidth ``std * n**(-1/5)`` on a grid
    from ``min - cut*bw`` to ``max + cut*bw`` (seaborn/scipy defaults).

    A fast Gauss transform: the rows of a cell are replaced by the sums of the
    powers of their distance to the cell's centre (a grouped aggregate, partial
    sums per task), and cells, not rows, add their Hermite expansion to the grid
    points they reach.  Nulls and NaN are left out; no values, a constant column
    or an infinite value give no rows.
    """
    x = F.col(col).cast("double")
    data = df.select(x.alias("x")).filter(F.col("x").isNotNull() & ~F.isnan("x"))
    s = data.agg(F.count("x").alias("n"), F.stddev_samp("x").alias("sd"),
                 F.min("x").alias("lo"), F.max("x").alias("hi")).first()
    if s is None or not s["n"] or not s["sd"] or not math.isfinite(s["sd"]):
        return df.sparkSession.createDataFrame([], "grid_index int, x double, density double")
    n, sd = int(s["n"]), float(s["sd"])
    bw = sd * (n ** (-1.0 / 5.0)) * bw_adjust
    lo, hi = float(s["lo"]), float(s["hi"])
    gmin, gmax = lo - bw * cut, hi + bw * cut
    step = (gmax - gmin) / (gridsize - 1)
    norm = 1.0 / (n * bw * math.sqrt(2 * math.pi))

    # Rows to cells: u is the place in bandwidths, d the distance to the centre.
    u = (F.col("x") - F.lit(lo)) / F.lit(bw)
    cells = data.select(u.alias("u")).withColumn("cell", F.floor(F.col("u") / F.lit(KDE_CELL)))
    cells = cells.select("cell", (F.col("u") - (F.col("cell") + 0.5) * KDE_CELL).alias("d"))
    power, sums = F.lit(1.0), []
    for k in range(KDE_TERMS):
        sums.append(F.sum(power).alias(f"p{k}"))
        power = power * F.col("d")
    moments = cells.groupBy("cell").agg(*sums)

    # Cells to grid points: sum of p_k He_k(t) / k!, times the kernel at t.
    centre = (F.col("cell") + 0.5) * KDE_CELL
    first = F.ceil((centre - KDE_REACH) * F.lit(bw / step) + F.lit((lo - gmin) / step))
    last = F.floor((centre + KDE_REACH) * F.lit(bw / step) + F.lit((lo - gmin) / step))
    first, last = F.greatest(first, F.lit(0)), F.least(last, F.lit(gridsize - 1))
    reached = moments.filter(first <= last).withColumn("grid_index", F.explode(F.sequence(first.cast("int"), last.cast("int"))))
    point = F.when(F.col("grid_index") == gridsize - 1, F.lit(gmax)).otherwise(F.col("grid_index") * step + gmin)
    reached = reached.withColumn("t", (point - F.lit(lo)) / F.lit(bw) - centre)
    # h_k = He_k(t) / k! by its recurrence, packed with its predecessor and the sum.
    p = F.array(*[F.col(f"p{k}") for k in range(KDE_TERMS)])
    start = F.struct(F.lit(0.0).alias("before"), F.lit(1.0).alias("h"), F.col("p0").alias("total"))

    def term(acc: Column, k: Column) -> Column:
        h = (F.col("t") * acc["h"] - acc["before"]) / k
        return F.struct(acc["h"].alias("before"), h.alias("h"),
                        (acc["total"] + F.element_at(p, k + 1) * h).alias("total"))

    series = F.aggregate(F.sequence(F.lit(1), F.lit(KDE_TERMS - 1)), start, term)["total"]
    density = reached.select("grid_index", (F.exp(-0.5 * F.col("t") * F.col("t")) * series).alias("k"))
    # Points that no cell reaches have a density of 0.
    grid = df.sparkSession.range(0, gridsize, 1, 1).select(F.col("id").cast("int").alias("grid_index"), F.lit(0.0).alias("k"))
    density = density.unionAll(grid).groupBy("grid_index").agg(F.sum("k").alias("k"))
    return density.select("grid_index", point.alias("x"), (F.col("k") * F.lit(norm)).alias("density"))


# ------------------------------------------------------------ box stats ----

def box_stats(df: DataFrame, col: str, by: Sequence[str] = (), whis: float = 1.5,
              exact: bool = True) -> DataFrame:
    """Quartiles, whiskers (last data inside 1.5 IQR) and outlier
    counts, optionally per group.  Quartiles are one grouped aggregate, written once;
    the fences (one row per group) are broadcast to the rows and a second grouped
    aggregate finds whiskers and outliers."""
    by = list(by)
    x = F.col(col).cast("double")
    data = df.select(*by, x.alias("_x")).filter(F.col("_x").isNotNull())
    q = quantiles(data, "_x", [0.25, 0.5, 0.75], by=by, method="exact" if exact else "approx").select(
        *by, "n", F.col("q")[0].alias("q1"), F.col("q")[1].alias("median"), F.col("q")[2].alias("q3"))
    q = q.withColumn("iqr", F.col("q3") - F.col("q1")) \
         .withColumn("lo_fence", F.col("q1") - F.lit(whis) * F.col("iqr")) \
         .withColumn("hi_fence", F.col("q3") + F.lit(whis) * F.col("iqr"))
    if not by:
        # global box: the fences are one row, applied as literals
        row = q.first()
        if row is None:
            return q.select(*q.columns, *[F.lit(None).cast(t).alias(c) for c, t in _WHISKER_TYPES])
        return q.select(*q.columns, *_whisker_aggs(data, row["lo_fence"], row["hi_fence"]))
    q, fences = _fences(q, by)
    joined = data.join(fences, by, "inner")
    w = joined.groupBy(*by).agg(*_whisker_exprs(F.col("lo_fence"), F.col("hi_fence")))
    return q.join(w, by, "inner")


_WHISKER_TYPES = [("whisker_lo", "double"), ("whisker_hi", "double"),
                  ("n_out_low", "bigint"), ("n_out_high", "bigint")]


def _whisker_exprs(lo: Column, hi: Column) -> list[Column]:
    x = F.col("_x")
    return [
        F.min(F.when(x >= lo, x)).alias("whisker_lo"),
        F.max(F.when(x <= hi, x)).alias("whisker_hi"),
        F.count_if(x < lo).alias("n_out_low"),
        F.count_if(x > hi).alias("n_out_high"),
    ]


def _fences(q: DataFrame, by: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """``q``, one row per group, computed once, and its fences to join rows with.
    Rows are not dealt out by group for it, as a few groups would make a few large
    tasks: the fences are broadcast up to ``BROADCAST_GROUPS`` groups."""
    q = materialize(q, "fences")
    fences = q.select(*by, "lo_fence", "hi_fence")
    return q, F.broadcast(fences) if q.count() <= BROADCAST_GROUPS else fences


def _whisker_aggs(data: DataFrame, lo: float, hi: float) -> list[Column]:
    row = data.agg(*_whisker_exprs(F.lit(lo), F.lit(hi))).first()
    return [F.lit(row[c]).cast(t).alias(c) for c, t in _WHISKER_TYPES]


def box_outliers(df: DataFrame, col: str, by: Sequence[str] = (), whis: float = 1.5) -> DataFrame:
    """The outlier rows behind ``box_stats`` (second frame of A13/A14)."""
    by = list(by)
    stats = box_stats(df, col, by, whis)
    x = F.col(col).cast("double")
    if not by:
        row = stats.first()
        return df.filter((x < F.lit(row["lo_fence"])) | (x > F.lit(row["hi_fence"])))
    _, fences = _fences(stats, by)
    joined = df.join(fences, by, "inner")
    return joined.filter((x < F.col("lo_fence")) | (x > F.col("hi_fence"))).drop("lo_fence", "hi_fence")


# ---------------------------------------------------------- correlation ----

#: Up to this many columns the pairs are written out as one aggregate's expressions.
NARROW = 8


def correlation_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pearson r for every pair, pairwise-complete, long form with both
    orders and the diagonal; one scan however many columns.  NaN is missing.
    NULL where fewer than two rows have both values, where either is constant on
    those rows and for a column that holds an infinite value.

    A few columns are one aggregate of built-in functions; the p² expressions of a
    wide table would outgrow generated code, so it goes by matrix products of row
    blocks (see ``moments``)."""
    cols = list(cols)
    if len(cols) > NARROW:
        return correlation(df, cols)
    aggs, pairs = [], []
    x = df.select(*[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(cols)])
    x = x.select(*[F.when(~F.isnan(c), F.col(c)).alias(c) for c in x.columns])
    for i, a in enumerate(cols):
        for j, b in enumerate(cols[i:], i):
            xa, xb = F.col(f"c{i}"), F.col(f"c{j}")
            both = xa.isNotNull() & xb.isNotNull()
            sa, sb = F.stddev_samp(F.when(both, xa)), F.stddev_samp(F.when(both, xb))
            r = F.try_divide(F.covar_samp(F.when(both, xa), F.when(both, xb)), sa * sb)
            if i == j:
                r = F.when(sa > 0, sa / sa)
            aggs.append(F.when(~F.isnan(r), r).alias(f"r_{i}_{j}"))
            pairs += [(p, q, f"r_{i}_{j}") for p, q in {(a, b), (b, a)}]
    return _long(x.agg(*aggs), [F.struct(F.lit(a).alias("col_a"), F.lit(b).alias("col_b"), F.col(k).alias("r"))
                                for a, b, k in pairs])
