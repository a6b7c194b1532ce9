"""Registered queries: profiling.

Floating results are rounded identically on both sides (sums run in a
different order in Spark and in DuckDB)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.operators import profile as pr
from quarry.plans import fixtures as fx
from quarry.plans.registry import query


def _t(spark, sf_dir):
    return fx.Tables(spark, sf_dir)


def _round(df: DataFrame, digits: int, skip: tuple[str, ...] = ()) -> DataFrame:
    """Round every double column (except ``skip``)."""
    return df.select(*[
        F.round(F.col(f.name), digits).alias(f.name)
        if f.dataType.simpleString() == "double" and f.name not in skip else F.col(f.name)
        for f in df.schema.fields
    ])


@query("table_counts", sql=" UNION ALL ".join(
    f"SELECT '{n}' AS table_name, count(*) AS n_rows FROM {n}" for n in fx.TPCH_TABLES))
def table_counts(spark, sf_dir):
    """A1."""
    t = _t(spark, sf_dir)
    return pr.table_counts({n: t(n) for n in fx.TPCH_TABLES})


_DIRTY_COLS = ["EVENT_ID", "TS", "USER_ID", "EVENT_TYPE", "VALUE", "PROPS"]
_NULLS = {c: f"{c} IS NULL" + (" OR isnan(VALUE)" if c == "VALUE" else "") for c in _DIRTY_COLS}


@query("null_counts", sql="WITH " + fx.DIRTY_SQL + ",\nc AS (SELECT " + ", ".join(
    f"count(*) FILTER (WHERE {cond}) AS n_{c}" for c, cond in _NULLS.items()) + " FROM dirty)\n" + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, n_{c} AS n_null FROM c" for c in _DIRTY_COLS)
    + " UNION ALL SELECT '*', " + " + ".join(f"n_{c}" for c in _DIRTY_COLS) + " FROM c")
def null_counts(spark, sf_dir):
    """A3: per column and in total (NaN counts as missing, as in pandas)."""
    return pr.null_counts(fx.dirty(_t(spark, sf_dir)))


@query("duplicate_count", sql="WITH " + fx.DIRTY_SQL + """,
g AS (SELECT count(*) AS n FROM dirty GROUP BY EVENT_ID, TS, USER_ID, EVENT_TYPE, VALUE, PROPS)
SELECT CAST(sum(n) AS BIGINT) AS n_rows, count(*) AS n_distinct, CAST(sum(n - 1) AS BIGINT) AS n_duplicates FROM g""")
def duplicate_count(spark, sf_dir):
    """A4."""
    return pr.duplicate_count(fx.dirty(_t(spark, sf_dir)))


@query("column_mode", sql="WITH " + fx.DIRTY_SQL + "\n" + " UNION ALL ".join(
    f"""SELECT * FROM (SELECT '{c}' AS column_name, {c} AS mode_value, count(*) AS mode_count
    FROM dirty WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1)"""
    for c in ["EVENT_TYPE", "PROPS"]))
def column_mode(spark, sf_dir):
    """A5: most frequent non-null text, tie -> smallest."""
    return pr.column_modes(fx.dirty(_t(spark, sf_dir)), ["EVENT_TYPE", "PROPS"])


@query("column_median", sql="WITH " + fx.DIRTY_SQL + "\n" + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, round(CAST(quantile_cont({c}, 0.5) AS DOUBLE), 6) AS median FROM dirty"
    for c in ["EVENT_ID", "USER_ID", "VALUE"]))
def column_median(spark, sf_dir):
    """Exact interpolated median, nulls skipped."""
    return _round(pr.column_medians(fx.dirty(_t(spark, sf_dir)), ["EVENT_ID", "USER_ID", "VALUE"]), 6)


_DESCRIBE_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("describe_numeric", sql=" UNION ALL ".join(
    f"""SELECT '{c}' AS column_name, count({c}) AS count, round(avg({c}), 5) AS mean,
    round(stddev_samp({c}), 5) AS std, round(min({c}), 5) AS min,
    round(quantile_cont({c}, 0.25), 5) AS p25, round(quantile_cont({c}, 0.5), 5) AS p50,
    round(quantile_cont({c}, 0.75), 5) AS p75, round(max({c}), 5) AS max FROM lineitem"""
    for c in _DESCRIBE_COLS))
def describe_numeric(spark, sf_dir):
    """Pandas ``describe()`` numbers in one aggregate pass."""
    return _round(pr.describe_numeric(_t(spark, sf_dir)("lineitem"), _DESCRIBE_COLS), 5)


@query("value_counts", sql="""
SELECT o_orderpriority, count(*) AS count FROM orders WHERE o_orderpriority IS NOT NULL
GROUP BY o_orderpriority ORDER BY count DESC, o_orderpriority""")
def value_counts(spark, sf_dir):
    """A8."""
    return pr.value_counts(_t(spark, sf_dir)("orders"), "o_orderpriority")


@query("category_counts", sql="""
SELECT 'o_orderstatus' AS column_name, o_orderstatus AS value, count(*) AS count FROM orders GROUP BY 2
UNION ALL
SELECT 'o_orderpriority', o_orderpriority, count(*) FROM orders GROUP BY 2""")
def category_counts(spark, sf_dir):
    """A9."""
    return pr.category_counts(_t(spark, sf_dir)("orders"), ["o_orderstatus", "o_orderpriority"])


_LINEITEM_TYPES = [("l_orderkey", "bigint"), ("l_partkey", "bigint"), ("l_suppkey", "bigint"),
                   ("l_linenumber", "int"), ("l_quantity", "double"), ("l_extendedprice", "double"),
                   ("l_discount", "double"), ("l_tax", "double"), ("l_returnflag", "string"),
                   ("l_linestatus", "string"), ("l_shipdate", "timestamp_ntz")]


@query("table_profile", sql=" UNION ALL ".join(
    f"""SELECT {i} AS position, '{c}' AS column_name, '{t}' AS data_type, count({c}) AS non_null,
    count(*) AS n_rows, {len(_LINEITEM_TYPES)} AS n_cols FROM lineitem"""
    for i, (c, t) in enumerate(_LINEITEM_TYPES)))
def table_profile(spark, sf_dir):
    """A10: ``info()``/``shape`` as a frame."""
    return pr.table_profile(_t(spark, sf_dir)("lineitem"))


def _hist_sql(bins: str) -> str:
    nb = {"auto": """CAST(ceil((hi - lo) / (CASE WHEN fd > 0 THEN least(fd, sturges) ELSE sturges END))
                   AS INTEGER)"""}.get(bins, bins)
    return f"""
WITH x AS (SELECT value AS v FROM events WHERE value IS NOT NULL),
s AS (SELECT count(*) AS n, min(v) AS lo, max(v) AS hi,
             quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.75) AS q3 FROM x),
w AS (SELECT *, (hi - lo) / (log2(n) + 1.0) AS sturges, 2.0 * (q3 - q1) * pow(n, -1.0 / 3.0) AS fd FROM s),
k AS (SELECT *, {nb} AS nb FROM w),
e AS (SELECT *, (hi - lo) / nb AS step, nb / (hi - lo) AS norm FROM k),
g AS (SELECT v, least(CAST(floor((v - lo) * norm) AS INTEGER), nb - 1) AS b, lo, hi, nb, step FROM x, e),
c AS (SELECT CASE WHEN v < (CASE WHEN b = nb THEN hi ELSE b * step + lo END) THEN b - 1
                  WHEN v >= (CASE WHEN b + 1 = nb THEN hi ELSE (b + 1) * step + lo END) AND b <> nb - 1 THEN b + 1
                  ELSE b END AS bin FROM g),
cnt AS (SELECT bin, count(*) AS n FROM c GROUP BY bin),
bins AS (SELECT CAST(i AS INTEGER) AS bin, lo, hi, nb, step FROM e, range(nb) r(i))
SELECT bins.bin,
       round(CASE WHEN bins.bin = nb THEN hi ELSE bins.bin * step + lo END, 6) AS lo,
       round(CASE WHEN bins.bin + 1 = nb THEN hi ELSE (bins.bin + 1) * step + lo END, 6) AS hi,
       CAST(coalesce(cnt.n, 0) AS BIGINT) AS count
FROM bins LEFT JOIN cnt USING (bin)"""


@query("histogram", sql=_hist_sql("auto"))
def histogram(spark, sf_dir):
    """NumPy ``bins='auto'`` (finer of Sturges and Freedman-Diaconis)."""
    return _round(pr.histogram(_t(spark, sf_dir)("events"), "value", "auto"), 6)


@query("histogram_fixed", sql=_hist_sql("20"))
def histogram_fixed(spark, sf_dir):
    """A11 with a fixed bin count."""
    return _round(pr.histogram(_t(spark, sf_dir)("events"), "value", 20), 6)


@query("kde_curve", sql="""
WITH x AS (SELECT value AS v FROM events WHERE value IS NOT NULL),
s AS (SELECT count(*) AS n, stddev_samp(v) AS sd, min(v) AS lo, max(v) AS hi FROM x),
b AS (SELECT *, sd * pow(n, -1.0 / 5.0) AS bw FROM s),
gr AS (SELECT *, lo - bw * 3.0 AS gmin, hi + bw * 3.0 AS gmax FROM b),
g AS (SELECT CAST(i AS INTEGER) AS grid_index,
             CASE WHEN i = 199 THEN gmax ELSE i * ((gmax - gmin) / 199) + gmin END AS gx, bw, n FROM gr, range(200) r(i))
SELECT grid_index, round(gx, 6) AS x,
       round(sum(exp(-0.5 * pow((gx - v) / bw, 2))) * (1.0 / (n * bw * sqrt(2 * pi()))), 10) AS density
FROM g, x GROUP BY grid_index, gx, bw, n""")
def kde_curve(spark, sf_dir):
    """KDE of events.value on the operator's 200-point grid."""
    k = pr.kde_curve(_t(spark, sf_dir)("events"), "value", gridsize=200)
    return k.select("grid_index", F.round("x", 6).alias("x"), F.round("density", 10).alias("density"))


def _box_sql(by: str | None) -> str:
    g = f"{by}, " if by else ""
    grp = f"GROUP BY {by}" if by else ""
    join = f"JOIN q USING ({by})" if by else ", q"
    return f"""
WITH x AS (SELECT {g}value AS v FROM events WHERE value IS NOT NULL),
q AS (SELECT {g}count(*) AS n, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS median,
             quantile_cont(v, 0.75) AS q3 FROM x {grp}),
f AS (SELECT *, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS lo_fence, q3 + 1.5 * (q3 - q1) AS hi_fence FROM q),
w AS (SELECT {g}min(v) FILTER (WHERE v >= lo_fence) AS whisker_lo, max(v) FILTER (WHERE v <= hi_fence) AS whisker_hi,
             count(*) FILTER (WHERE v < lo_fence) AS n_out_low, count(*) FILTER (WHERE v > hi_fence) AS n_out_high
      FROM x {join.replace('q', 'f')} {grp})
SELECT {g}n, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3, round(iqr, 6) AS iqr,
       round(lo_fence, 6) AS lo_fence, round(hi_fence, 6) AS hi_fence, round(whisker_lo, 6) AS whisker_lo,
       round(whisker_hi, 6) AS whisker_hi, n_out_low, n_out_high
FROM f {join.replace('q', 'w') if by else ', w'}"""


@query("box_stats", sql=_box_sql(None))
def box_stats(spark, sf_dir):
    """Quartiles, 1.5-IQR whiskers, outlier counts of events.value."""
    return _round(pr.box_stats(_t(spark, sf_dir)("events"), "value"), 6)


@query("box_outliers", sql="""
WITH q AS (SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM events)
SELECT events.* FROM events, q WHERE value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1)""")
def box_outliers(spark, sf_dir):
    """A13, second frame: the rows beyond the fences."""
    return pr.box_outliers(_t(spark, sf_dir)("events"), "value")


@query("box_stats_by_group", sql=_box_sql("event_type"))
def box_stats_by_group(spark, sf_dir):
    """The same per event_type."""
    return _round(pr.box_stats(_t(spark, sf_dir)("events"), "value", by=["event_type"]), 6)


_CORR_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _corr_sql() -> str:
    parts = []
    for a in _CORR_COLS:
        for b in _CORR_COLS:
            if a == b:
                r = f"CASE WHEN stddev_samp({a}) > 0 THEN 1.0 END"
            else:
                both = f"{a} IS NOT NULL AND {b} IS NOT NULL"
                r = (f"covar_samp({a}, {b}) / nullif(stddev_samp({a}) FILTER (WHERE {both}) * "
                     f"stddev_samp({b}) FILTER (WHERE {both}), 0)")
            parts.append(f"SELECT '{a}' AS col_a, '{b}' AS col_b, round({r}, 8) AS r FROM lineitem")
    return " UNION ALL ".join(parts)


@query("correlation_matrix", sql=_corr_sql())
def correlation_matrix(spark, sf_dir):
    """Pairwise-complete Pearson matrix, long form."""
    return _round(pr.correlation_matrix(_t(spark, sf_dir)("lineitem"), _CORR_COLS), 8)
