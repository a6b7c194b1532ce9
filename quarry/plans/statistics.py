"""Registered queries: statistics, forecast, alerts, EDA bundle
(A16-A20, B6, B7, M18, T1, T2)."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.operators import forecast as fc
from quarry.operators import monitor as mo
from quarry.operators import profile as pr
from quarry.operators import stats as st
from quarry.plans import fixtures as fx
from quarry.plans.profiling import _round
from quarry.plans.registry import query


def _t(spark, sf_dir):
    return fx.Tables(spark, sf_dir)


# ------------------------------------------------------- hypothesis tests ----

# (test name, table, value column, group A, group B) -- SQL text is shared by
# the Spark builder (``F.expr``) and the oracle.
T_TESTS = [
    ("priority_high_vs_low", "orders", "o_totalprice",
     "CAST(substr(o_orderpriority, 1, 1) AS INT) >= 3", "CAST(substr(o_orderpriority, 1, 1) AS INT) <= 2"),
    ("status_f_vs_o", "orders", "o_totalprice", "o_orderstatus = 'F'", "o_orderstatus = 'O'"),
    ("linestatus_f_vs_o", "lineitem", "l_quantity", "l_linestatus = 'F'", "l_linestatus = 'O'"),
]
PEARSON = ("quantity_vs_price", "lineitem", "l_quantity", "l_extendedprice")


def _ttests(spark, sf_dir):
    t = _t(spark, sf_dir)
    out = None
    for name, table, value, a, b in T_TESTS:
        r = st.ttest_independent(t(table), value, F.expr(a), F.expr(b), test=name)
        out = r if out is None else out.unionByName(r)
    return out


def _ttest_sql(name, table, value, a, b) -> str:
    return f"""SELECT '{name}' AS test, n1, n2, round(m1, 6) AS mean1, round(m2, 6) AS mean2,
  round((m1 - m2) / sqrt(((n1 - 1) * v1 + (n2 - 1) * v2) / (n1 + n2 - 2) * (1.0 / n1 + 1.0 / n2)), 6) AS t_stat,
  n1 + n2 - 2 AS df
FROM (SELECT count({value}) FILTER (WHERE {a}) AS n1, count({value}) FILTER (WHERE {b}) AS n2,
             avg({value}) FILTER (WHERE {a}) AS m1, avg({value}) FILTER (WHERE {b}) AS m2,
             var_samp({value}) FILTER (WHERE {a}) AS v1, var_samp({value}) FILTER (WHERE {b}) AS v2
      FROM {table})"""


@query("ttest_independent", sql=" UNION ALL ".join(_ttest_sql(*x) for x in T_TESTS))
def ttest_independent(spark, sf_dir):
    """Pooled two-sample t statistics (p-values in hypothesis_report)."""
    return _round(_ttests(spark, sf_dir), 6)


def _pearson(spark, sf_dir):
    name, table, x, y = PEARSON
    return st.pearson_test(_t(spark, sf_dir)(table), x, y, test=name)


@query("pearson_test", sql=f"""
SELECT '{PEARSON[0]}' AS test, n, round(r, 6) AS r, round(r * sqrt((n - 2) / (1 - r * r)), 6) AS t_stat, n - 2 AS df
FROM (SELECT count(*) FILTER (WHERE {PEARSON[2]} IS NOT NULL AND {PEARSON[3]} IS NOT NULL) AS n,
             covar_samp({PEARSON[2]}, {PEARSON[3]}) / (stddev_samp({PEARSON[2]}) * stddev_samp({PEARSON[3]})) AS r
      FROM {PEARSON[1]})""")
def pearson_test(spark, sf_dir):
    """R and its t statistic."""
    return _round(_pearson(spark, sf_dir), 6)


# direction each hypothesis states: +1 "group A higher", -1 "group A lower"
HYPOTHESIS_DIRECTION = {"priority_high_vs_low": 1, "status_f_vs_o": -1, "linestatus_f_vs_o": -1,
                        "quantity_vs_price": 1}


def _report_sql() -> str:
    """The tail of Student's t by Simpson's rule over the angle whose tangent is
    t / sqrt(df)."""
    tests = " UNION ALL ".join([*(_ttest_sql(*x).replace("round(", "(").replace(", 6)", ")") for x in T_TESTS)])
    direction = " ".join(f"WHEN '{k}' THEN {v}" for k, v in HYPOTHESIS_DIRECTION.items())
    return f"""
WITH s AS (SELECT test, t_stat, df FROM ({tests}) UNION ALL
  SELECT '{PEARSON[0]}', r * sqrt((n - 2) / (1 - r * r)), n - 2
  FROM (SELECT count(*) AS n, corr({PEARSON[2]}, {PEARSON[3]}) AS r FROM {PEARSON[1]}
        WHERE {PEARSON[2]} IS NOT NULL AND {PEARSON[3]} IS NOT NULL)),
b AS (SELECT *, atan(abs(t_stat) / sqrt(df)) AS lo, least(pi() / 2, atan(abs(t_stat) / sqrt(df)) + 40 / sqrt(df)) AS hi FROM s),
a AS (SELECT test, sum(CASE WHEN i IN (0, 20000) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END
                       * pow(cos(lo + (hi - lo) * i / 20000), df - 1)) * any_value(hi - lo) / 60000 AS area
      FROM b, range(20001) g(i) GROUP BY test),
p AS (SELECT test, t_stat, df, 2 * exp(lgamma(df / 2 + 0.5) - lgamma(df / 2)) / sqrt(pi()) * area AS p FROM b JOIN a USING (test))
SELECT test, round(t_stat, 6) AS statistic, df, round(p, 8) AS p_value,
       CASE WHEN p < 0.05 THEN 'CONFIRMED' ELSE 'REJECTED' END AS result,
       sign(t_stat) = CASE test {direction} END AS direction_holds
FROM p"""


@query("hypothesis_report", sql=_report_sql())
def hypothesis_report(spark, sf_dir):
    """The four tests as one table with p-values and the reference's
    CONFIRMED/REJECTED rule (two-sided, sign ignored) plus whether the
    stated direction holds."""
    tt = _ttests(spark, sf_dir).select("test", "t_stat", "df")
    pe = _pearson(spark, sf_dir).select("test", "t_stat", "df")
    rep = st.with_p_value(tt.unionByName(pe))
    sign = F.lit(0)
    for name, d in HYPOTHESIS_DIRECTION.items():
        sign = F.when(F.col("test") == name, F.lit(d)).otherwise(sign)
    return rep.select("test", F.round("t_stat", 6).alias("statistic"), "df", F.round("p_value", 8).alias("p_value"), "result",
                      (F.signum("t_stat") == sign).alias("direction_holds"))


# ------------------------------------------------------------ metrics -------

def _fold_metrics(spark, sf_dir):
    return st.regression_metrics(fx.fold_frame(_t(spark, sf_dir)), "actual", "predicted", by=["model", "fold"])


_FOLD_METRICS_SQL = "WITH " + fx.FOLD_SQL + """,
fm AS (SELECT model, fold, count(*) AS n,
              1 - sum((actual - predicted) * (actual - predicted)) / (var_pop(actual) * count(actual)) AS r2,
              avg(abs(actual - predicted)) AS mae
       FROM folds GROUP BY model, fold)
"""


@query("metric_mean", sql=_FOLD_METRICS_SQL + """
SELECT model, round(avg(r2), 6) AS mean_r2, round(-avg(-mae), 6) AS mean_mae, count(*) AS n_folds
FROM fm GROUP BY model""")
def metric_mean(spark, sf_dir):
    """Mean fold score per model, MAE sign flipped back."""
    return _round(st.metric_mean(_fold_metrics(spark, sf_dir)), 6)


@query("regression_metrics", sql="WITH " + fx.FOLD_SQL + """
SELECT model, count(*) AS n,
       round(1 - sum((actual - predicted) * (actual - predicted)) / (var_pop(actual) * count(actual)), 6) AS r2,
       round(avg(abs(actual - predicted)), 6) AS mae
FROM folds GROUP BY model""")
def regression_metrics(spark, sf_dir):
    """R^2 and MAE per model."""
    return _round(st.regression_metrics(fx.fold_frame(_t(spark, sf_dir)), "actual", "predicted", by=["model"]), 6)


# ------------------------------------------------------------ forecast -------

_CUM_SQL = """d AS (SELECT CAST(ts AS DATE) AS day, count(*) AS n FROM events GROUP BY 1),
c AS (SELECT day, date_diff('day', (SELECT min(day) FROM d), day) + 1 AS day_index,
             CAST(sum(n) OVER (ORDER BY day ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS cumulative FROM d),
f AS (SELECT count(*) AS n, regr_slope(cumulative, day_index) AS slope,
             regr_intercept(cumulative, day_index) AS intercept, regr_r2(cumulative, day_index) AS r2 FROM c)"""

FORECAST_THRESHOLD = 15000.0


def _cumulative(spark, sf_dir):
    return fc.cumulative_daily_counts(_t(spark, sf_dir)("events"), "ts")


@query("trend_fit", sql="WITH " + _CUM_SQL + """
SELECT n, round(slope, 6) AS slope, round(intercept, 6) AS intercept, round(r2, 6) AS r2 FROM f""")
def trend_fit(spark, sf_dir):
    """Least-squares trend of the cumulative daily event count."""
    return _round(fc.trend_fit(_cumulative(spark, sf_dir), "day_index", "cumulative"), 6)


@query("threshold_forecast", sql="WITH " + _CUM_SQL + f""",
b AS (SELECT *, CASE WHEN slope > 0 THEN CAST(ceil(({FORECAST_THRESHOLD} - intercept) / slope) AS BIGINT) END
              AS breach_day FROM f)
SELECT CAST(g AS BIGINT) AS day, round(intercept + slope * g, 6) AS predicted, breach_day
FROM b, generate_series(1, breach_day + 4) s(g) WHERE breach_day IS NOT NULL""")
def threshold_forecast(spark, sf_dir):
    """Day the cumulative count reaches 15,000 and the fitted line."""
    return _round(fc.threshold_forecast(_cumulative(spark, sf_dir), "day_index", "cumulative",
                                        FORECAST_THRESHOLD), 6)


# ------------------------------------------------------------ alerts ---------

ALERT_WIDTH, ALERT_THRESHOLD = "1 hour", 60.0

ALERTS_SQL = f"""a AS (
  SELECT date_trunc('hour', ts) AS window_start, date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end,
         count(*) AS n, round(avg(value), 6) AS avg_value, avg(value) > {ALERT_THRESHOLD} AS alert
  FROM events GROUP BY 1)"""


def _alerts(spark, sf_dir):
    return mo.latency_alerts(_t(spark, sf_dir)("events"), "ts", "value", ALERT_WIDTH, ALERT_THRESHOLD)


@query("latency_alerts", sql="WITH " + ALERTS_SQL + "\nSELECT * FROM a")
def latency_alerts(spark, sf_dir):
    """T1 (batch): hourly average of events.value, alert above 60."""
    return _round(_alerts(spark, sf_dir), 6)


@query("alert_escalation", sql="WITH " + ALERTS_SQL + """,
s AS (SELECT *, CASE WHEN window_start = lag(window_end) OVER (ORDER BY window_start) THEN 0 ELSE 1 END AS nw
      FROM a WHERE alert),
r AS (SELECT *, sum(nw) OVER (ORDER BY window_start ROWS UNBOUNDED PRECEDING) AS run_id FROM s),
p AS (SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY window_start) AS run_position FROM r)
SELECT window_start, window_end, avg_value, CAST(run_id AS BIGINT) AS run_id,
       CAST(run_position AS BIGINT) AS run_position,
       CASE run_position WHEN 1 THEN 'scale_out' WHEN 2 THEN 'cache' ELSE 'none' END AS action
FROM p""")
def alert_escalation(spark, sf_dir):
    """Action by position inside a run of alert windows."""
    return _round(mo.alert_escalation(_alerts(spark, sf_dir)), 6)


# ------------------------------------------------------------ EDA bundle -----

EDA_NUMERIC = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
EDA_GROUPS = ["l_returnflag", "l_linestatus", "l_discount", "l_tax"]
EDA_Y = "l_extendedprice"
_BOX_STATS = ["n", "q1", "median", "q3", "whisker_lo", "whisker_hi", "n_out_low", "n_out_high"]


def eda_bundle_frame(lineitem):
    """The data behind the 3x2 panel in one long frame
    (panel, grp, stat, value): the correlation matrix, the scatter's extent,
    and four grouped box plots computed together over an unpivoted
    projection (one grouped aggregate instead of four)."""
    corr = pr.correlation_matrix(lineitem, EDA_NUMERIC).select(
        F.lit("corr").alias("panel"), F.concat_ws("~", "col_a", "col_b").alias("grp"),
        F.lit("r").alias("stat"), F.col("r").alias("value"))
    ext = lineitem.agg(F.count(F.lit(1)).cast("double").alias("n"), F.min("l_quantity").alias("x_min"),
                       F.max("l_quantity").alias("x_max"), F.min(EDA_Y).alias("y_min"), F.max(EDA_Y).alias("y_max"))
    xy = ext.select(F.inline(F.array(*[
        F.struct(F.lit("xy").alias("panel"), F.lit("l_quantity~" + EDA_Y).alias("grp"), F.lit(c).alias("stat"),
                 F.col(c).cast("double").alias("value"))
        for c in ["n", "x_min", "x_max", "y_min", "y_max"]])))
    long = lineitem.select(EDA_Y, F.inline(F.array(*[
        F.struct(F.lit("box:" + g).alias("panel"), F.col(g).cast("string").alias("grp")) for g in EDA_GROUPS])))
    boxes = pr.box_stats(long, EDA_Y, by=["panel", "grp"])
    box_long = boxes.select("panel", "grp", F.inline(F.array(*[
        F.struct(F.lit(s).alias("stat"), F.col(s).cast("double").alias("value")) for s in _BOX_STATS])))
    out = corr.unionByName(xy).unionByName(box_long)
    return out.withColumn("value", F.round("value", 6))


def _eda_sql() -> str:
    corr = []
    for a in EDA_NUMERIC:
        for b in EDA_NUMERIC:
            r = (f"CASE WHEN stddev_samp({a}) > 0 THEN 1.0 END" if a == b else
                 f"covar_samp({a}, {b}) / (stddev_samp({a}) * stddev_samp({b}))")
            corr.append(f"SELECT 'corr' AS panel, '{a}~{b}' AS grp, 'r' AS stat, round({r}, 6) AS value FROM lineitem")
    xy = [f"SELECT 'xy', 'l_quantity~{EDA_Y}', '{s}', round(CAST({e} AS DOUBLE), 6) FROM lineitem"
          for s, e in [("n", "count(*)"), ("x_min", "min(l_quantity)"), ("x_max", "max(l_quantity)"),
                       ("y_min", f"min({EDA_Y})"), ("y_max", f"max({EDA_Y})")]]
    long = " UNION ALL ".join(f"SELECT 'box:{g}' AS panel, CAST({g} AS VARCHAR) AS grp, {EDA_Y} AS v FROM lineitem"
                              for g in EDA_GROUPS)
    box = f"""WITH lg AS ({long}),
q AS (SELECT panel, grp, count(*) AS n, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS median,
             quantile_cont(v, 0.75) AS q3 FROM lg GROUP BY panel, grp),
f AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lo_fence, q3 + 1.5 * (q3 - q1) AS hi_fence FROM q),
w AS (SELECT panel, grp, min(v) FILTER (WHERE v >= lo_fence) AS whisker_lo,
             max(v) FILTER (WHERE v <= hi_fence) AS whisker_hi,
             count(*) FILTER (WHERE v < lo_fence) AS n_out_low, count(*) FILTER (WHERE v > hi_fence) AS n_out_high
      FROM lg JOIN f USING (panel, grp) GROUP BY panel, grp),
b AS (SELECT * FROM f JOIN w USING (panel, grp))
SELECT panel, grp, stat, round(CAST(value AS DOUBLE), 6) AS value FROM b
UNPIVOT (value FOR stat IN ({", ".join(_BOX_STATS)}))"""
    return "SELECT * FROM (" + " UNION ALL ".join(corr + xy) + ") UNION ALL SELECT * FROM (" + box + ")"


@query("eda_bundle", sql=_eda_sql())
def eda_bundle(spark, sf_dir):
    return eda_bundle_frame(_t(spark, sf_dir)("lineitem"))
