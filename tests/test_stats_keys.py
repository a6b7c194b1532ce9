import math

import numpy as np
from pyspark.sql import Window
from pyspark.sql import functions as F

from quarry.functions.special import t_two_sided_p
from quarry.operators import forecast as fc
from quarry.operators import stats as st
from quarry.operators.keys import surrogate_key


def test_ttest_matches_pooled_formula(spark):
    a = [12.0, 15.0, 11.0, 19.0, 14.0]
    b = [10.0, 9.0, 13.0, 8.0]
    df = spark.createDataFrame([(v, 1) for v in a] + [(v, 0) for v in b] + [(99.0, None)], "x double, g int")
    r = st.ttest_independent(df, "x", F.col("g") == 1, F.col("g") == 0).first()
    n1, n2 = len(a), len(b)
    sp = ((n1 - 1) * np.var(a, ddof=1) + (n2 - 1) * np.var(b, ddof=1)) / (n1 + n2 - 2)
    t = (np.mean(a) - np.mean(b)) / math.sqrt(sp * (1 / n1 + 1 / n2))
    assert math.isclose(r.t_stat, t) and r.df == 7


def test_no_statistic_gives_no_label(spark):
    tests = spark.createDataFrame([(None, 5.0), (2.0, 5.0)], "t_stat double, df double")
    none, some = sorted(st.with_p_value(tests).collect(), key=lambda r: r.t_stat is not None)
    assert none.p_value is None and none.result is None and some.result == "REJECTED"


def student_tail(t, v):
    """Two-sided tail by Simpson's rule over the angle whose tangent is t / sqrt(v)."""
    lo = math.atan(abs(t) / math.sqrt(v))
    hi = min(math.pi / 2, lo + 40 / math.sqrt(v))
    n = 40_000
    u = np.linspace(lo, hi, n + 1)
    w = np.ones(n + 1)
    w[1:-1:2], w[2:-1:2] = 4, 2
    area = (w * np.cos(u) ** (v - 1)).sum() * (hi - lo) / (3 * n) if v != 1 else hi - lo
    return 2 * math.exp(math.lgamma(v / 2 + 0.5) - math.lgamma(v / 2)) / math.sqrt(math.pi) * area


def test_t_p_values_known(spark):
    # Two-sided tails in closed form or from tables.
    known = [(2.0, 10.0, 0.07338803477074), (0.0, 5.0, 1.0), (1.0, 1.0, 0.5), (-12.706204736174703, 1.0, 0.05),
             (2.2281388519649385, 10.0, 0.05), (math.sqrt(2.0), 2.0, 1 - math.sqrt(0.5)), (float("inf"), 3.0, 0.0)]
    known += [(t, v, student_tail(t, v)) for v in (3.0, 4.5, 30.0, 999.0, 48_000.0, 3e6)
              for t in (1e-4, 0.3, 1.1, 1.9, 2.6, 4.0, 7.0)]
    df = spark.createDataFrame([(i, t, v) for i, (t, v, _) in enumerate(known)], "i int, t double, v double")
    got = {r.i: r.p for r in df.select("i", t_two_sided_p(F.col("t"), F.col("v")).alias("p")).collect()}
    for i, (t, v, p) in enumerate(known):
        assert math.isclose(got[i], p, rel_tol=1e-8, abs_tol=1e-10), (t, v)
    odd = spark.createDataFrame([(None, 5.0), (1.0, None), (1.0, 0.0), (float("nan"), 5.0), (1.0, float("nan"))],
                                "t double, v double")
    assert {r.p for r in odd.select(t_two_sided_p(F.col("t"), F.col("v")).alias("p")).collect()} == {None}


def test_p_values_need_no_python_worker(spark):
    tests = spark.createDataFrame([("a", 2.0, 5)], "test string, t_stat double, df long")
    plan = st.with_p_value(tests)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_pearson_and_report(spark):
    df = spark.createDataFrame([(1.0, 1.0), (2.0, 3.0), (None, 9.0), (3.0, 4.0), (4.0, 4.5)], "x double, y double")
    r = st.pearson_test(df, "x", "y").first()
    xs, ys = np.array([1, 2, 3, 4.0]), np.array([1, 3, 4, 4.5])
    assert math.isclose(r.r, np.corrcoef(xs, ys)[0, 1]) and r.n == 4
    rep = st.with_p_value(st.pearson_test(df, "x", "y")).first()
    assert 0 < rep.p_value < 1 and rep.result in ("CONFIRMED", "REJECTED")


def test_regression_metrics(spark):
    y, p = np.array([3.0, 5.0, 7.0, 9.0]), np.array([2.5, 5.5, 6.0, 9.5])
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(y, p)], "y double, p double")
    r = st.regression_metrics(df, "y", "p").first()
    assert math.isclose(r.r2, 1 - ((y - p) ** 2).sum() / ((y - y.mean()) ** 2).sum())
    assert math.isclose(r.mae, np.abs(y - p).mean())


def test_trend_and_breach(spark):
    days = np.arange(1, 31)
    load = 35.0 + 1.8 * days
    df = spark.createDataFrame([(int(d), float(v)) for d, v in zip(days, load)], "day int, load double")
    fit = fc.breach_day(fc.trend_fit(df, "day", "load"), 90.0).first()
    assert math.isclose(fit.slope, 1.8) and fit.breach_day == math.ceil((90 - 35) / 1.8)
    line = fc.threshold_forecast(df, "day", "load", 90.0)
    assert line.count() == fit.breach_day + 4
    flat = spark.createDataFrame([(5, 1.0), (5, 2.0)], "day int, load double")
    f2 = fc.breach_day(fc.trend_fit(flat, "day", "load"), 90.0).first()
    assert f2.slope is None and f2.breach_day is None


def test_surrogate_key_equals_global_row_number(spark):
    o = spark.read.parquet("/root/testdata/sf0.01/orders.parquet")
    order = ["o_custkey", "o_orderdate", "o_orderkey"]
    keyed = surrogate_key(o.repartition(7), order, key="sk", num_partitions=5)
    ref = o.withColumn("rn", F.row_number().over(Window.orderBy(*order)).cast("bigint"))
    diff = keyed.join(ref, "o_orderkey").filter(F.col("sk") != F.col("rn")).count()
    assert diff == 0
    stats = keyed.agg(F.min("sk"), F.max("sk"), F.count_distinct("sk")).first()
    assert tuple(stats) == (1, o.count(), o.count())


def test_surrogate_key_hot_duplicate_rows_split(spark):
    # a third of the rows identical: keys stay consecutive and distinct
    rows = [(1, "x")] * 300 + [(i, "y") for i in range(600)]
    df = spark.createDataFrame(rows, "a int, b string")
    keyed = surrogate_key(df, ["a", "b"], start=10, num_partitions=6)
    s = keyed.agg(F.min("row_id"), F.max("row_id"), F.count_distinct("row_id")).first()
    assert tuple(s) == (10, 909, 900)


def test_forecast_line_per_series_and_crossed_threshold(spark):
    rows = [("up", d, 10.0 + 2.0 * d) for d in range(1, 11)] + [("over", d, 100.0 + 1.0 * d) for d in range(1, 11)]
    df = spark.createDataFrame(rows, "s string, day int, v double")
    per = {r.s: r["count"] for r in fc.threshold_forecast(df, "day", "v", 50.0, by=["s"]).groupBy("s").count().collect()}
    assert per == {"up": 20 + 4}                      # breach at day 20; "over" has no line
    single = fc.threshold_forecast(df.filter("s = 'over'"), "day", "v", 50.0)
    assert single.count() == 0
