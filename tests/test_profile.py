import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.operators import profile as pr
from quarry.operators import quantiles as qn
from quarry.operators.clean import clean_table, impute_values


def test_mode_tie_goes_to_smallest(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), (None,)], "c string")
    r = pr.column_modes(df, ["c"]).first()
    assert (r.mode_value, r.mode_count) == ("a", 2)
    assert pr.mode_of(df, "c").first().mode_value == "a"


def test_quartiles_interpolate_like_numpy(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (10.0,)], "x double")
    d = pr.describe_numeric(df, ["x"]).first()
    assert (d.p25, d.p50, d.p75) == tuple(np.percentile([1, 2, 3, 10], [25, 50, 75]))
    assert math.isclose(d.std, np.std([1, 2, 3, 10], ddof=1))


def test_duplicates_null_and_nan_equal_themselves(spark):
    df = spark.createDataFrame([(None, float("nan")), (None, float("nan"))], "a string, b double")
    r = pr.duplicate_count(df).first()
    assert (r.n_rows, r.n_distinct, r.n_duplicates) == (2, 1, 1)
    assert pr.distinct_rows(df).count() == 1


def test_null_counts_count_nan(spark):
    df = spark.createDataFrame([(None, float("nan")), ("x", 1.0)], "a string, b double")
    got = {r.column_name: r.n_null for r in pr.null_counts(df).collect()}
    assert got == {"a": 1, "b": 1, "*": 2}


def test_correlation_constant_column_is_null_and_pairwise(spark):
    df = spark.createDataFrame([(1.0, 1.0, 5.0), (2.0, 3.0, 5.0), (None, 9.0, 5.0), (3.0, 4.0, 5.0)],
                               "x double, y double, k double")
    got = {(r.col_a, r.col_b): r.r for r in pr.correlation_matrix(df, ["x", "y", "k"]).collect()}
    assert round(got[("x", "y")], 5) == 0.98198
    assert got[("x", "y")] == got[("y", "x")]
    assert got[("x", "k")] is None and got[("k", "k")] is None
    assert got[("x", "x")] == 1.0


def test_histogram_matches_numpy(spark):
    rng = np.random.default_rng(3)
    vals = np.round(rng.gamma(2.0, 30.0, 2000), 2)
    df = spark.createDataFrame([(float(v),) for v in vals], "v double")
    for bins in ("auto", 15):
        counts, edges = np.histogram(vals, bins=bins)
        got = pr.histogram(df, "v", bins).orderBy("bin").collect()
        assert [r["count"] for r in got] == counts.tolist()
        assert np.allclose([r.lo for r in got] + [got[-1].hi], edges)


def test_kde_matches_closed_form(spark):
    vals = np.array([1.0, 2.0, 2.5, 4.0, 7.0, 7.5])
    df = spark.createDataFrame([(float(v),) for v in vals], "v double")
    got = pr.kde_curve(df, "v", gridsize=9).orderBy("grid_index").collect()
    n, sd = len(vals), vals.std(ddof=1)
    bw = sd * n ** (-1 / 5)
    grid = np.linspace(vals.min() - 3 * bw, vals.max() + 3 * bw, 9)
    dens = np.exp(-0.5 * ((grid[:, None] - vals[None, :]) / bw) ** 2).sum(1) / (n * bw * math.sqrt(2 * math.pi))
    assert np.allclose([r.x for r in got], grid)
    assert np.allclose([r.density for r in got], dens)


def test_box_stats_do_not_deal_rows_out_by_group(spark):
    # Two groups: rows dealt out by group would be two tasks, whatever the cluster.
    df = spark.range(0, 1000, 1, 4).select((F.col("id") % 2).alias("g"), F.col("id").cast("double").alias("v"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for frame in (pr.box_stats(df, "v", by=["g"]), pr.box_outliers(df, "v", by=["g"])):
            assert "BroadcastHashJoin" in frame._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_box_stats_whiskers(spark):
    vals = [1.0, 2.0, 3.0, 4.0, 5.0, 6.0, 100.0]
    df = spark.createDataFrame([("g", v) for v in vals] + [("h", 1.0), ("h", 2.0)], "g string, v double")
    q1, q3 = np.percentile(vals, [25, 75])
    hi = q3 + 1.5 * (q3 - q1)
    r = pr.box_stats(df.filter("g = 'g'"), "v").first()
    assert (r.q1, r.q3, r.whisker_hi, r.n_out_high, r.n_out_low) == (q1, q3, max(v for v in vals if v <= hi), 1, 0)
    grouped = {x.g: x for x in pr.box_stats(df, "v", by=["g"]).collect()}
    assert grouped["g"].whisker_hi == r.whisker_hi and grouped["h"].n == 2
    assert pr.box_outliers(df.filter("g = 'g'"), "v").count() == 1


def test_clean_table_order_mode_on_unstripped_text(spark):
    # ' a' (unstripped) is the mode; after stripping it equals 'a'
    df = spark.createDataFrame([(" a", 1.0), (" a", None), ("a", 3.0), (None, 5.0), ("b", 5.0)],
                               "TXT string, NUM double")
    vals = impute_values(df.toDF("txt", "num"))
    assert vals["txt"] == " a" and vals["num"] == 4.0
    out = sorted(tuple(r) for r in clean_table(df).collect())
    assert out == [("a", 1.0), ("a", 3.0), ("a", 4.0), ("a", 5.0), ("b", 5.0)]


def test_value_and_category_counts(spark):
    df = spark.createDataFrame([("x", "p"), ("y", "p"), ("x", None)], "a string, b string")
    assert [tuple(r) for r in pr.value_counts(df, "a").collect()] == [("x", 2), ("y", 1)]
    got = {(r.column_name, r.value): r["count"] for r in pr.category_counts(df, ["a", "b"]).collect()}
    assert got == {("a", "x"): 2, ("a", "y"): 1, ("b", "p"): 2}


PROBS = [0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0]


def same(got, vals, probs=PROBS):
    with np.errstate(invalid="ignore"):
        want = np.quantile(np.array(vals), probs)
    assert np.array_equal(got, want, equal_nan=True), (got, want)
    return True


def test_ordered_key_is_the_order_of_the_bits(spark):
    rng = np.random.default_rng(5)
    bits = rng.integers(-2**63, 2**63, 20_000, dtype=np.int64)
    near = np.array([s * 2.0**e for e in range(-1074, 1024) for s in (1, -1)])
    vals = np.concatenate([bits.view(np.float64), near, np.nextafter(near, np.inf), np.nextafter(near, -np.inf),
                           [0.0, -0.0, np.inf, -np.inf, 5e-324, 1.7976931348623157e308]])
    vals = vals[~np.isnan(vals)]
    mag = np.abs(vals).view(np.int64)
    want = np.where(vals < 0, -mag, mag)
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(vals)], "i int, v double")
    got = {r.i: r.k for r in qn.with_ordered_key(df, "v", "k").collect()}
    assert [got[i] for i in range(len(vals))] == want.tolist()
    nan = qn.with_ordered_key(spark.createDataFrame([(float("nan"),)], "v double"), "v", "k").first().k
    assert nan > max(want)


def test_radix_quantiles_match_numpy(spark, monkeypatch):
    rng = np.random.default_rng(11)
    data = {
        "ties": np.round(rng.lognormal(3, 1, 6000), 1),
        "tail": np.exp(rng.normal(0, 150, 3000)) * rng.choice([-1, 1], 3000),
        "hot": np.concatenate([np.full(3000, 7.0), rng.normal(size=500)]),
        "ends": np.concatenate([np.full(900, 1.0), np.full(900, 2.0), np.linspace(1, 2, 20)]),
        "tiny": np.array([1.0, 4.0]), "one": np.array([-3.5]),
        "infinite": np.array([-np.inf, -np.inf, 1.0, 2.0, np.inf]), "zeros": np.array([0.0, -0.0, 0.0, -1e-320]),
        None: np.array([5.0, 6.0, 9.0]),
    }
    rows = [(g, float(v)) for g, vals in data.items() for v in vals] + [("ties", None), ("gone", None)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(5)
    for most in (qn.STATE_ROWS, 2):  # wanted digits as literal rows, and as a table
        monkeypatch.setattr(qn, "STATE_ROWS", most)
        got = {r.g: (r.n, r.q) for r in qn.exact_quantiles(df, "v", PROBS, by=["g"]).collect()}
        assert set(got) == set(data)
        assert all(got[g][0] == len(vals) and same(got[g][1], vals) for g, vals in data.items())
    assert same(qn.exact_quantiles(df.filter("g = 'tail'"), "v", PROBS).first().q, data["tail"])
    assert qn.exact_quantiles(df.filter("g = 'gone'"), "v", PROBS).count() == 0


def test_radix_quantiles_digit_by_digit(spark, monkeypatch):
    """With digits of four bits every round is taken."""
    monkeypatch.setattr(qn, "DIGIT", 4)
    rng = np.random.default_rng(2)
    data = {"a": rng.normal(size=700), "b": 1e9 + rng.integers(0, 5, 400) * 1e-6}
    df = spark.createDataFrame([(g, float(v)) for g, vals in data.items() for v in vals], "g string, v double")
    got = {r.g: r.q for r in qn.exact_quantiles(df, "v", PROBS, by=["g"]).collect()}
    assert all(same(got[g], vals) for g, vals in data.items())


def test_radix_quantiles_of_a_large_group(spark):
    """12 million distinct values in one group: no task holds them, and the plans
    have no gathering of values."""
    n = 12_000_000
    df = spark.range(n).select(((F.col("id") * 7919 % n).cast("double") / 3).alias("v"))
    out = qn.exact_quantiles(df, "v", [0.25, 0.5])
    assert out.first().q == pytest.approx([(n - 1) * p / 3 for p in (0.25, 0.5)], rel=1e-15)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list(_x" not in plan and "percentile" not in plan


@pytest.mark.parametrize("draw", ["skewed", "far", "tied"])
def test_kde_equals_the_direct_sum(spark, draw):
    rng = np.random.default_rng(8)
    vals = {"skewed": rng.gamma(2.0, 30.0, 5000), "far": np.append(rng.normal(0, 1, 3000), [4e4, -9e5]),
            "tied": rng.integers(0, 4, 2000) * 1.5}[draw]
    df = spark.createDataFrame([(float(v),) for v in vals] + [(None,), (float("nan"),)], "v double")
    got = pr.kde_curve(df, "v").orderBy("grid_index").collect()
    bw = vals.std(ddof=1) * len(vals) ** (-1 / 5)
    grid = np.linspace(vals.min() - 3 * bw, vals.max() + 3 * bw, 200)
    want = np.exp(-0.5 * ((grid[:, None] - vals[None, :]) / bw) ** 2).sum(1) / len(vals)
    assert np.allclose([r.density * bw * math.sqrt(2 * math.pi) for r in got], want, rtol=0, atol=1e-11)


def test_kde_without_a_spread_has_no_rows(spark):
    for rows in ([], [(None,)], [(2.0,)], [(2.0,), (2.0,)], [(1.0,), (math.inf,)]):
        assert pr.kde_curve(spark.createDataFrame(rows, "v double"), "v").count() == 0


def test_correlation_of_200_columns_with_gaps(spark):
    import pandas as pd

    rng = np.random.default_rng(5)
    x = rng.normal(size=(3000, 200)) + 1e6 * rng.integers(0, 2, 200) + rng.normal(size=(3000, 1))
    x[rng.random(x.shape) < 0.2] = np.nan
    x[:, 7], x[:, 8], x[5:, 9] = 3.3, np.nan, np.nan
    frame = pd.DataFrame(x, columns=[f"c{i}" for i in range(200)])
    df = spark.createDataFrame(frame).repartition(7)
    got = pr.correlation_matrix(df, frame.columns).toPandas().pivot(index="col_a", columns="col_b", values="r")
    # pandas loses digits on values far from 0.
    want = (frame - frame.mean().round()).corr(min_periods=2).loc[got.index, got.columns]
    want.loc["c7"], want["c7"] = np.nan, np.nan
    assert np.allclose(got.to_numpy(float), want.to_numpy(), rtol=0, atol=1e-9, equal_nan=True)


@pytest.mark.parametrize("narrow", [0, 8])
def test_correlation_scans_once_and_keeps_pairs_of_an_empty_table(spark, monkeypatch, narrow):
    monkeypatch.setattr(pr, "NARROW", narrow)
    df = spark.range(50).selectExpr("id", "-id as y", "if(id = 3, double('Infinity'), id) as z")
    plan = pr.correlation_matrix(df, ["id", "y", "z"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == (not narrow) and plan.count("Range (") == 1 + (not narrow)
    got = {(r.col_a, r.col_b): r.r for r in pr.correlation_matrix(df, ["id", "y", "z"]).collect()}
    assert got[("id", "y")] == pytest.approx(-1.0) and got[("id", "z")] is None and len(got) == 9
    empty = pr.correlation_matrix(df.filter("id < 0"), ["id", "y"]).collect()
    assert len(empty) == 4 and all(r.r is None for r in empty)
