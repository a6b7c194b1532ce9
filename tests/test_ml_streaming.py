import itertools
import math

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from quarry.ml import attribute as at
from quarry.ml import features as mf
from quarry.ml import linear as li
from quarry.ml import models as mm
from quarry.ml import truncate as tr
from quarry.ml import validate as va
from quarry.ml.scenario import what_if
from quarry.operators import booking as bk
from quarry.operators.monitor import alert_escalation, latency_alerts
from quarry.plans import QUERIES
from quarry.plans import fixtures as fx
from quarry.session import scratch_path
from quarry.streaming import alerts as sa
from quarry.streaming import bookings as sb

SF = "/root/testdata/sf0.001"


def test_one_hot_drops_alphabetically_first(spark):
    df = spark.createDataFrame([(1, "y"), (2, "x"), (3, "z"), (4, None)], "n int, c string")
    out = mf.one_hot_drop_first(df, ["c"])
    assert out.columns == ["n", "c_y", "c_z"]
    got = {r.n: (r.c_y, r.c_z) for r in out.collect()}
    assert got == {1: (1, 0), 2: (0, 0), 3: (0, 1), 4: (0, 0)}


def test_split_is_stable_under_repartition(spark):
    df = spark.range(5000).withColumnRenamed("id", "row_id")
    a = {r.row_id for r in mf.split_column(df, "row_id").filter("split = 'test'").collect()}
    b = {r.row_id for r in mf.split_column(df.repartition(7), "row_id").filter("split = 'test'").collect()}
    assert a == b and 800 < len(a) < 1200


def vectors(spark, x, y, fold=None):
    rows = [(i, *map(float, r), float(t), int(i % 3 if fold is None else fold)) for i, (r, t) in enumerate(zip(x, y))]
    names = [f"x{j}" for j in range(x.shape[1])]
    df = spark.createDataFrame(rows, "row_id long, " + ", ".join(f"{n} double" for n in names) + ", label double, fold int")
    return VectorAssembler(inputCols=names, outputCol="features").transform(df).repartition(4)


def test_ridge_matches_closed_form(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(200, 3)) + [0, 1e6, -50]
    y = x @ np.array([1.5, -2.0, 0.5]) + 3.0 + rng.normal(scale=0.3, size=200)
    model = li.ridge(vectors(spark, x, y), 1.0)
    xc, yc = x - x.mean(0), y - y.mean()
    w = np.linalg.solve(xc.T @ xc + np.eye(3), xc.T @ yc)
    assert np.allclose(model.coefficients.toArray(), w, rtol=1e-8)
    assert math.isclose(model.intercept, y.mean() - x.mean(0) @ w, rel_tol=1e-8)


def test_fold_fits_equal_separate_fits(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(301, 4)) * [1, 100, 1e-3, 5] + [7, 1500, 0, 0]
    y = 5e4 + x @ np.array([3.0, -1.0, 250.0, 0.0]) + rng.normal(size=301)
    data = vectors(spark, x, y)
    full, folds = li.fold_fits(data)
    assert sorted(folds) == [0, 1, 2]
    for model, own in [(full, np.ones(301, bool)), *((m, np.arange(301) % 3 != k) for k, m in folds.items())]:
        want = np.linalg.lstsq(np.column_stack([np.ones(own.sum()), x[own]]), y[own], rcond=None)[0]
        assert np.allclose([model.intercept, *model.coefficients], want, rtol=1e-9, atol=1e-9)
    ours = full.transform(data).select("row_id", "prediction").toPandas().set_index("row_id").prediction
    assert np.allclose(ours.sort_index(), full.intercept + x @ full.coefficients.toArray())


def test_linear_fit_of_repeated_and_constant_columns(spark):
    rng = np.random.default_rng(2)
    a = rng.normal(size=50)
    data = vectors(spark, np.column_stack([a, a, np.full(50, 3.0)]), 2 * a + 1)
    model, _ = li.fold_fits(data)
    assert np.allclose(model.coefficients.toArray(), [1, 1, 0]) and math.isclose(model.intercept, 1)
    with pytest.raises(ValueError, match="needs rows"):
        li.fold_fits(data.limit(0))


def small_forest(spark, trees=7, depth=5, rows=600):
    l = fx.Tables(spark, SF)("lineitem").limit(rows)
    df = l.select(F.monotonically_increasing_id().alias("row_id"), "l_quantity", "l_discount", "l_tax",
                  "l_extendedprice")
    data = mf.assemble(df, ["l_quantity", "l_discount", "l_tax"], "l_extendedprice", keep=["row_id"]).cache()
    return data, mm.random_forest(num_trees=trees, max_depth=depth).fit(data)


def coalition_value(tree, x, s, node=0):
    """The expectation of a tree when only the features in ``s`` are known."""
    if tree.left[node] < 0:
        return float(tree.value[node])
    left, right, f = int(tree.left[node]), int(tree.right[node]), int(tree.feature[node])
    if f in s:
        return coalition_value(tree, x, s, left if x[f] <= tree.threshold[node] else right)
    n = tree.cover[node]
    return (tree.cover[left] * coalition_value(tree, x, s, left)
            + tree.cover[right] * coalition_value(tree, x, s, right)) / n


def enumerated(trees, x, p):
    phi = np.zeros(p)
    for i in range(p):
        rest = [j for j in range(p) if j != i]
        for k in range(p):
            for s in itertools.combinations(rest, k):
                w = math.factorial(k) * math.factorial(p - 1 - k) / math.factorial(p)
                phi[i] += w * sum(coalition_value(t, x, {*s, i}) - coalition_value(t, x, set(s)) for t in trees)
    return phi


def random_tree(rnd, p, depth):
    """Any tree over ``p`` features that repeat along paths."""
    nodes = []

    def grow(cover, d):
        at = len(nodes)
        nodes.append(None)
        if d == 0 or cover < 2 or rnd.random() < 0.1:
            nodes[at] = (-1, -1, -1, 0.0, cover, rnd.normal())
            return at
        cut = int(rnd.integers(1, cover))
        f, t = int(rnd.integers(p)), float(rnd.integers(0, 6))
        left = grow(cut, d - 1)
        nodes[at] = (left, grow(cover - cut, d - 1), f, t, cover, 0.0)
        return at

    grow(400, depth)
    left, right, f, t, cover, value = (np.array(c) for c in zip(*nodes))
    return at.Tree(left, right, f, t, cover.astype(float), value)


@pytest.mark.parametrize("leaves,bits", [(4, 10), (1, 0), (8, 4), (10**6, 0)])
def test_shapley_equals_subset_enumeration(monkeypatch, leaves, bits):
    """Whatever is tabulated together, and for tables of all patterns or of those that occur."""
    monkeypatch.setattr(at, "TABLE_LEAVES", leaves)
    monkeypatch.setattr(at, "TABLE_BITS", bits)
    rnd = np.random.default_rng(11)
    trees = [random_tree(rnd, 5, 7) for _ in range(3)] + [random_tree(rnd, 5, 0)]
    x = rnd.integers(-1, 7, (40, 5)).astype(float)
    got = at.shapley_block(trees, x)
    for row in range(0, 40, 5):
        assert np.allclose(got[row], enumerated(trees, x[row], 5), atol=1e-12)
    full = [sum(coalition_value(t, r, set(range(5))) for t in trees) for r in x]
    assert np.allclose(got.sum(axis=1) + sum(t.base() for t in trees), full, atol=1e-12)


def test_a_leaf_is_worked_out_once_per_pattern_of_its_path(monkeypatch):
    """However many rows there are and however many conditions are tabulated with it."""
    asked = []
    real = at.leaf_values
    monkeypatch.setattr(at, "leaf_values", lambda v, o, z: asked.append((len(z), o.shape[1])) or real(v, o, z))
    rnd = np.random.default_rng(5)
    tree = random_tree(rnd, 5, 9)
    x = rnd.integers(-1, 7, (50_000, 5)).astype(float)
    got = at.shapley_block([tree], x)
    assert asked and all(patterns <= 1 << d for d, patterns in asked)
    for row in (0, 20_000, 49_999):
        assert np.allclose(got[row], enumerated([tree], x[row], 5), atol=1e-12)


@pytest.mark.parametrize("room,lines", [(0, 1 << 13), (20_000, 1 << 13), (1 << 28, 40)])
def test_shapley_where_tables_are_not_kept(monkeypatch, room, lines):
    """For lack of room or for their many lines, over chunks, with values that no condition tells apart."""
    monkeypatch.setattr(at, "KEPT_BYTES", room)
    monkeypatch.setattr(at, "TABLE_LINES", lines)
    monkeypatch.setattr(at, "CHUNK", 16)
    rnd = np.random.default_rng(3)
    tree = random_tree(rnd, 5, 8)
    x = rnd.integers(-1, 7, (60, 5)).astype(float)
    x[5, 0], x[6, 1], x[7, 2] = np.nan, np.inf, -np.inf
    got = at.shapley_block([tree], x)
    for row in (0, 5, 6, 7, 30, 59):
        assert np.allclose(got[row], enumerated([tree], x[row], 5), atol=1e-12)


def test_tree_shap_additivity(spark):
    data, model = small_forest(spark)
    pred = model.transform(data).select("row_id", "prediction")
    for groups in (1, 3, 50):
        shap = at.tree_shap(data, model, groups=groups)
        chk = shap.join(pred, "row_id").select(
            (F.col("base_value") + F.aggregate("phi", F.lit(0.0), lambda a, b: a + b) - F.col("prediction")).alias("e"))
        row = chk.agg(F.max(F.abs("e")), F.count("*")).first()
        assert row[0] < 1e-6 and row[1] == data.count()


def test_tree_shap_of_a_fitted_forest_is_exact(spark):
    data, model = small_forest(spark, trees=3, depth=6, rows=300)
    trees = at.read_trees(at.node_table(spark, model), at.tree_weights(model))
    rows = {r["row_id"]: r["features"].toArray() for r in data.limit(6).collect()}
    got = {r["row_id"]: r["phi"] for r in at.tree_shap(data, model).collect()}
    assert len(got) == data.count()
    for k, x in rows.items():
        want = enumerated(trees, x, 3)
        assert np.allclose(got[k], want, rtol=1e-9, atol=1e-6)


def test_tree_groups_hold_their_bound():
    sizes = dict(enumerate([9, 1, 5, 5, 30, 2, 2]))
    for least, most in ((1, 100), (3, 100), (1, 12), (50, 100), (2, 1)):
        groups = at.tree_groups(sizes, least, most)
        assert sorted(t for g in groups for t in g) == sorted(sizes) and len(groups) >= min(least, len(sizes))
        assert all(len(g) == 1 or sum(sizes[t] for t in g) <= most for g in groups)


def test_alert_stream_equals_batch(spark):
    events = fx.Tables(spark, SF)("events")
    src = scratch_path(spark, "test_alert_src")
    events.write.parquet(src)
    stream = sa.alert_stream(spark.readStream.schema(events.schema).parquet(src), width="1 hour", threshold=60.0,
                             watermark="1 hour")
    q = stream.writeStream.format("memory").queryName("alerts_test").outputMode("complete").start()
    q.processAllAvailable()
    q.stop()
    got = spark.table("alerts_test").select(F.col("window_start").cast("timestamp_ntz").alias("w"), "n")
    batch = latency_alerts(events, "ts", "value", "1 hour", 60.0).select(F.col("window_start").alias("w"), "n")
    assert got.exceptAll(batch).count() == 0 and batch.exceptAll(got).count() == 0


def test_registered_alert_stream_returns_every_window(spark):
    got = QUERIES["latency_alerts_stream"](spark, SF)
    batch = QUERIES["latency_alerts"](spark, SF).select(*got.columns)
    assert got.agg(F.sum("n")).first()[0] == fx.Tables(spark, SF)("events").count()
    assert got.exceptAll(batch).count() == 0 and batch.exceptAll(got).count() == 0


def test_what_if_scores_like_separate_scoring(spark):
    rows = spark.range(200).select(F.col("id").alias("row_id"), (F.col("id") % 7).cast("double").alias("x"),
                                   (F.col("id") % 5).cast("double").alias("z"))
    train = VectorAssembler(inputCols=["x", "z"], outputCol="features").transform(
        rows.withColumn("label", F.col("x") * 2 + F.col("z")))
    model = li.ridge(train, 0.0)
    got = what_if(model, rows, ["x", "z"], "x", [1.0, 3.0])
    assert got.count() == 400 and "Join" not in got._jdf.queryExecution().executedPlan().toString()
    bad = got.filter(F.abs(F.col("delta") - 2 * (F.col("scenario_value") - F.col("original_value"))) > 1e-6)
    assert bad.count() == 0


def test_what_if_query_scores_every_row(spark, monkeypatch):
    """Rows of both parts of the split."""
    from quarry.plans import models as pm

    wide = spark.range(100).selectExpr("id as row_id", "cast(id % 7 as double) as l_quantity", "cast(id % 5 as double) as z")
    lb = object.__new__(pm.Lab)
    lb.spark, lb.wide, lb.names = spark, wide, ["l_quantity", "z"]
    data = mf.split_column(mf.assemble(wide.withColumn("y", F.col("l_quantity") * 2), lb.names, "y", keep=["row_id"]), "row_id")
    lb.train, lb.test = data.filter("split = 'train'"), data.filter("split = 'test'")
    lb._models = {"tuned_forest": li.ridge(lb.train, 0.0)}
    monkeypatch.setattr(pm, "lab", lambda spark, sf_dir: lb)
    got = QUERIES["what_if_scoring"](spark, "").groupBy("row_id").count().collect()
    assert sorted(r["row_id"] for r in got) == list(range(100))
    assert all(r["count"] == len(pm.WHAT_IF_VALUES) for r in got)


def test_alert_escalation_positions(spark):
    import datetime as dt

    base = dt.datetime(2024, 1, 1)
    rows = [(base + dt.timedelta(minutes=m), base + dt.timedelta(minutes=m + 1), 1.0, a)
            for m, a in [(0, False), (1, True), (2, True), (3, True), (4, False), (5, True), (7, True)]]
    alerts = spark.createDataFrame(rows, "window_start timestamp_ntz, window_end timestamp_ntz, avg_value double, "
                                         "alert boolean")
    got = [(r.run_position, r.action) for r in alert_escalation(alerts).orderBy("window_start").collect()]
    assert got == [(1, "scale_out"), (2, "cache"), (3, "none"), (1, "scale_out"), (1, "scale_out")]


@pytest.mark.parametrize("chunks", [3])
def test_booking_stream_equals_batch_in_arrival_order(spark, chunks):
    t = fx.Tables(spark, SF)
    req = fx.requests(t)
    src = scratch_path(spark, "test_booking_src")
    bounds = np.quantile([r.request_id for r in req.select("request_id").collect()], np.linspace(0, 1, chunks + 1))
    for i in range(chunks):
        lo, hi = bounds[i], bounds[i + 1]
        part = req.filter((F.col("request_id") >= lo) & ((F.col("request_id") < hi) | F.lit(i == chunks - 1)))
        part.coalesce(1).write.mode("append").parquet(src)
    out, ckpt = scratch_path(spark, "test_booking_out"), scratch_path(spark, "test_booking_ckpt")
    q = sb.start_booking_stream(spark, src, req.schema, fx.held(t), fx.doctors(t), fx.patients(t), out, ckpt,
                                max_files_per_trigger=1)
    q.awaitTermination()
    streamed = sb.read_decisions(spark, out)
    assert streamed.select("batch_id").distinct().count() == chunks
    batch = bk.admit_bookings(req, fx.held(t), fx.doctors(t), fx.patients(t))
    a = streamed.select("request_id", "outcome")
    b = batch.select("request_id", "outcome")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_attribution_explains_the_reported_forest(spark):
    from quarry.plans.models import Lab

    rows = spark.range(400).selectExpr("id as row_id", "array(id % 37, id % 11) as x", "cast(id % 37 * (id % 11) as double) as label")
    from pyspark.ml.functions import array_to_vector

    lb = object.__new__(Lab)
    lb.spark, lb.names = spark, ["a", "b"]
    lb.train = rows.select("row_id", "label", array_to_vector(rows["x"].cast("array<double>")).alias("features"))
    forest = mm.random_forest(max_depth=9).setNumTrees(5).fit(lb.train)
    lb._models = {"random_forest": forest}
    told = {r["row_id"]: r["v"] for r in lb.shap().groupBy("row_id").agg(
        (F.first("base_value") + F.sum("phi")).alias("v")).collect()}
    want = {r["row_id"]: r["prediction"] for r in forest.transform(lb.train).collect()}
    assert all(abs(told[k] - want[k]) < 1e-6 for k in want)


def unbagged(trees, depth):
    return mm.random_forest(num_trees=trees, max_depth=depth).setBootstrap(False).setSubsamplingRate(1.0)


def test_cut_trees_equal_trees_grown_shallower(spark):
    """On the same bagged rows (one seed, one number of trees) a depth cut is the
    tree grown to that depth."""
    data, deep = small_forest(spark, trees=5, depth=7)
    trees = at.read_trees(at.node_table(spark, deep), [1.0] * 5)
    rows = data.orderBy("row_id").collect()
    x = np.array([r["features"].toArray() for r in rows])
    cut = sum(tr.cut_predictions(t, x.T, [2, 4, 7, 30], [2]) for t in trees)[:, 0] / 5
    for i, depth in enumerate([2, 4, 7, 7]):
        grown = deep if depth == 7 else mm.random_forest(num_trees=5, max_depth=depth).fit(data)
        want = [r["prediction"] for r in grown.transform(data).orderBy("row_id").collect()]
        assert np.allclose(cut[i], want, rtol=1e-12)


def test_cut_trees_do_not_split_small_nodes(spark):
    """Without bagging a node's rows are known: its prediction is their mean, and
    exactly the nodes with enough rows are split."""
    data, _ = small_forest(spark, trees=1, depth=2, rows=250)
    model = unbagged(1, 8).fit(data)
    tree = at.read_trees(at.node_table(spark, model), [1.0])[0]
    rows = data.collect()
    x, y = np.array([r["features"].toArray() for r in rows]), np.array([r["label"] for r in rows])

    def grown(own, node, least, depth):
        if depth == 0 or tree.left[node] < 0 or own.sum() < least:
            return np.where(own, y[own].mean(), 0.0)
        left = own & (x[:, tree.feature[node]] <= tree.threshold[node])
        return grown(left, tree.left[node], least, depth - 1) + grown(own & ~left, tree.right[node], least, depth - 1)

    got = tr.cut_predictions(tree, x.T, [3, 8], [2, 5, 10, 1000])
    for i, depth in enumerate([3, 8]):
        for k, least in enumerate([2, 5, 10, 1000]):
            assert np.allclose(got[i, k], grown(np.ones(len(y), bool), 0, least, depth))
    for k, least in enumerate([2, 5, 10, 1000]):
        loaded = tr.without_small_splits(spark, model, least).transform(data)
        assert np.allclose([r["prediction"] for r in loaded.collect()], got[1, k])


def test_grid_scores_equal_separate_fits(spark):
    data, _ = small_forest(spark, trees=1, depth=1, rows=500)
    data = mf.fold_column(data, "row_id", k=2)
    grid = tr.Grid((1, 2), (2, 5), (2, 6))
    table, best = va.grid_search(unbagged(1, 1), grid, data, k=2)
    got = {(r.num_trees, r.max_depth, r.min_samples_split): r.mean_r2 for r in table.collect()}
    assert set(got) == set(grid.candidates()) and [r.is_best for r in table.collect()].count(True) == 1
    for (trees, depth, least), r2 in got.items():  # unbagged trees are alike, so their number does not matter
        scores = []
        for fold in range(2):
            m = tr.without_small_splits(spark, unbagged(trees, depth).fit(data.filter(F.col("fold") != fold)), least)
            own = m.transform(data.filter(F.col("fold") == fold)).select("label", "prediction").toPandas()
            scores.append(1 - ((own.label - own.prediction) ** 2).sum() / ((own.label - own.label.mean()) ** 2).sum())
        assert math.isclose(r2, np.mean(scores), rel_tol=1e-9)
    assert best.transform(data).count() == data.count()


class _Rows:
    """In place of an estimator: the sizes of the partitions that it is fit on."""

    def fit(self, df):
        return df.rdd.glom().map(len).collect()


def test_spread_bounds_the_rows_of_a_task(spark):
    df = spark.range(0, 1000, 1, 2).withColumnRenamed("id", "row_id")
    sizes = mm.Spread(_Rows(), rows=100).fit(df)
    assert len(sizes) == 10 and max(sizes) < 200 and sum(sizes) == 1000
    assert mm.Spread(_Rows(), rows=500).fit(df) == [500, 500]


def test_boosting_of_the_models_is_spread(spark):
    from quarry.plans.models import Lab

    boosting = Lab.estimators(None)["gradient_boosting"]
    assert isinstance(boosting, mm.Spread) and boosting.rows <= 500_000


def test_forest_without_large_node_ids_is_the_same(spark):
    from pyspark.ml.functions import array_to_vector

    from quarry.plans.models import Lab

    assert isinstance(Lab.estimators(None)["random_forest"], mm.Forest)
    rf = mm.random_forest(num_trees=5, max_depth=6)
    # 29 million rows of 100 trees: 12 GB of ids, several times over.
    assert mm.keep_node_ids(mm.random_forest(), 2_900_000).getCacheNodeIds()
    assert not mm.keep_node_ids(mm.random_forest(), 29_000_000).getCacheNodeIds()
    rows = spark.range(0, 500, 1, 3).selectExpr("array(id % 37, id % 11) as x", "cast(id % 37 * (id % 11) as double) as label")
    rows = rows.select("label", array_to_vector(rows["x"].cast("array<double>")).alias("features"))
    grown = [mm.Forest(rf, most).fit(rows).toDebugString.split("\n", 1)[1] for most in (0, 1 << 30)]
    assert grown[0] == grown[1]
