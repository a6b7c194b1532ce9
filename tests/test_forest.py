from dataclasses import replace

import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from quarry.ml import attribute as at
from quarry.ml import forest as fo
from quarry.ml import models as mm
from quarry.ml import truncate as tr
from quarry.ml import validate as va


def rows_of(spark, x, y, parts=3):
    df = spark.createDataFrame([(i, list(map(float, r)), float(t)) for i, (r, t) in enumerate(zip(x, y))],
                               "row_id long, x array<double>, label double")
    return df.select("row_id", "label", array_to_vector("x").alias("features")).repartition(parts, "row_id")


def drawn(rnd, n=400):
    x = np.column_stack([rnd.integers(0, 6, n), rnd.integers(0, 2, n), rnd.normal(size=n), np.full(n, 3.0)])
    return x, x[:, 0] * 2 + np.where(x[:, 2] > 0.3, 5, 0) + rnd.normal(size=n)


def best_by_hand(codes, w, y):
    """Feature and bin that reduce the variance most, and by how much."""
    found = (-1, -1, 0.0)
    mean = np.average(y, weights=w)
    for f in range(codes.shape[1]):
        for c in range(codes[:, f].max() + 1):
            left = codes[:, f] <= c
            if left.any() and not left.all():
                gain = sum(w[p].sum() * (np.average(y[p], weights=w[p]) - mean) ** 2 for p in (left, ~left))
                if gain > found[2] * (1 + 1e-9) + 1e-9:
                    found = (f, c, gain)
    return found


def grown_by_hand(codes, w, y, depth):
    """Nested (feature, bin, left, right) or the mean at leaves."""
    f, c, gain = best_by_hand(codes, w, y) if depth and np.ptp(y) > 1e-12 else (-1, -1, 0.0)
    if f < 0:
        return np.average(y, weights=w)
    left = codes[:, f] <= c
    return f, c, *[grown_by_hand(codes[p], w[p], y[p], depth - 1) for p in (left, ~left)]


def scored_by_hand(node, code):
    while isinstance(node, tuple):
        node = node[2] if code[node[0]] <= node[1] else node[3]
    return node


@pytest.mark.parametrize("depth,bound", [(99, 10**6), (99, 60), (11, 60), (4, 10**6), (4, 60), (2, 1)])
def test_forest_equals_trees_grown_by_hand(spark, depth, bound):
    """In one task, and with tops that are grown by passes over all rows."""
    x, y = drawn(np.random.default_rng(4))
    data = rows_of(spark, x, y)
    model = fo.RandomForest(trees=3, depth=None if depth == 99 else depth, subtree_rows=bound).fit(data)
    codes = model.layout.codes(x)
    want = np.zeros(len(y))
    for tree in range(3):
        w = fo.draws(np.arange(len(y)), tree, 42)
        root = grown_by_hand(codes[w > 0], w[w > 0].astype(float), y[w > 0], depth)
        want += [scored_by_hand(root, c) / 3 for c in codes]
    got = {r["row_id"]: r["prediction"] for r in model.transform(data).collect()}
    assert np.allclose([got[i] for i in range(len(y))], want, atol=1e-9)
    # The nodes as rows say the same.
    trees = at.read_trees(model.nodes(), at.tree_weights(model))
    again = np.zeros(len(y))
    for t in trees:
        node = np.zeros(len(y), int)
        while (inner := t.left[node] >= 0).any():
            below = np.where(x[np.arange(len(y)), t.feature[node]] <= t.threshold[node], t.left[node], t.right[node])
            node = np.where(inner, below, node)
        again += t.value[node]
        assert all(t.cover[i] == t.cover[t.left[i]] + t.cover[t.right[i]] for i in np.flatnonzero(t.left >= 0))
    assert np.allclose(again, want, atol=1e-9)


def test_full_trees_tell_all_rows_apart(spark):
    x = np.arange(200.0)[:, None] % 16 * [1, 0] + np.arange(200)[:, None] // 16 * [0, 1]
    y = np.random.default_rng(1).normal(size=200)
    data = rows_of(spark, x, y)
    model = fo.RandomForest(trees=1, bootstrap=False).fit(data)
    off = model.transform(data).select(F.max(F.abs(F.col("prediction") - F.col("label")))).scalar()
    assert data.select(off.alias("off")).first()["off"] < 1e-9


def test_the_default_forest_has_no_depth_limit(spark):
    """A row apart from the rest at every level: a chain deeper than any limit of Spark's."""
    from quarry.plans.models import Lab

    estimator = Lab.estimators(None)["random_forest"]
    assert estimator.estimator.depth is None and estimator.estimator.trees == 100
    n = 36
    data = rows_of(spark, np.arange(n)[:, None], 2.6 ** np.arange(n))
    model = fo.RandomForest(trees=1, bootstrap=False, max_bins=64).fit(data)
    off = {r["row_id"]: r["prediction"] / r["label"] for r in model.transform(data).collect()}
    assert all(abs(v - 1) < 1e-9 for k, v in off.items() if k > 20)
    depth, ids = {0: 0}, model.nodes().orderBy("id").collect()
    for r in ids:
        if r["left"] >= 0:
            depth[r["left"]] = depth[r["right"]] = depth[r["id"]] + 1
    assert max(depth.values()) > 30


def test_explained_forest_is_the_first_levels_of_the_default_one(spark):
    x, y = drawn(np.random.default_rng(9))
    data = rows_of(spark, x, y)
    full = mm.Unlimited(fo.RandomForest(trees=2, subtree_rows=100))
    trees = [at.read_trees(e.fit(data).nodes(), [1.0, 1.0]) for e in (full, full.to_depth(3))]

    def same(a, i, b, j, depth):
        assert np.isclose(a.value[i], b.value[j]) and a.cover[i] == b.cover[j]
        if depth == 0 or a.left[i] < 0:
            assert b.left[j] < 0
        else:
            assert (a.feature[i], a.threshold[i]) == (b.feature[j], b.threshold[j])
            same(a, a.left[i], b, b.left[j], depth - 1)
            same(a, a.right[i], b, b.right[j], depth - 1)

    for a, b in zip(*trees):
        same(a, 0, b, 0, 3)


def test_forest_does_not_depend_on_the_partitions(spark):
    x, y = drawn(np.random.default_rng(2))
    found = []
    for parts, bound in ((1, 10**6), (7, 50)):
        data = rows_of(spark, x, y, parts)
        model = fo.RandomForest(trees=4, subtree_rows=bound).fit(data)
        found.append([r["prediction"] for r in model.transform(data).orderBy("row_id").collect()])
    assert np.allclose(*found)


def test_importances_are_the_variance_taken_away(spark):
    x, y = drawn(np.random.default_rng(3))
    data = rows_of(spark, x, y)
    for bound in (10**6, 50):
        model = fo.RandomForest(trees=1, depth=1, bootstrap=False, subtree_rows=bound).fit(data)
        f, _, _ = best_by_hand(model.layout.codes(x), np.ones(len(y)), y)
        assert model.featureImportances.toArray().tolist() == [float(i == f) for i in range(4)]
    whole = fo.RandomForest(trees=5, subtree_rows=50).fit(data).featureImportances.toArray()
    assert np.isclose(whole.sum(), 1) and whole[3] == 0 and whole[0] > whole[1]


def test_equal_rows_and_constant_labels(spark):
    """Many equal rows that no feature tells apart, more than a subtree may have."""
    x, y = np.repeat([[1.0, 2.0], [5.0, 2.0]], [300, 20], axis=0), np.arange(320.0) % 7
    model = fo.RandomForest(trees=2, bootstrap=False, subtree_rows=50).fit(data := rows_of(spark, x, y))
    got = {r["row_id"]: r["prediction"] for r in model.transform(data).collect()}
    assert np.allclose([got[0], got[319]], [y[:300].mean(), y[300:].mean()])
    flat = fo.RandomForest(trees=2, subtree_rows=50).fit(data := rows_of(spark, x, np.full(320, 0.1)))
    assert np.allclose([r["prediction"] for r in flat.transform(data).collect()], 0.1, rtol=1e-14)
    assert flat.featureImportances.toArray().tolist() == [0, 0]
    with pytest.raises(ValueError, match="needs rows"):
        fo.RandomForest().fit(data.limit(0))
    with pytest.raises(ValueError, match="every row"):
        fo.RandomForest().fit(data.withColumn("label", F.nullif("label", F.lit(0.1))))


def test_thresholds_are_between_all_values_or_at_quantiles():
    rnd = np.random.default_rng(0)
    assert fo.thresholds(np.array([1.0, 2.0, 4.0]), np.ones(3), 32).tolist() == [1.5, 3.0]
    assert fo.thresholds(np.array([7.0]), np.ones(1), 32).tolist() == []
    values = rnd.exponential(size=200_000)
    batch = pa.RecordBatch.from_arrays([pa.array(np.arange(len(values))), pa.array(values[:, None].tolist(), pa.list_(pa.float64()))],
                                       names=["key", "x"])
    part = next(fo._distribution(1, 33)([batch])).to_pylist()[0]
    cuts = fo.thresholds(np.array(part["v"]), np.array(part["n"]), 32)
    share = np.bincount(np.searchsorted(cuts, values), minlength=32) / len(values)
    assert len(cuts) == 31 and sum(part["n"]) == len(values) and abs(share - 1 / 32).max() < 0.004


def test_joint_counts_equal_separate_ones(monkeypatch):
    rnd = np.random.default_rng(6)
    x = np.column_stack([rnd.integers(0, k, 3000) for k in (40, 2, 2, 11, 3, 1)]).astype(float)
    layout = fo.Layout([fo.thresholds(*np.unique(c, return_counts=True), 32) for c in x.T])
    codes = layout.codes(x)
    node, w, y = rnd.integers(0, 2, 3000), rnd.integers(1, 4, 3000).astype(float), rnd.normal(size=3000)
    found = []
    for dense in (1, 10**9):
        monkeypatch.setattr(fo, "DENSE", dense)
        found.append(layout.sums(codes, layout.joint(codes), np.arange(3000), node, 2, w, w * y))
    assert layout.joint(codes).shape[1] < 6 and all(np.allclose(a, b) for a, b in zip(*found))


def test_draws_are_poisson_and_of_the_key():
    w = np.concatenate([fo.draws(np.arange(100_000), t, 42) for t in range(3)])
    share = np.bincount(w, minlength=5)[:5] / len(w)
    assert np.allclose(share, [0.3679, 0.3679, 0.1839, 0.0613, 0.0153], atol=0.004)
    keys = np.array([5, 900, 17])
    assert fo.draws(keys, 1, 42).tolist() == [int(fo.draws(keys[i:i + 1], 1, 42)[0]) for i in range(3)]
    a, b = (fo.draws(np.arange(100_000), t, 42).astype(float) for t in (0, 1))
    assert abs(np.corrcoef(a, b)[0, 1]) < 0.02


def test_unbagged_forest_equals_spark_ones(spark):
    """Without bagging a forest has no draws, so that both libraries grow the same trees."""
    rnd = np.random.default_rng(8)
    x = np.column_stack([rnd.integers(0, k, 700) for k in (30, 2, 9, 5)])
    data = rows_of(spark, x, x[:, 0] * (1 + x[:, 1]) + rnd.normal(size=700)).cache()
    for depth in (3, 8):
        want = mm.random_forest(num_trees=1, max_depth=depth).setBootstrap(False).fit(data)
        both = want.transform(data).select("row_id", F.col("prediction").alias("want"))
        for bound in (10**6, 100):
            model = fo.RandomForest(trees=2, depth=depth, bootstrap=False, subtree_rows=bound).fit(data)
            off = model.transform(data).join(both, "row_id").select(F.max(F.abs(F.col("prediction") - F.col("want"))).alias("off"),
                                                                   F.count("*").alias("n")).first()
            assert off["n"] == 700 and off["off"] < 1e-9
            assert np.allclose(model.featureImportances.toArray(), want.featureImportances.toArray(), atol=1e-3)  # ties


@pytest.mark.parametrize("bound", [10**6, 40])
def test_small_nodes_are_not_split(spark, bound):
    x, y = drawn(np.random.default_rng(12))
    data = rows_of(spark, x, y)
    whole, cut = (at.read_trees(fo.RandomForest(trees=2, depth=d, split=k, subtree_rows=bound).fit(data).nodes(), [1.0] * 2)
                  for d, k in ((7, 2), (7, 12)))
    for a, b in zip(whole, cut):
        kept = [(0, 0)]
        for i, j in kept:
            assert a.cover[i] == b.cover[j] and np.isclose(a.value[i], b.value[j])
            assert (b.left[j] >= 0) == (a.left[i] >= 0 and a.cover[i] >= 12)
            if b.left[j] >= 0:
                kept += [(a.left[i], b.left[j]), (a.right[i], b.right[j])]
        assert len(kept) == len(b.left)


def test_repeated_keys_are_scored_apart(spark):
    x, y = drawn(np.random.default_rng(5))
    data = rows_of(spark, x, y)
    model = fo.RandomForest(trees=2).fit(data)
    want = sorted(r["prediction"] for r in model.transform(data).collect())
    got = sorted(r["prediction"] for r in model.transform(data.withColumn("row_id", F.col("row_id") % 3)).collect())
    assert np.allclose(want, got) and len(set(want)) > 10


@pytest.mark.parametrize("bound", [10**6, 100])
def test_grid_reads_candidates_off_one_forest_a_fold(spark, bound):
    x, y = drawn(np.random.default_rng(7), 300)
    data = rows_of(spark, x, y).withColumn("fold", (F.col("row_id") % 2).cast("int")).cache()
    grid = tr.Grid((1, 3), (2, 5), (2, 30))
    rf = fo.RandomForest(subtree_rows=bound)
    table, best = va.grid_search(rf, grid, data, k=2)
    rows = table.collect()
    assert [(r.num_trees, r.max_depth, r.min_samples_split) for r in rows] == grid.candidates()
    for r in rows:
        scores = []
        for fold in range(2):
            m = replace(rf, trees=r.num_trees, depth=r.max_depth, split=r.min_samples_split).fit(data.filter(F.col("fold") != fold))
            own = m.transform(data.filter(F.col("fold") == fold)).select("label", "prediction").toPandas()
            scores.append(1 - ((own.label - own.prediction) ** 2).sum() / ((own.label - own.label.mean()) ** 2).sum())
        assert np.isclose(r.mean_r2, np.mean(scores))
    won = [r for r in rows if r.is_best]
    assert len(won) == 1 and won[0].mean_r2 == max(r.mean_r2 for r in rows) and len(best.trees) == won[0].num_trees
    again = replace(rf, trees=won[0].num_trees, depth=won[0].max_depth, split=won[0].min_samples_split).fit(data)
    found = [[r["prediction"] for r in m.transform(data).orderBy("row_id").collect()] for m in (best, again)]
    assert np.allclose(*found)
