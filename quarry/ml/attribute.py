"""Exact path-dependent Shapley attribution for tree ensembles.

For one tree, the value of a coalition S of features is
``v(S) = sum_leaves value * prod_{j on path} (j in S ? o_j(x) : z_j)`` where
``o_j`` says whether x satisfies all of the path's conditions on feature j and
``z_j`` is the product of child/parent cover ratios of those conditions (the
path-dependent expectation TreeSHAP uses).  A leaf's Shapley values are an
integral over the unit interval,

    phi_i = value * (o_i - z_i) * int prod_{j != i} (t o_j + (1 - t) z_j) dt,

whose integrand is a polynomial of degree d - 1 for d features on the path, so
a Gauss-Legendre rule of ceil(d / 2) points gives it exactly: linear in d, with
no coefficients to expand or to divide out.

What a row adds to ``phi`` below a node depends on the row only through bits:
one per feature on the path so far (are its conditions met?) and one per
condition below.  So rows walk the tree together, a chunk at a time, and carry
one integer of bits per row; at a node with few leaves below it the sum over these
leaves is tabulated once per tree and block for all bit patterns that are possible,
and every row looks its own up.  A leaf is worked out for the patterns of its own
path's bits, whatever else the table tells apart.

Work split: the trees are dealt into groups, each with its own broadcast table
of nodes (at most ``NODES`` nodes, or one tree); each task scores a partition of
rows against one group; with several groups the partial sums are added by row.
There are as many groups as are needed to keep all cores busy when the rows have
few partitions, and to hold the bound.  Summaries are ordinary grouped
aggregates.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.ml.forest import GrownRandomForest
from quarry.session import materialize, scratch_path, ship_package

#: Most nodes of a broadcast group of trees (about 50 bytes each).
NODES = 2_000_000
#: Most numbers of a block of rows (rows times features).
CELLS = 1 << 22
#: Rows that walk a tree together, so that what they touch stays in cache.
CHUNK = 1 << 13
#: Most leaves below a node that are tabulated together, and the most bits and lines
#: of a table that is kept for all rows of a block; beyond that each chunk of rows
#: has a table of the patterns that occur in it.
TABLE_LEAVES = 8
TABLE_BITS = 16
TABLE_LINES = 1 << 13
#: Bytes of the tables that are kept of a tree.
KEPT_BYTES = 1 << 28


@dataclass
class Tree:
    """Nodes as arrays, node 0 the root; ``left`` is -1 at leaves."""

    left: np.ndarray
    right: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    cover: np.ndarray
    value: np.ndarray

    def base(self) -> float:
        """The value of the empty coalition."""
        leaf = self.left < 0
        return float((self.value * self.cover)[leaf].sum() / self.cover[0])

    def leaves_below(self) -> np.ndarray:
        n = (self.left < 0).astype(np.int64)
        for i in range(len(n) - 1, -1, -1):  # children have larger numbers
            if self.left[i] >= 0:
                n[i] = n[self.left[i]] + n[self.right[i]]
        return n


@lru_cache(maxsize=64)
def unit_rule(points: int) -> tuple[np.ndarray, np.ndarray]:
    """Gauss-Legendre points and weights on the unit interval."""
    t, w = np.polynomial.legendre.leggauss(max(1, points))
    return (t + 1) / 2, w / 2


def leaf_values(value: float, o: np.ndarray, z: np.ndarray) -> np.ndarray:
    """Shapley values of a leaf, d x patterns: ``o`` is d x patterns (0 or 1),
    ``z`` has d."""
    t, w = unit_rule((len(z) + 1) // 2)
    g = t[:, None] * o[:, None, :] + ((1 - t) * z[:, None])[:, :, None]      # d x points x patterns
    whole = w[:, None] * g.prod(axis=0)
    rest = (whole / np.where(g > 0, g, 1.0)).sum(axis=1)
    return value * (o - z[:, None]) * rest


class _Scorer:
    """One tree; adds its values of blocks of rows to ``phi`` (features x rows)."""

    def __init__(self, tree: Tree):
        self.tree = tree
        self.below = tree.leaves_below()
        self.kept: dict[int, tuple[np.ndarray, dict[int, np.ndarray]]] = {}
        self.room = KEPT_BYTES

    def run(self, x: np.ndarray, phi: np.ndarray) -> None:
        self.x, self.phi = x, phi
        self.buffer, self.held, self.met = (np.empty(x.shape[1], kind) for kind in (float, np.int64, bool))
        self._walk(0, np.zeros(x.shape[1], np.int64), [], np.empty(0), {})

    def _walk(self, node: int, bits: np.ndarray, path: list[int], z: np.ndarray,
              spans: dict[int, tuple[float, float]]) -> None:
        """``path``: features so far, bit ``j`` of ``bits`` is for ``path[j]``: is the
        feature in its span, above the first and up to the second number?"""
        t = self.tree
        if self.below[node] <= TABLE_LEAVES:
            self._tabulated(node, bits, path, z, spans)
            return
        f, cut = int(t.feature[node]), float(t.threshold[node])
        met = (self.x[f] <= cut).astype(np.int64)
        low, high = spans.get(f, (-math.inf, math.inf))
        for child, on, span in ((int(t.left[node]), met, (low, min(high, cut))),
                                (int(t.right[node]), 1 - met, (max(low, cut), high))):
            ratio = t.cover[child] / t.cover[node]
            if f in path:
                j = path.index(f)
                self._walk(child, bits & ((on << j) | ~(1 << j)), path, _times(z, j, ratio), {**spans, f: span})
            else:
                self._walk(child, bits | (on << len(path)), [*path, f], np.append(z, ratio), {**spans, f: span})

    def _tabulated(self, node: int, bits: np.ndarray, path: list[int], z: np.ndarray,
                   spans: dict[int, tuple[float, float]]) -> None:
        t = self.tree
        inner = self._inner(node)
        d = len(path)
        bits = bits.copy()
        for k, i in enumerate(inner):
            np.less_equal(self.x[t.feature[i]], t.threshold[i], out=self.met)
            np.multiply(self.met, 1 << (d + k), out=self.held)
            bits |= self.held
        if node in self.kept:
            place, table = self.kept[node]
            line = np.take(place, bits, out=self.held, mode="clip")
        else:
            table: dict[int, np.ndarray] = {}
            patterns = self._possible(inner, path, spans)
            if patterns is None:
                patterns, line = np.unique(bits, return_inverse=True)
            else:
                place = np.zeros(1 << (d + len(inner)), np.int64)
                place[patterns] = np.arange(len(patterns))
                line = place[bits]
                self.kept[node] = place, table
            met = {i: (patterns >> (d + k)) & 1 for k, i in enumerate(inner)}
            self._leaves(node, patterns & ((1 << d) - 1), z, path, met, table)
        for f, column in table.items():
            np.take(column, line, out=self.buffer, mode="clip")
            self.phi[f] += self.buffer

    def _possible(self, inner: list[int], path: list[int], spans: dict[int, tuple[float, float]]) -> np.ndarray | None:
        """All bit patterns that any row can have at a node: conditions on the same
        feature go together.  None where a table of them would be large."""
        t = self.tree
        d = len(path)
        if d + len(inner) > TABLE_BITS:
            return None
        patterns = np.zeros(1, np.int64)
        for f in sorted({*path, *(int(t.feature[i]) for i in inner)}):
            cuts = {float(t.threshold[i]) for i in inner if t.feature[i] == f}
            low, high = spans.get(f, (-math.inf, math.inf))
            # One value of every interval between the numbers it is compared with.
            values = np.array(sorted({*cuts, low, high, math.inf} - {-math.inf}))
            own = np.zeros(len(values), np.int64)
            if f in path:
                own |= ((low < values) & (values <= high)).astype(np.int64) << path.index(f)
            for k, i in enumerate(inner):
                if t.feature[i] == f:
                    own |= (values <= t.threshold[i]).astype(np.int64) << (d + k)
            patterns = (patterns[:, None] | np.unique(own)[None, :]).ravel()
            if len(patterns) > TABLE_LINES:
                return None
        size = 8 * ((1 << d + len(inner)) + len(patterns) * len({*path, *(int(t.feature[i]) for i in inner)}))
        if size > self.room:
            return None
        self.room -= size
        return patterns

    def _inner(self, node: int) -> list[int]:
        t = self.tree
        if t.left[node] < 0:
            return []
        return [node, *self._inner(int(t.left[node])), *self._inner(int(t.right[node]))]

    def _leaves(self, node, bits, z, path, met, table) -> None:
        """The leaves below ``node`` for the patterns: bit ``j`` of ``bits`` is for
        ``path[j]``, ``met`` has the conditions below."""
        t = self.tree
        if t.left[node] < 0:
            if path:
                d = len(path)
                # A leaf's values depend on the path's bits alone, so few patterns do.
                few = 1 << d <= len(bits)
                o = (((np.arange(1 << d) if few else bits) >> np.arange(d)[:, None]) & 1).astype(float)
                for f, phi in zip(path, leaf_values(float(t.value[node]), o, z)):
                    phi = phi[bits] if few else phi
                    table[f] = table[f] + phi if f in table else phi
            return
        f, hit = int(t.feature[node]), met[node]
        for child, on in ((int(t.left[node]), hit), (int(t.right[node]), 1 - hit)):
            ratio = t.cover[child] / t.cover[node]
            if f in path:
                j = path.index(f)
                self._leaves(child, bits & ((on << j) | ~(1 << j)), _times(z, j, ratio), path, met, table)
            else:
                self._leaves(child, bits | (on << len(path)), np.append(z, ratio), [*path, f], met, table)


def _times(z: np.ndarray, j: int, ratio: float) -> np.ndarray:
    out = z.copy()
    out[j] *= ratio
    return out


def shapley_block(trees: Sequence[Tree], x: np.ndarray) -> np.ndarray:
    """``phi`` (rows x features) of a block of rows (rows x features)."""
    columns = np.ascontiguousarray(x.T)
    phi = np.zeros(columns.shape)
    for tree in trees:
        if tree.left[0] >= 0:
            scorer = _Scorer(tree)
            for at in range(0, len(x), CHUNK):
                scorer.run(columns[:, at:at + CHUNK], phi[:, at:at + CHUNK])
    return phi.T


# ------------------------------------------------------------ the model -----

def node_table(spark: SparkSession, model) -> DataFrame:
    """The saved model's nodes, ``tree, id, left, right, feature, threshold,
    cover, value``; a property of the model, not of the data."""
    if isinstance(model, GrownRandomForest):
        return materialize(model.nodes(), "tree_model")
    path = scratch_path(spark, "tree_model")
    model.write().overwrite().save(path)
    nodes = spark.read.parquet(f"{path}/data").select(
        F.col("treeID").alias("tree"), "nodeData.id", F.col("nodeData.leftChild").alias("left"),
        F.col("nodeData.rightChild").alias("right"), F.col("nodeData.split.featureIndex").alias("feature"),
        F.try_element_at(F.col("nodeData.split.leftCategoriesOrThreshold"), F.lit(1)).alias("threshold"),
        F.col("nodeData.rawCount").cast("double").alias("cover"), F.col("nodeData.prediction").alias("value"),
        F.col("nodeData.split.numCategories").alias("categories"))
    if not nodes.where("left >= 0 and categories > 0").isEmpty():
        raise ValueError("categorical splits are not supported; assemble 0/1 columns as plain numbers")
    return nodes.drop("categories")


def read_trees(nodes: DataFrame, weights: Sequence[float]) -> list[Tree]:
    """Trees of the given nodes, their values scaled by the trees' weights."""
    t = nodes.toArrow()
    col = {c: t.column(c).to_numpy() for c in t.column_names}
    order = np.lexsort((col["id"], col["tree"]))
    col = {c: v[order] for c, v in col.items()}
    cuts = np.flatnonzero(np.diff(col["tree"])) + 1
    out = []
    for a, b in zip([0, *cuts], [*cuts, len(order)]):
        if a < b:
            w = weights[int(col["tree"][a])]
            out.append(Tree(col["left"][a:b], col["right"][a:b], col["feature"][a:b],
                            np.nan_to_num(col["threshold"][a:b].astype(float)), col["cover"][a:b], col["value"][a:b] * w))
    return out


def tree_weights(model) -> list[float]:
    """What each tree counts for: a forest averages, boosting adds up."""
    n = len(model.trees)
    forest = "RandomForest" in type(model).__name__
    return [w / n if forest else w for w in model.treeWeights]


def tree_groups(sizes: dict[int, int], least: int, most_nodes: int = NODES) -> list[list[int]]:
    """Trees dealt into at least ``least`` groups (or one each) of about equal
    size, of at most ``most_nodes`` nodes where a group has several."""
    want = min(len(sizes), max(least, math.ceil(sum(sizes.values()) / most_nodes)))
    groups: list[list[int]] = [[] for _ in range(want)]
    load = [0] * want
    for tree in sorted(sizes, key=lambda t: (-sizes[t], t)):
        i = load.index(min(load))
        if load[i] and load[i] + sizes[tree] > most_nodes:
            groups.append([])
            load.append(0)
            i = len(load) - 1
        groups[i].append(tree)
        load[i] += sizes[tree]
    return [g for g in groups if g]


# ------------------------------------------------------------ the rows ------

def _scored(trees, key: str, width: int):
    def run(batches):
        group = trees.value
        rows = max(1, CELLS // width)
        held, size = [], 0

        def flush():
            table = pa.Table.from_batches(held).combine_chunks()
            x = table.column("x").combine_chunks().flatten().to_numpy().reshape(-1, width)
            phi = shapley_block(group, x)
            ends = np.arange(0, phi.size + 1, width, dtype=np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(phi.ravel()))
            return pa.RecordBatch.from_arrays([table.column(key).combine_chunks(), lists], names=[key, "phi"])

        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                part = batch.slice(at, rows)
                if size + part.num_rows > rows:
                    yield flush()
                    held, size = [], 0
                held.append(part)
                size += part.num_rows
        if size:
            yield flush()

    return run


def tree_shap(df: DataFrame, model, key: str = "row_id", features_col: str = "features",
              groups: int | None = None) -> DataFrame:
    """(key, base_value, phi array) for every row of ``df``, where
    ``base_value + sum(phi)`` equals the ensemble's prediction.  ``key`` tells
    rows apart.  ``groups``: the least number of groups of trees (by default
    what keeps all cores busy)."""
    spark = df.sparkSession
    ship_package(spark)
    nodes = node_table(spark, model)
    weights = tree_weights(model)
    sizes = {r["tree"]: r["n"] for r in nodes.groupBy("tree").agg(F.count("*").alias("n")).collect()}
    rows = df.select(key, vector_to_array(features_col).alias("x"))
    if groups is None:
        groups = math.ceil(2 * spark.sparkContext.defaultParallelism / max(1, rows.rdd.getNumPartitions()))
    kind = rows.schema[key].dataType.simpleString()
    base, parts = 0.0, []
    for own in tree_groups(sizes, groups):
        trees = read_trees(nodes.where(F.col("tree").isin(own)), weights)
        base += sum(t.base() for t in trees)
        parts.append(rows.mapInArrow(_scored(spark.sparkContext.broadcast(trees), key, model.numFeatures),
                                     f"`{key}` {kind}, phi array<double>"))
    if len(parts) == 1:
        return parts[0].select(key, F.lit(base).alias("base_value"), "phi")
    whole = parts[0]
    for p in parts[1:]:
        whole = whole.unionByName(p)
    added = whole.groupBy(key).agg(*[F.sum(F.col("phi")[i]).alias(f"p{i}") for i in range(model.numFeatures)])
    return added.select(key, F.lit(base).alias("base_value"),
                        F.array(*[f"p{i}" for i in range(model.numFeatures)]).alias("phi"))


def shap_long(shap: DataFrame, names: list[str], key: str = "row_id") -> DataFrame:
    """Long form (key, feature, phi)."""
    return shap.select(key, "base_value", F.posexplode("phi").alias("pos", "phi")).select(
        key, "base_value", F.element_at(F.array(*[F.lit(n) for n in names]), F.col("pos") + 1).alias("feature"),
        "phi")


def attribution_summary(long: DataFrame) -> DataFrame:
    """Per feature, mean |phi| (the ranking of a beeswarm plot) and the
    spread of the values."""
    return long.groupBy("feature").agg(
        F.avg(F.abs("phi")).alias("mean_abs_phi"),
        F.percentile_approx("phi", [0.05, 0.5, 0.95], 10_000).alias("_q"),
        F.min("phi").alias("min_phi"), F.max("phi").alias("max_phi"),
    ).select("feature", "mean_abs_phi", F.col("_q")[0].alias("p05"), F.col("_q")[1].alias("p50"),
             F.col("_q")[2].alias("p95"), "min_phi", "max_phi").orderBy(F.desc("mean_abs_phi"))


def attribution_row(long: DataFrame, row_key, key: str = "row_id") -> DataFrame:
    """Base value and contributions of one row, largest first."""
    return long.filter(F.col(key) == row_key).orderBy(F.desc(F.abs("phi")))
