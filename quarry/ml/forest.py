"""Bagged regression forests of any depth.

A forest of full depth has about as many leaves per tree as there are rows, so its
nodes neither fit the driver nor pay for a pass over all rows per level.  It is grown
in two steps:

1. The top of every tree grows level by level.  Tasks add up, for their rows and all
   trees, the count and the sum of the label per node, feature and bin; these are
   added by tree and the best split of every node is taken.  Nodes of more than
   ``SUBTREE_ROWS`` rows are split this way, so few levels need a pass.
2. The rows of every smaller node are dealt to a task by (tree, node), which grows
   all that is below.  The result is a table with one packed record per subtree.

Scoring deals rows out the same way, next to the table of subtrees; nothing of the
size of the rows or of the grown forest comes to the driver or to one task.

Continuous features are binned as by MLlib (all values where there are few, else
quantiles), splits reduce the variance most, the first feature wins ties, and a node
is a leaf when its labels are equal or no feature tells its rows apart.  How often a
row is in a tree's bag is a Poisson draw by a hash of seed, tree and row key: the
same on any partitioning.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.session import materialize, ship_package

#: Most rows (as often as they are drawn) of a node that is grown on by one task.
SUBTREE_ROWS = 1_000_000
#: Most levels that are grown by passes alone.
PASSES = 8
#: Rows that a task deals out or adds up together, and rows of a block that is scored.
BLOCK = 1 << 16
SCORED = 1 << 14
#: Rows and nodes whose sums are looked at together, so that they stay in cache.
CHUNK_ROWS = 1 << 14
CHUNK_NODES = 1 << 10
#: Weighted values that stand for a feature's distribution in a task.
POINTS = 1024
#: Most cells of a group of features that are counted together, and the rows a node
#: must have for it.
JOINT = 256
DENSE = 512
LEAF = 255

_POISSON = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(19)])


def draws(keys: np.ndarray, tree: int, seed: int) -> np.ndarray:
    """How often each row is in a tree's bag: Poisson of mean 1 (splitmix64 of the key)."""
    with np.errstate(over="ignore"):
        h = keys.astype(np.int64).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        h += np.uint64((seed * 0xD1342543DE82EF95 + (tree + 1) * 0xBF58476D1CE4E5B9) % (1 << 64))
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        h ^= h >> np.uint64(31)
    return np.searchsorted(_POISSON, (h >> np.uint64(11)) * 2.0 ** -53, side="right").astype(np.uint8)


# ------------------------------------------------------------ bins ----------

def _thinned(values: np.ndarray, counts: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Equal values merged; beyond ``most`` values those at equal ranks stand for the others."""
    values, place = np.unique(values, return_inverse=True)
    counts = np.bincount(place, counts, len(values))
    if len(values) <= most:
        return values, counts
    ends = np.cumsum(counts)
    at = np.unique(np.searchsorted(ends, np.linspace(0, ends[-1], most + 1)[1:]).clip(max=len(values) - 1))
    return values[at], np.diff(ends[at], prepend=0)


def _distribution(width: int, exact: int):
    def run(batches):
        held = [(np.empty(0), np.empty(0))] * width
        for _, x, _ in _blocks(batches, width):
            for f in range(width):
                v, n = held[f]
                v = np.concatenate([v, x[:, f]])
                held[f] = _thinned(v, np.concatenate([n, np.ones(len(x))]), max(exact, 8 * POINTS))
        held = [_thinned(v, n, max(exact, POINTS)) for v, n in held]
        yield pa.RecordBatch.from_arrays([pa.array(range(width), pa.int32()), pa.array([v for v, _ in held], pa.list_(pa.float64())),
                                          pa.array([n for _, n in held], pa.list_(pa.float64()))], names=["feature", "v", "n"])

    return run


def thresholds(values: np.ndarray, counts: np.ndarray, max_bins: int) -> np.ndarray:
    """Split points between sorted values: all, or those next to ``max_bins`` quantiles."""
    middle = (values[:-1] + values[1:]) / 2
    if len(values) <= max_bins:
        return middle
    stride = counts.sum() / max_bins
    target, seen, out = stride, counts[0], []
    for m, n in zip(middle, counts[1:]):
        if abs(seen - target) < abs(seen + n - target):
            out.append(m)
            target += stride
        seen += n
    return np.array(out[:max_bins - 1])


def find_thresholds(rows: DataFrame, width: int, max_bins: int) -> list[np.ndarray]:
    """Split points of every feature, from all rows in one scan; a task sends at most
    ``POINTS`` weighted values a feature."""
    parts = rows.mapInArrow(_distribution(width, max_bins + 1), "feature int, v array<double>, n array<double>").collect()
    out = []
    for f in range(width):
        own = [p for p in parts if p["feature"] == f]
        v, n = (np.concatenate([np.asarray(p[c], float) for p in own]) for c in ("v", "n"))
        out.append(thresholds(*_thinned(v, n, len(v) + 1), max_bins))
    return out


@dataclass
class Layout:
    """The cells of a node: the bins of all features side by side."""

    cuts: list[np.ndarray]

    def __post_init__(self):
        sizes = np.array([len(c) + 1 for c in self.cuts])
        self.start = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        self.cells = int(sizes.sum())
        self.feature = np.repeat(np.arange(len(sizes)), sizes)
        self.bin = np.arange(self.cells) - self.start[self.feature]
        self.last = self.bin == sizes[self.feature] - 1
        # Features of few bins count as one feature with a bin for each combination.
        groups: list[list[int]] = []
        for f in np.argsort(-sizes, kind="stable"):
            fits = [g for g in groups if sizes[g].prod() * sizes[f] <= JOINT]
            fits[0].append(int(f)) if fits else groups.append([int(f)])
        many = [int(sizes[g].prod()) for g in groups]
        self.joint_cells = sum(many)
        # What to multiply bin numbers by, and which cells of a combination a bin adds up.
        self.strides, self.offsets = np.zeros((len(sizes), len(groups)), np.int64), np.cumsum([0, *many[:-1]])
        self.apart = np.zeros((self.joint_cells, self.cells))
        for i, g in enumerate(groups):
            cells = np.arange(many[i])
            stride = 1
            for f in g:
                self.strides[f, i] = stride
                self.apart[self.offsets[i] + cells, self.start[f] + cells // stride % sizes[f]] = 1
                stride *= sizes[f]

    def codes(self, x: np.ndarray) -> np.ndarray:
        """Bin numbers, rows x features."""
        return np.column_stack([np.searchsorted(c, x[:, f], side="left").astype(np.uint8) for f, c in enumerate(self.cuts)])

    def joint(self, codes: np.ndarray) -> np.ndarray:
        """Cells of the combinations, rows x groups of features."""
        out = np.empty((len(codes), len(self.offsets)), np.int32)
        for i, offset in enumerate(self.offsets):
            own = np.flatnonzero(self.strides[:, i])
            out[:, i] = codes[:, own].astype(np.int32) @ self.strides[own, i].astype(np.int32) + offset
        return out

    def sums(self, codes: np.ndarray, joint: np.ndarray, rows: np.ndarray, node: np.ndarray, nodes: int, w: np.ndarray,
             wy: np.ndarray):
        """Count and label sum per node and cell, of the given rows."""
        dense = len(rows) >= DENSE * nodes and joint.shape[1] < codes.shape[1]
        cells = self.joint_cells if dense else self.cells
        n, s = np.zeros(nodes * cells), np.zeros(nodes * cells)
        for a in range(0, len(rows), CHUNK_ROWS):
            c = slice(a, a + CHUNK_ROWS)
            flat = joint.take(rows[c], axis=0) if dense else codes.take(rows[c], axis=0) + self.start
            at = (flat + (node[c] * cells)[:, None]).ravel()
            parts = [np.bincount(at, np.repeat(v[c], flat.shape[1]), nodes * cells) for v in (w, wy)]
            n, s = (n + parts[0], s + parts[1]) if a else parts
        n, s = n.reshape(nodes, -1), s.reshape(nodes, -1)
        return (n @ self.apart, s @ self.apart) if dense else (n, s)

    def best(self, n: np.ndarray, s: np.ndarray, least: int):
        """Feature, bin and gain of the best split of every node; rows up to the bin go left."""
        left_n, left_s = (self._up_to(v) for v in (n, s))
        first = slice(0, self.start[1] if len(self.start) > 1 else self.cells)
        all_n, all_s = n[:, first].sum(axis=1)[:, None], s[:, first].sum(axis=1)[:, None]
        right_n, right_s = all_n - left_n, all_s - left_s
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = left_s * left_s / left_n + right_s * right_s / right_n - all_s * all_s / all_n
        gain[(left_n < least) | (right_n < least) | self.last] = -np.inf
        cell = gain.argmax(axis=1)
        return self.feature[cell], self.bin[cell], gain[np.arange(len(cell)), cell]

    def _up_to(self, v: np.ndarray) -> np.ndarray:
        total = np.cumsum(v, axis=1)
        before = np.zeros((len(v), len(self.start)))
        before[:, 1:] = total[:, self.start[1:] - 1]
        return total - before[:, self.feature]


# ------------------------------------------------------------ growing -------

def grow(codes: np.ndarray, w: np.ndarray, y: np.ndarray, layout: Layout, depth: int | None, least: int, split: int, tiny: float):
    """All nodes below one node with its rows, breadth first, the children of the k-th
    inner node numbered 2k+1 and 2k+2: feature (``LEAF`` at leaves) and bin of every
    node, value and count of every leaf, gain by feature."""
    order = np.arange(len(y))
    sizes = np.array([len(y)])
    features, bins, values, covers = [], [], [], []
    gains = np.zeros(codes.shape[1])
    joint, flat = layout.joint(codes), codes.ravel()
    w = w.astype(float)
    level = 0
    while len(sizes):
        starts = np.cumsum(sizes) - sizes
        node = np.repeat(np.arange(len(sizes)), sizes)
        wo, yo = w[order], y[order]
        cover = np.add.reduceat(wo, starts)
        mean = np.add.reduceat(wo * yo, starts) / cover
        # From a node's own mean, so that its sums do not cancel.
        yo -= mean[node]
        spread = np.add.reduceat(wo * yo * yo, starts)
        feature, cut = np.full(len(sizes), LEAF, np.uint8), np.zeros(len(sizes), np.uint8)
        open_ = (sizes > 1) & (cover >= split) & (spread > cover * tiny * tiny) & (depth is None or level < depth)
        # Of two rows, any feature that differs takes all of the spread: the first one.
        two = np.flatnonzero(open_ & (sizes == 2))
        a, b = order[starts[two]], order[starts[two] + 1]
        f = (codes[a] != codes[b]).argmax(axis=1)
        enough = (w[a] >= least) & (w[b] >= least)
        a, b = codes[a, f], codes[b, f]
        good = (a != b) & enough
        feature[two[good]], cut[two[good]] = f[good], np.minimum(a, b)[good]
        gains += np.bincount(f[good], spread[two[good]], len(gains))
        open_ &= sizes > 2
        rows = open_[node]
        kept, every = order, node
        order, wo, yo, node = order[rows], wo[rows], yo[rows], node[rows]
        inside = np.flatnonzero(open_)
        place = np.zeros(len(sizes), np.int64)
        place[inside] = np.arange(len(inside))
        own = place[node]
        ends = np.cumsum(sizes[inside])
        i = 0
        while i < len(inside):
            a = ends[i - 1] if i else 0
            j = min(i + CHUNK_NODES, max(i + 1, int(np.searchsorted(ends, a + CHUNK_ROWS, side="right"))), len(inside))
            b = ends[j - 1]
            n, s = layout.sums(codes, joint, order[a:b], own[a:b] - i, j - i, wo[a:b], wo[a:b] * yo[a:b])
            f, c, gain = layout.best(n, s, least)
            ids = inside[i:j]
            good = gain > 1e-12 * spread[ids]
            feature[ids[good]], cut[ids[good]] = f[good], c[good]
            gains += np.bincount(f[good], gain[good], len(gains))
            i = j
        leaf = feature == LEAF
        features.append(feature)
        bins.append(cut)
        values.append(mean[leaf])
        covers.append(cover[leaf])
        rows = ~leaf[every]
        order, node = kept[rows], every[rows]
        right = flat.take(order * codes.shape[1] + feature.take(node)) > cut.take(node)
        size = sizes[~leaf]
        # Rows of a node stay together: those that go left, then those that go right.
        ends = np.cumsum(size)
        start = np.repeat(ends - size, size)
        passed = np.cumsum(right)
        rank = passed - np.repeat(np.concatenate([[0], passed])[ends - size], size)
        many = np.add.reduceat(right, ends - size) if len(size) else np.empty(0, np.int64)
        to = np.where(right, start + np.repeat(size - many, size) + rank - 1, np.arange(len(order)) - rank)
        moved = np.empty_like(order)
        moved[to] = order
        order = moved
        sizes = np.column_stack([size - many, many]).ravel()
        level += 1
    return np.concatenate(features), np.concatenate(bins), np.concatenate(values), np.concatenate(covers), gains


class Top:
    """The nodes of a tree that were split by passes over all rows.  ``left`` of a
    node that has no children is the node itself; a right child follows its left one."""

    OPEN, INNER, SUBTREE, DONE = range(4)

    def __init__(self, kind: int, cover: float):
        self.kind, self.cover, self.value = np.array([kind]), np.array([cover]), np.zeros(1)
        self.feature, self.bin, self.left = np.zeros(1, np.int64), np.array([LEAF]), np.zeros(1, np.int64)
        self.depth, self.gains = 0, 0.0

    def open(self) -> np.ndarray:
        return np.flatnonzero(self.kind == self.OPEN)

    def depths(self) -> np.ndarray:
        out = np.zeros(len(self.kind), np.int64)
        for node in np.flatnonzero(self.kind == self.INNER):  # children have larger numbers
            out[self.left[node]:self.left[node] + 2] = out[node] + 1
        return out

    def walk(self, codes: np.ndarray) -> np.ndarray:
        node = np.zeros(len(codes), np.int64)
        flat, rows = codes.ravel(), np.arange(len(codes)) * codes.shape[1]
        for _ in range(self.depth):
            right = flat.take(rows + self.feature.take(node)) > self.bin.take(node)
            node = self.left.take(node) + right
        return node

    def split(self, found, width: int, bound: int, least: int, deepest: bool) -> None:
        """Takes the splits of all open nodes.  Children that are small enough for a
        subtree or to stay whole, or as deep as they may be, are not opened."""
        gains = np.zeros(width)
        new = {c: [] for c in ("kind", "cover", "value")}
        for node, (f, c, gain, spread, mean, left_n, right_n, left_mean, right_mean) in zip(self.open(), found):
            self.cover[node] = left_n + right_n
            centre = self.value[node]
            self.value[node] += mean
            if not (gain > 1e-12 * spread and self.cover[node] >= least):
                self.kind[node] = self.DONE
                continue
            self.kind[node], self.feature[node], self.bin[node] = self.INNER, f, c
            self.left[node] = len(self.kind) + len(new["kind"])
            gains[int(f)] += gain
            for n, v in ((left_n, left_mean), (right_n, right_mean)):
                new["kind"].append(self.DONE if deepest or n < least else self.OPEN if n > bound else self.SUBTREE)
                new["cover"].append(n)
                new["value"].append(centre + v)
        k = len(new["kind"])
        first = len(self.kind)
        for c, v in new.items():
            setattr(self, c, np.concatenate([getattr(self, c), np.array(v, getattr(self, c).dtype)]))
        self.feature = np.concatenate([self.feature, np.zeros(k, np.int64)])
        self.bin = np.concatenate([self.bin, np.full(k, LEAF)])
        self.left = np.concatenate([self.left, np.arange(first, first + k)])
        self.gains = self.gains + gains
        self.depth += 1


def _blocks(batches, width: int, rows: int = BLOCK):
    """Keys, features (rows x features) and further columns of blocks of rows."""
    held, size = [], 0

    def block():
        table = pa.Table.from_batches(held).combine_chunks()
        x = table.column("x").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
        return table.column(0).to_numpy(), x, table

    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            part = batch.slice(at, rows)
            if size + part.num_rows > rows and size:
                yield block()
                held, size = [], 0
            held.append(part)
            size += part.num_rows
    if size:
        yield block()


def _bytes(a: np.ndarray, kind) -> bytes:
    return np.ascontiguousarray(a, kind).tobytes()


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    cols = list(zip(*rows)) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema)], schema=schema)


def _bag(plan, keys: np.ndarray, tree: int) -> tuple[np.ndarray, np.ndarray]:
    """The rows in a tree's bag, and how often."""
    if not plan.bootstrap:
        return np.arange(len(keys)), np.ones(len(keys), np.uint8)
    w = draws(keys, tree, plan.seed)
    own = np.flatnonzero(w)
    return own, w[own]


_SUMS = pa.schema([("tree", pa.int32()), ("n", pa.binary()), ("s", pa.binary()), ("q", pa.binary())])


def _level(shared):
    """Sums of a task's rows for the open nodes of all trees."""
    def run(batches):
        plan, layout, tops = shared.value
        held = {}
        for keys, x, table in _blocks(batches, len(layout.cuts)):
            codes = layout.codes(x)
            joint = layout.joint(codes)
            y = table.column("label").to_numpy()
            for tree, top in enumerate(tops):
                nodes = top.open()
                if not len(nodes):
                    continue
                own, w = _bag(plan, keys, tree)
                place = np.full(len(top.kind), -1)
                place[nodes] = np.arange(len(nodes))
                at = top.walk(codes.take(own, axis=0))
                rows = place[at] >= 0
                own, w, at = own[rows], w[rows].astype(float), at[rows]
                label = y[own] - top.value[at]
                parts = held.setdefault(tree, [np.zeros((len(nodes), layout.cells)), np.zeros((len(nodes), layout.cells)),
                                               np.zeros(len(nodes))])
                for total, part in zip(parts, layout.sums(codes, joint, own, place[at], len(nodes), w, w * label)):
                    total += part
                parts[2] += np.bincount(place[at], w * label * label, len(nodes))
        for tree, parts in held.items():
            yield _batch([(tree, *[_bytes(p, float) for p in parts])], _SUMS)

    return run


_SPLITS = pa.schema([("tree", pa.int32()), ("found", pa.binary())])


def _choose(shared):
    """The best splits of a tree's open nodes, from the sums of all tasks: feature,
    bin, gain, spread, mean, and count and mean of both children."""
    def run(table: pa.Table) -> pa.Table:
        plan, layout, tops = shared.value
        # In one order, whatever order they came in.
        parts = sorted(zip(*(table.column(c).to_pylist() for c in ("n", "s", "q"))))
        n, s, q = (sum(np.frombuffer(p[i]) for p in parts) for i in range(3))
        n, s = n.reshape(-1, layout.cells), s.reshape(-1, layout.cells)
        f, c, gain = layout.best(n, s, plan.least)
        cells = (layout.feature == f[:, None])
        up = cells & (layout.bin <= c[:, None])
        first = layout.feature == 0
        all_n, all_s = n[:, first].sum(axis=1), s[:, first].sum(axis=1)
        left_n, left_s = (n * up).sum(axis=1), (s * up).sum(axis=1)
        with np.errstate(divide="ignore", invalid="ignore"):
            spread = q - all_s * all_s / all_n
            gain = np.where(spread > all_n * plan.tiny ** 2, gain, -np.inf)
            out = np.column_stack([f, c, gain, spread, all_s / all_n, left_n, all_n - left_n, left_s / left_n, (all_s - left_s) / (all_n - left_n)])
        tree = table.column("tree")[0].as_py()
        return pa.Table.from_batches([_batch([(tree, _bytes(out, float))], _SPLITS)])

    return run


_DEALT = pa.schema([("tree", pa.int32()), ("node", pa.int32()), ("first", pa.int64()), ("codes", pa.binary()),
                    ("w", pa.binary()), ("y", pa.binary())])


def _by_node(nodes: np.ndarray):
    """Rows of every node that is a subtree's: node and row numbers."""
    order = np.argsort(nodes.astype(np.uint16 if nodes.size and nodes.max() < 1 << 16 else np.int64), kind="stable")
    for own in np.split(order, np.flatnonzero(np.diff(nodes[order])) + 1):
        if len(own):
            yield int(nodes[own[0]]), own


def _deal(shared):
    """Rows in the bags, packed by the subtree that they fall into."""
    def run(batches):
        plan, layout, tops = shared.value
        for keys, x, table in _blocks(batches, len(layout.cuts)):
            codes = layout.codes(x)
            y = table.column("label").to_numpy()
            for tree, top in enumerate(tops):
                own, w = _bag(plan, keys, tree)
                node = top.walk(codes.take(own, axis=0))
                rows = top.kind[node] == Top.SUBTREE
                own, w, node = own[rows], w[rows], node[rows]
                yield _batch([(tree, k, int(keys[own[i[0]]]), _bytes(codes.take(own[i], axis=0), np.uint8), _bytes(w[i], np.uint8),
                               _bytes(y[own[i]] - top.value[k], float)) for k, i in _by_node(node)], _DEALT)

    return run


_SUBTREE = pa.schema([("tree", pa.int32()), ("node", pa.int32()), ("size", pa.int32()), ("features", pa.binary()),
                      ("bins", pa.binary()), ("values", pa.binary()), ("covers", pa.binary()), ("gains", pa.list_(pa.float64()))])
_SUBTREE_SQL = "tree int, node int, size int, features binary, bins binary, values binary, covers binary, gains array<double>"


def _subtree(shared):
    def run(table: pa.Table) -> pa.Table:
        plan, layout, tops = shared.value
        # In one order, whatever order they came in.
        parts = sorted(zip(*(table.column(c).to_pylist() for c in ("first", "codes", "w", "y"))))
        codes, w, y = (np.frombuffer(b"".join(p[i] for p in parts), kind) for i, kind in ((1, np.uint8), (2, np.uint8), (3, float)))
        tree, node = table.column("tree")[0].as_py(), table.column("node")[0].as_py()
        top = tops[tree]
        depth = None if plan.depth is None else plan.depth - top.depths()[node]
        f, c, values, covers, gains = grow(codes.reshape(-1, len(layout.cuts)), w, y, layout, depth, plan.least, plan.split, plan.tiny)
        row = (tree, node, len(f), _bytes(f, np.uint8), _bytes(c, np.uint8), _bytes(values + top.value[node], float),
               _bytes(covers, np.uint32), gains.tolist())
        return pa.Table.from_batches([_batch([row], _SUBTREE)])

    return run


# ------------------------------------------------------------ the forest ----

@dataclass
class Plan:
    """What tasks need to know of a fit."""

    bootstrap: bool
    seed: int
    depth: int | None
    least: int
    split: int
    tiny: float


@dataclass
class RandomForest:
    """Estimator: ``depth`` None grows until labels or features of a node are equal;
    ``least`` rows, as often as they are drawn, must be on each side of a split and
    ``split`` in a node that is split.

    A forest of at most ``PASSES`` levels over more than ``subtree_rows`` rows is grown
    by passes alone, and no rows are dealt out."""

    trees: int = 100
    depth: int | None = None
    least: int = 1
    split: int = 2
    seed: int = 42
    max_bins: int = 32
    bootstrap: bool = True
    key: str = "row_id"
    features_col: str = "features"
    label_col: str = "label"
    subtree_rows: int = SUBTREE_ROWS

    def fit(self, df: DataFrame) -> GrownRandomForest:
        if not 2 <= self.max_bins <= 255:
            raise ValueError("max_bins must be from 2 to 255")
        spark = df.sparkSession
        ship_package(spark)
        label = F.col(self.label_col).cast("double")
        rows = df.select(F.col(self.key).cast("long").alias("key"), vector_to_array(self.features_col).alias("x"),
                         label.alias("label"))
        r = rows.agg(F.count("*").alias("n"), F.avg("label").alias("mean"), F.min("label").alias("least"),
                     F.max("label").alias("most"), F.first(F.size("x")).alias("width"),
                     F.count(F.when(F.col("key").isNotNull() & F.col("x").isNotNull() & F.col("label").isNotNull()
                                    & ~F.isnan("label"), 1)).alias("whole")).first()
        if r["n"] == 0:
            raise ValueError("a forest needs rows")
        if r["whole"] < r["n"]:
            raise ValueError("a forest needs a key, features and a label in every row")
        rows = rows.withColumn("label", F.col("label") - F.lit(r["mean"]))
        # Labels that differ less count as equal.
        tiny = 1e-14 * max(abs(r["most"] - r["mean"]), abs(r["least"] - r["mean"]))
        plan = Plan(self.bootstrap, self.seed, self.depth, self.least, self.split, tiny)
        layout = Layout(find_thresholds(rows, r["width"], self.max_bins))
        large = r["n"] > self.subtree_rows and self.depth != 0
        bound = 0 if self.depth is not None and self.depth <= PASSES else self.subtree_rows
        tops = [Top(Top.OPEN if large else Top.SUBTREE, float(r["n"])) for _ in range(self.trees)]
        level = 0
        while any(len(t.open()) for t in tops):
            level += 1
            shared = spark.sparkContext.broadcast((plan, layout, tops))
            found = rows.mapInArrow(_level(shared), "tree int, n binary, s binary, q binary").groupBy("tree").applyInArrow(
                _choose(shared), "tree int, found binary").collect()
            for f in found:  # nine numbers per node that was open
                tops[f["tree"]].split(np.frombuffer(f["found"]).reshape(-1, 9), r["width"], bound, self.split, level == self.depth)
            shared.destroy()
        shared = spark.sparkContext.broadcast((plan, layout, tops))
        groups = sum(int((t.kind == Top.SUBTREE).sum()) for t in tops)
        dealt = rows.mapInArrow(_deal(shared), "tree int, node int, first long, codes binary, w binary, y binary")
        subtrees = materialize(dealt.repartition(min(2000, max(1, groups)), "tree", "node").groupBy("tree", "node")
                               .applyInArrow(_subtree(shared), _SUBTREE_SQL), "subtrees")
        return GrownRandomForest(tops, layout, subtrees, r["mean"], self.features_col)


_ROUTED = pa.schema([("block", pa.int64()), ("tree", pa.int32()), ("node", pa.int32()), ("at", pa.binary()), ("of", pa.binary())])
_ROUTED_SQL = "block long, tree int, node int, at binary, of binary"


def _route(shared):
    """Blocks of rows, packed by the subtree that they fall into, and each block's
    keys with what the trees that end above a subtree add."""
    def run(batches):
        layout, tops, _ = shared.value
        for keys, x, _ in _blocks(batches, len(layout.cuts), SCORED):
            codes = layout.codes(x)
            total = np.zeros(len(keys))
            first = int(keys[0])
            for tree, top in enumerate(tops):
                node = top.walk(codes)
                below = top.kind[node] == Top.SUBTREE
                total += np.where(below, 0.0, top.value[node])
                own = np.flatnonzero(below)
                yield _batch([(first, tree, k, _bytes(own[i], np.uint16), _bytes(codes.take(own[i], axis=0), np.uint8))
                              for k, i in _by_node(node[own])], _ROUTED)
            # Of no tree: spread over the groups.
            yield _batch([(first, -1, first % (1 << 31), _bytes(keys, np.int64), _bytes(total, float))], _ROUTED)

    return run


def _walked(features: np.ndarray, bins: np.ndarray, values: np.ndarray, codes: np.ndarray) -> np.ndarray:
    inner = features != LEAF
    left = 2 * np.cumsum(inner) - 1
    leaf = np.cumsum(~inner) - 1
    node = np.zeros(len(codes), np.int64)
    rows = np.arange(len(codes))
    while True:
        rows = rows[inner[node[rows]]]
        if not len(rows):
            return values[leaf[node]]
        at = node[rows]
        node[rows] = left[at] + (codes[rows, features[at]] > bins[at])


def _predict(width: int):
    def run(rows: pa.Table, trees: pa.Table) -> pa.Table:
        if not rows.num_rows or not trees.num_rows:
            return rows
        t = trees.slice(0, 1).to_pylist()[0]
        nodes = np.frombuffer(t["features"], np.uint8), np.frombuffer(t["bins"], np.uint8), np.frombuffer(t["values"])
        codes = [np.frombuffer(c.as_py(), np.uint8).reshape(-1, width) for c in rows.column("of")]
        found = np.split(_walked(*nodes, np.concatenate(codes)), np.cumsum([len(c) for c in codes])[:-1])
        return rows.set_column(4, "of", pa.array([_bytes(v, float) for v in found], pa.binary()))

    return run


def _added(trees: int, mean: float):
    def run(table: pa.Table) -> pa.Table:
        # The block's own record first, then its parts by tree.
        own, *parts = sorted(table.to_pylist(), key=lambda p: (p["tree"], p["node"]))
        total = np.frombuffer(own["of"]).copy()
        for p in parts:
            total[np.frombuffer(p["at"], np.uint16)] += np.frombuffer(p["of"])
        return pa.table({"_row": pa.array(np.frombuffer(own["at"], np.int64)), "prediction": pa.array(total / trees + mean)})

    return run


def _from_tops(shared):
    def run(x: pa.Array) -> pa.Array:
        layout, tops, mean = shared.value
        codes = layout.codes(x.flatten().to_numpy(zero_copy_only=False).reshape(-1, len(layout.cuts)))
        return pa.array(sum(t.value[t.walk(codes)] for t in tops) / len(tops) + mean)

    return run


_NODES = pa.schema([("tree", pa.int32()), ("id", pa.int32()), ("left", pa.int32()), ("right", pa.int32()),
                    ("feature", pa.int32()), ("threshold", pa.float64()), ("cover", pa.float64()), ("value", pa.float64())])
_NODES_SQL = "tree int, id int, left int, right int, feature int, threshold double, cover double, value double"


def _unpacked(shared):
    """The nodes of subtrees as rows; a subtree's root takes its node's number in the top."""
    def run(batches):
        layout, places, mean = shared.value
        for batch in batches:
            for t in batch.to_pylist():
                feature, cut = np.frombuffer(t["features"], np.uint8), np.frombuffer(t["bins"], np.uint8)
                inner = feature != LEAF
                cover, total = np.zeros(len(feature)), np.zeros(len(feature))
                cover[~inner] = np.frombuffer(t["covers"], np.uint32)
                total[~inner] = np.frombuffer(t["values"]) * cover[~inner]
                left = np.where(inner, 2 * np.cumsum(inner) - 1, -1)
                for i in np.flatnonzero(inner)[::-1]:
                    cover[i] = cover[left[i]] + cover[left[i] + 1]
                    total[i] = total[left[i]] + total[left[i] + 1]
                number = np.arange(len(feature)) + places[t["tree"], t["node"]] - 1
                number[0] = t["node"]
                split = np.full(len(feature), np.nan)
                split[inner] = [layout.cuts[f][c] for f, c in zip(feature[inner], cut[inner])]
                cols = [np.full(len(feature), t["tree"]), number, np.where(inner, number[left], -1),
                        np.where(inner, number[np.minimum(left + 1, len(feature) - 1)], -1), np.where(inner, feature.astype(int), -1)]
                yield pa.RecordBatch.from_arrays(
                    [*[pa.array(c, pa.int32()) for c in cols], pa.array(split), pa.array(cover), pa.array(total / cover + mean)],
                    schema=_NODES)

    return run


class GrownRandomForest:
    """A fitted forest: tops of its trees, and a table of all that is below them."""

    def __init__(self, tops: list[Top], layout: Layout, subtrees: DataFrame, mean: float, features_col: str):
        self.tops, self.layout, self.subtrees, self.mean, self.features_col = tops, layout, subtrees, mean, features_col
        self.trees = range(len(tops))
        self.treeWeights = [1.0] * len(tops)
        self.numFeatures = len(layout.cuts)

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` with a ``prediction``."""
        spark = df.sparkSession
        ship_package(spark)
        shared = spark.sparkContext.broadcast((self.layout, self.tops, self.mean))
        if not any((t.kind == Top.SUBTREE).any() for t in self.tops):
            return df.withColumn("prediction", F.arrow_udf(_from_tops(shared), "double")(vector_to_array(self.features_col)))
        # Rows are matched by a number of their own, as keys may repeat (scenarios of a row).
        df = materialize(df.withColumn("_row", F.monotonically_increasing_id()), "to_predict")
        rows = df.select("_row", vector_to_array(self.features_col).alias("x"))
        routed = rows.mapInArrow(_route(shared), _ROUTED_SQL)
        scored = routed.groupBy("tree", "node").cogroup(self.subtrees.groupBy("tree", "node")).applyInArrow(
            _predict(self.numFeatures), _ROUTED_SQL)
        found = materialize(scored.groupBy("block").applyInArrow(_added(len(self.tops), self.mean), "_row long, prediction double"),
                            "forest_predictions")
        return df.join(found, "_row").drop("_row")

    def nodes(self) -> DataFrame:
        """``tree, id, left, right, feature, threshold, cover, value`` of all nodes; a
        tree's are numbered from 0, the root, and children after their parent."""
        spark = self.subtrees.sparkSession
        after = [len(t.kind) for t in self.tops]
        places, rows = {}, []
        for r in self.subtrees.select("tree", "node", "size").orderBy("tree", "node").collect():
            places[r["tree"], r["node"]] = after[r["tree"]]
            after[r["tree"]] += r["size"] - 1
        for tree, t in enumerate(self.tops):
            for i in np.flatnonzero(t.kind != Top.SUBTREE).tolist():
                inner = t.kind[i] == Top.INNER
                f, cut = (int(t.feature[i]), float(self.layout.cuts[t.feature[i]][t.bin[i]])) if inner else (-1, None)
                rows.append((tree, i, int(t.left[i]) if inner else -1, int(t.left[i]) + 1 if inner else -1, f, cut,
                             float(t.cover[i]), float(t.value[i] + self.mean)))
        shared = spark.sparkContext.broadcast((self.layout, places, self.mean))
        below = self.subtrees.mapInArrow(_unpacked(shared), _NODES_SQL)
        return below.unionByName(spark.createDataFrame(rows, _NODES_SQL)) if rows else below

    @property
    def featureImportances(self) -> DenseVector:
        """Mean over the trees of the variance that splits by a feature remove, each
        tree's adding up to 1."""
        gains = np.zeros((len(self.tops), self.numFeatures))
        for i, top in enumerate(self.tops):
            gains[i] += top.gains
        below = self.subtrees.select("tree", F.posexplode("gains").alias("feature", "gain")).groupBy("tree", "feature").agg(
            F.sum("gain").alias("gain"))
        for r in below.collect():
            gains[r["tree"], r["feature"]] += r["gain"]
        whole = gains.sum(axis=1, keepdims=True)
        share = np.divide(gains, whole, out=np.zeros_like(gains), where=whole > 0).sum(axis=0)
        return DenseVector(share / share.sum() if share.sum() else share)
