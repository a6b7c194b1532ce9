"""Forests cut short after they have grown.

A tree that stops at a depth, or does not split nodes of fewer than ``s`` rows,
is a grown tree with the nodes beyond that cut off: splits are chosen from the
rows of a node alone, and a cut node predicts its own mean, which the grown tree
has stored.  So one forest, grown to the largest depth and number of trees, holds
every candidate of a grid over number of trees (its first trees), depth and least
rows to split; ``score_candidates`` reads all of them off in one pass over the
held-out rows.

Counts are of a tree's bagged rows, so a row drawn twice counts twice.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import RandomForestRegressionModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.ml.attribute import Tree, node_table, read_trees
from quarry.session import scratch_path, ship_package

#: Rows scored together.
BLOCK = 8192


@dataclass(frozen=True)
class Grid:
    """The axes of a grid: numbers of trees, depths, least rows to split."""

    trees: tuple[int, ...]
    depths: tuple[int, ...]
    splits: tuple[int, ...]

    def candidates(self) -> list[tuple[int, int, int]]:
        return list(product(self.trees, self.depths, self.splits))


def cut_predictions(tree: Tree, x: np.ndarray, depths: Sequence[int], splits: Sequence[int]) -> np.ndarray:
    """Predictions of ``tree`` cut at every depth and split size, ``len(depths) x
    len(splits) x rows``; ``x`` is features x rows."""
    n = x.shape[1]
    out = np.empty((len(depths), len(splits), n))
    node = np.zeros(n, np.int64)
    # The node a row stops at for a split size, once it has.
    stopped = np.full((len(splits), n), -1)
    for depth in range(max(depths) + 1):
        end = tree.left[node] < 0
        for k, s in enumerate(splits):
            new = (stopped[k] < 0) & (end | (tree.cover[node] < s))
            stopped[k][new] = node[new]
        for i in [i for i, d in enumerate(depths) if d == depth]:
            for k in range(len(splits)):
                out[i, k] = tree.value[np.where(stopped[k] < 0, node, stopped[k])]
        f = np.where(end, 0, tree.feature[node])
        below = np.where(x[f, np.arange(n)] <= tree.threshold[node], tree.left[node], tree.right[node])
        node = np.where(end, node, below)
    return out


def grid_predictions(trees: Sequence[Tree], x: np.ndarray, grid: Grid) -> np.ndarray:
    """Predictions of every candidate, in the order of ``grid.candidates()``."""
    total = np.zeros((len(grid.depths), len(grid.splits), x.shape[1]))
    at = {}
    for i, tree in enumerate(trees[:max(grid.trees)]):
        total += cut_predictions(tree, x, grid.depths, grid.splits)
        if i + 1 in grid.trees:
            at[i + 1] = total / (i + 1)
    return np.concatenate([at[n].reshape(-1, x.shape[1]) for n in grid.trees])


def _errors(forests, grid: Grid, width: int):
    def run(batches):
        squares: dict[int, np.ndarray] = {}
        for b in batches:
            for start in range(0, b.num_rows, BLOCK):
                part = b.slice(start, BLOCK)
                fold = part.column(0).to_numpy()
                label = part.column(1).to_numpy()
                x = part.column(2).flatten().to_numpy().reshape(-1, width)
                for k in np.unique(fold):
                    own = fold == k
                    e = grid_predictions(forests.value[int(k)], np.ascontiguousarray(x[own].T), grid) - label[own]
                    squares[int(k)] = squares.get(int(k), 0) + (e * e).sum(axis=1)
        rows = [(k, c, v) for k, sums in squares.items() for c, v in enumerate(sums.tolist())]
        cols = list(zip(*rows)) if rows else [(), (), ()]
        yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.int32()),
                                          pa.array(cols[2], pa.float64())], names=["fold", "candidate", "squares"])

    return run


def score_candidates(held_out: DataFrame, forests: Mapping[int, RandomForestRegressionModel], grid: Grid,
                     fold_col: str = "fold") -> DataFrame:
    """``fold, candidate, r2``: each candidate on the rows of each fold, scored by
    that fold's forest.  The forests' nodes are broadcast (their size is the
    grid's, trees times two to the depth, not the data's); a task returns one
    number per fold and candidate."""
    spark = held_out.sparkSession
    ship_package(spark)
    trees = {k: read_trees(node_table(spark, m), [1.0] * len(m.trees)) for k, m in forests.items()}
    width = next(iter(forests.values())).numFeatures
    shared = spark.sparkContext.broadcast(trees)
    rows = held_out.select(F.col(fold_col).cast("int").alias("fold"), F.col("label").cast("double").alias("label"),
                           vector_to_array("features").alias("x"))
    squares = rows.mapInArrow(_errors(shared, grid, width), "fold int, candidate int, squares double")
    total = rows.groupBy("fold").agg((F.var_pop("label") * F.count("label")).alias("total"))
    return squares.groupBy("fold", "candidate").agg(F.sum("squares").alias("squares")).join(total, "fold").select(
        "fold", "candidate", (1 - F.try_divide("squares", "total")).alias("r2"))


def _kept_nodes(least: int):
    """Preorder numbers of the nodes that stay when nodes of fewer than ``least``
    rows are not split."""
    def run(table: pa.Table) -> pa.Table:
        order = np.argsort(table.column("id").to_numpy())
        left, right, cover = (table.column(c).to_numpy()[order] for c in ("left", "right", "cover"))
        ids, lefts, rights = [], [], []
        todo = [(0, -1, False)]
        while todo:
            node, parent, is_right = todo.pop()
            at = len(ids)
            ids.append(node)
            lefts.append(-1)
            rights.append(-1)
            if parent >= 0:
                (rights if is_right else lefts)[parent] = at
            if left[node] >= 0 and cover[node] >= least:
                todo += [(int(right[node]), at, True), (int(left[node]), at, False)]
        n = len(ids)
        return pa.table({"tree": pa.array([table.column("tree")[0].as_py()] * n, pa.int32()),
                         "id": pa.array(ids, pa.int32()), "new": pa.array(range(n), pa.int32()),
                         "l": pa.array(lefts, pa.int32()), "r": pa.array(rights, pa.int32())})

    return run


def without_small_splits(spark: SparkSession, model: RandomForestRegressionModel,
                         least: int) -> RandomForestRegressionModel:
    """The forest with every node of fewer than ``least`` rows made a leaf, as a
    Spark model again: its saved nodes are cut, numbered anew and loaded."""
    if least <= 2:
        return model
    source, target = scratch_path(spark, "grown_forest"), scratch_path(spark, "cut_forest")
    model.write().overwrite().save(source)
    nodes = spark.read.parquet(f"{source}/data")
    flat = nodes.select(F.col("treeID").alias("tree"), "nodeData.id", F.col("nodeData.leftChild").alias("left"),
                        F.col("nodeData.rightChild").alias("right"), F.col("nodeData.rawCount").cast("double").alias("cover"))
    kept = flat.groupBy("tree").applyInArrow(_kept_nodes(least), "tree int, id int, new int, l int, r int")
    leaf = F.col("l") < 0
    inner = nodes.schema["nodeData"].dataType
    no_split = F.struct(F.lit(-1).alias("featureIndex"), F.array().cast("array<double>").alias("leftCategoriesOrThreshold"),
                        F.lit(-1).alias("numCategories"))
    new = {"id": F.col("new"), "leftChild": F.col("l"), "rightChild": F.col("r"),
           "gain": F.when(leaf, F.lit(-1.0)).otherwise(F.col("nodeData.gain")),
           "split": F.when(leaf, no_split).otherwise(F.col("nodeData.split"))}
    data = nodes.join(kept, (nodes["treeID"] == kept["tree"]) & (nodes["nodeData.id"] == kept["id"])).select(
        "treeID", F.struct(*[new.get(f.name, F.col(f"nodeData.{f.name}")).cast(f.dataType).alias(f.name)
                             for f in inner.fields]).alias("nodeData"))
    data.write.parquet(f"{target}/data")
    spark.read.parquet(f"{source}/treesMetadata").write.parquet(f"{target}/treesMetadata")
    spark.read.text(f"{source}/metadata").coalesce(1).write.text(f"{target}/metadata")
    return RandomForestRegressionModel.load(target)
