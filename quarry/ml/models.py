"""Model definitions and model read-outs.

Defaults follow the reference's estimators where Spark can express them (linear
models: ``ml.linear``): a forest of 100 trees using all features per split and
unlimited depth (Spark's ceiling is 30); boosting with 100 stages of depth 3
and rate 0.1.  Spark's trees bin continuous features (``maxBins``), so split
points differ from an exact-split implementation.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.ml.forest import RandomForest

MAX_TREE_DEPTH = 30
#: Bytes of node ids that a growing forest may cache.
NODE_ID_BYTES = 2 << 30
#: Rows of a task of a boosting round.
ROWS_PER_TASK = 500_000


def random_forest(num_trees: int = 100, max_depth: int = MAX_TREE_DEPTH, min_instances: int = 1,
                  seed: int = 42, max_bins: int = 32) -> RandomForestRegressor:
    return RandomForestRegressor(featuresCol="features", labelCol="label", numTrees=num_trees, maxDepth=max_depth,
                                 minInstancesPerNode=min_instances, featureSubsetStrategy="all", seed=seed,
                                 maxBins=max_bins, subsamplingRate=1.0, bootstrap=True)


def gradient_boosting(max_iter: int = 100, max_depth: int = 3, step: float = 0.1,
                      seed: int = 42) -> GBTRegressor:
    return GBTRegressor(featuresCol="features", labelCol="label", maxIter=max_iter, maxDepth=max_depth,
                        stepSize=step, seed=seed, featureSubsetStrategy="all", subsamplingRate=1.0)


def keep_node_ids(forest: RandomForestRegressor, rows: int, most: int = NODE_ID_BYTES) -> RandomForestRegressor:
    """``forest`` with the node of every row and tree cached while it grows, if these
    ids take at most ``most`` bytes.  They save a walk down the grown part of a tree
    at each level, but several generations of them are held and written as
    checkpoints; the trees are the same without."""
    return forest.copy().setCacheNodeIds(4 * rows * forest.getNumTrees() <= most)


@dataclass
class Forest:
    """A forest that caches node ids only where they are small (``keep_node_ids``)."""

    estimator: RandomForestRegressor
    most: int = NODE_ID_BYTES

    def fit(self, df: DataFrame):
        return keep_node_ids(self.estimator, df.count(), self.most).fit(df)


@dataclass
class Unlimited(Forest):
    """A forest of full depth, which holds no node ids at all (``ml.forest``)."""

    estimator: RandomForest

    def fit(self, df: DataFrame):
        return self.estimator.fit(df)

    def to_depth(self, depth: int) -> RandomForest:
        """The same forest, as far as it has grown at ``depth``."""
        return replace(self.estimator, depth=depth)


@dataclass
class Spread:
    """An estimator whose tasks hold a bounded number of rows: many rows are dealt by
    their key over more partitions before the fit, and sorted, so that draws do not
    depend on the order of a shuffle.  Parquet splits are of equal bytes, not rows,
    and a compact file's split is many times larger as the tree points that a
    boosting round reads.  Few rows are left as they lie."""

    estimator: object
    key: str = "row_id"
    rows: int = ROWS_PER_TASK

    def fit(self, df: DataFrame):
        n = math.ceil(df.count() / self.rows)
        if n > df.rdd.getNumPartitions():
            df = df.repartition(n, self.key).sortWithinPartitions(self.key)
        return self.estimator.fit(df)


def coefficients(spark: SparkSession, model, names: Sequence[str]) -> DataFrame:
    """M4 read-out: one row per coefficient plus the intercept."""
    rows = [(n, float(c)) for n, c in zip(names, model.coefficients.toArray())]
    rows.append(("(intercept)", float(model.intercept)))
    return spark.createDataFrame(rows, "feature string, coefficient double")


def importances(spark: SparkSession, model, names: Sequence[str]) -> DataFrame:
    """Impurity importances (normalised to sum 1) with feature names; the
    table has one row per feature (bounded by the model, not the data)."""
    vals = model.featureImportances.toArray()
    return spark.createDataFrame([(n, float(v)) for n, v in zip(names, vals)], "feature string, importance double")


def top_importances(imp: DataFrame, k: int = 10) -> DataFrame:
    """M8: the k most important features (tie -> name)."""
    return imp.orderBy(F.desc("importance"), "feature").limit(k)


def prune_candidates(imp: DataFrame, threshold: float = 0.01) -> DataFrame:
    """M9: features below the importance threshold, with their count."""
    low = imp.filter(F.col("importance") < threshold)
    return low.withColumn("n_below", low.select(F.count(F.lit(1))).scalar())
