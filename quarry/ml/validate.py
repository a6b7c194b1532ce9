"""Cross-validation, tuning and over-fit checks.

Folds are a hash of the row key (``features.fold_column``), so they do not
depend on partitioning.  Each fold's held-out predictions of every model are
stacked into one frame and scored by one grouped aggregate.
"""

from __future__ import annotations

import math
from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace

from pyspark.ml.regression import RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.ml.forest import GrownRandomForest, RandomForest
from quarry.ml.truncate import Grid, score_candidates, without_small_splits
from quarry.operators.stats import metric_mean, regression_metrics


def oof_predictions(estimators: Mapping[str, object], data: DataFrame, key: str = "row_id",
                    fold_col: str = "fold", k: int = 5, parallelism: int = 8,
                    fitted: Mapping[str, Mapping[int, object]] | None = None) -> DataFrame:
    """Held-out predictions (model, fold, key, label, prediction): for every
    fold each estimator is fit on the other folds, unless ``fitted`` has its
    models by fold.  The k x models fits are
    independent Spark jobs submitted from a small thread pool (as
    ``CrossValidator(parallelism=..)`` does); the loop never touches rows."""
    jobs = [(name, est, f) for name, est in estimators.items() if name not in (fitted or {}) for f in range(k)]

    def fit(job):
        name, est, f = job
        return name, f, est.fit(data.filter(F.col(fold_col) != f))

    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        models = list(pool.map(fit, jobs))
    models += [(name, f, m) for name, folds in (fitted or {}).items() for f, m in folds.items()]
    parts = [
        m.transform(data.filter(F.col(fold_col) == f)).select(
            F.lit(name).alias("model"), F.lit(f).alias("fold"), key, "label", F.col("prediction"))
        for name, f, m in models
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def cross_validate(estimators: Mapping[str, object], data: DataFrame, key: str = "row_id",
                   fold_col: str = "fold", k: int = 5) -> tuple[DataFrame, DataFrame]:
    """M7: per (model, fold) R^2 and MAE, and their means per model."""
    oof = oof_predictions(estimators, data, key, fold_col, k)
    per_fold = regression_metrics(oof, "label", "prediction", by=["model", "fold"])
    return per_fold, metric_mean(per_fold, by=["model"])


def _sized(estimator: RandomForest | RandomForestRegressor, trees: int, depth: int, data: DataFrame):
    if isinstance(estimator, RandomForest):
        return replace(estimator, trees=trees, depth=depth).fit(data)
    return estimator.fit(data, {estimator.numTrees: trees, estimator.maxDepth: depth})


def grid_search(estimator: RandomForest | RandomForestRegressor, grid: Grid, data: DataFrame, fold_col: str = "fold",
                k: int = 5, parallelism: int = 5) -> tuple[DataFrame, GrownRandomForest | RandomForestRegressionModel]:
    """Every candidate of ``grid`` scored by mean R^2 over ``k`` folds, and
    the best refit on all rows.

    ``k`` fits and a refit: per fold one forest is grown to the largest depth and
    number of trees, and all candidates are read off it cut short
    (``ml.truncate``).  Of equal scores the first candidate wins.  Returns the
    scores (a row per candidate) and the refit model.
    """
    spark = data.sparkSession

    def fit(fold: int):
        return fold, _sized(estimator, max(grid.trees), max(grid.depths), data.filter(F.col(fold_col) != fold))

    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        forests = dict(pool.map(fit, range(k)))
    r2 = score_candidates(data, forests, grid, fold_col).groupBy("candidate").agg(F.avg("r2").alias("mean_r2"))
    scores = {r["candidate"]: r["mean_r2"] for r in r2.collect()}  # one number per candidate
    rows = [(*c, scores[i]) for i, c in enumerate(grid.candidates())]
    best = max(rows, key=lambda r: -math.inf if r[3] is None else r[3])
    table = spark.createDataFrame([(*r, r is best) for r in rows],
                                  "num_trees int, max_depth int, min_samples_split int, mean_r2 double, is_best boolean")
    if isinstance(estimator, RandomForest):
        return table, _sized(replace(estimator, split=best[2]), best[0], best[1], data)
    return table, without_small_splits(spark, _sized(estimator, best[0], best[1], data), best[2])


def overfit_gap(models: Mapping[str, object], train: DataFrame, test: DataFrame) -> DataFrame:
    """Train R^2, test R^2 and their difference per fitted model, from
    one union of predictions scored by a grouped aggregate."""
    parts = []
    for name, model in models.items():
        for part, df in (("train", train), ("test", test)):
            parts.append(model.transform(df).select(F.lit(name).alias("stage"), F.lit(part).alias("part"),
                                                    "label", "prediction"))
    preds = parts[0]
    for p in parts[1:]:
        preds = preds.unionByName(p)
    m = regression_metrics(preds, "label", "prediction", by=["stage", "part"])
    wide = m.groupBy("stage").pivot("part", ["train", "test"]).agg(F.first("r2"))
    return wide.select("stage", F.col("train").alias("train_r2"), F.col("test").alias("test_r2"),
                       (F.col("train") - F.col("test")).alias("gap"))
