"""Stacking ensemble.

Base models are fit per fold to produce out-of-fold predictions; the OOF
columns are lined up per row with one pivot (one shuffle on the row key);
the meta model is a ridge regression on them; bases are then refit on all
training rows.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.ml.linear import ridge
from quarry.ml.validate import oof_predictions
from quarry.operators.stats import regression_metrics


class StackedModel:
    def __init__(self, bases: Mapping[str, object], meta, names: list[str]):
        self.bases, self.meta, self.names = dict(bases), meta, names

    def base_columns(self, df: DataFrame, key: str = "row_id") -> DataFrame:
        out = df
        for name in self.names:
            out = self.bases[name].transform(out).withColumnRenamed("prediction", f"pred_{name}")
        return out

    def transform(self, df: DataFrame) -> DataFrame:
        cols = self.base_columns(df)
        va = VectorAssembler(inputCols=[f"pred_{n}" for n in self.names], outputCol="meta_features")
        return self.meta.transform(va.transform(cols))


def fit_stacking(estimators: Mapping[str, object], train: DataFrame, alpha: float = 1.0,
                 key: str = "row_id", fold_col: str = "fold", k: int = 5, oof: DataFrame | None = None,
                 fitted: Mapping[str, object] | None = None) -> StackedModel:
    """M10.  ``oof`` (out-of-fold predictions on the same folds, e.g. the ones
    cross-validation already made) and ``fitted`` bases are reused when given."""
    names = list(estimators)
    if oof is None:
        oof = oof_predictions(estimators, train, key, fold_col, k)
    wide = oof.groupBy(key, "label").pivot("model", names).agg(F.first("prediction"))
    va = VectorAssembler(inputCols=names, outputCol="meta_features")
    meta_in = va.transform(wide)
    meta = ridge(meta_in, alpha, "meta_features")
    bases = {n: (fitted or {}).get(n) or est.fit(train) for n, est in estimators.items()}
    return StackedModel(bases, meta, names)


def compare_models(models: Mapping[str, object], test: DataFrame) -> DataFrame:
    """Test R^2 and MAE per fitted model (each fitted once)."""
    parts = [m.transform(test).select(F.lit(name).alias("model"), "label", "prediction")
             for name, m in models.items()]
    preds = parts[0]
    for p in parts[1:]:
        preds = preds.unionByName(p)
    return regression_metrics(preds, "label", "prediction", by=["model"])
