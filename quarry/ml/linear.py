"""Linear models of all folds from one scan.

The sums that a least-squares fit needs are additive over rows, so one pass adds
them up per fold: the count, the sums and the cross products of the features and
the label.  The fit without a fold is solved from the total less that fold's sums,
the full fit from the total, a ridge fit by adding to the diagonal.

Values are taken from those of one row, so that large means do not cancel in the
products.  Tasks multiply matrices batch by batch and send one matrix per fold;
what comes to the driver is folds times (features + 2) squared numbers.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.session import ship_package


@dataclass
class LinearModel:
    """``prediction = intercept + coefficients . features``."""

    coefficients: DenseVector
    intercept: float
    features_col: str = "features"

    def transform(self, df: DataFrame) -> DataFrame:
        w = F.array(*[F.lit(float(c)) for c in self.coefficients])
        terms = F.zip_with(vector_to_array(self.features_col), w, lambda x, c: x * c)
        return df.withColumn("prediction", F.aggregate(terms, F.lit(float(self.intercept)), lambda s, t: s + t))


@dataclass
class Moments:
    """Sums of products of ``(1, x - origin, y - origin)``, origin's last is the label's."""

    products: np.ndarray
    origin: np.ndarray

    def __sub__(self, other: Moments) -> Moments:
        return Moments(self.products - other.products, self.origin)

    def fit(self, alpha: float = 0.0, features_col: str = "features") -> LinearModel:
        """``min |y - b - X w|^2 + alpha |w|^2``; the smallest of several solutions."""
        n, s = self.products[0, 0], self.products[0, 1:]
        if n == 0:
            raise ValueError("a linear fit needs rows")
        mean = s / n
        c = self.products[1:, 1:] - np.outer(s, mean)
        a = c[:-1, :-1] + alpha * np.eye(len(c) - 1)
        # Columns of one scale, so that what is negligible does not hang on units.
        scale = np.sqrt(np.where(np.diag(a) > 0, np.diag(a), 1.0))
        w = np.linalg.lstsq(a / np.outer(scale, scale), c[:-1, -1] / scale, rcond=1e-13)[0] / scale
        at = mean + self.origin
        return LinearModel(DenseVector(w), float(at[-1] - at[:-1] @ w), features_col)


def _sums(origin: np.ndarray):
    def run(batches):
        width = len(origin) - 1
        folds: dict[int, np.ndarray] = {}
        for b in batches:
            fold = b.column(0).to_numpy()
            x = b.column(2).flatten().to_numpy().reshape(-1, width)
            z = np.column_stack([np.ones(b.num_rows), np.column_stack([x, b.column(1).to_numpy()]) - origin])
            for k in np.unique(fold):
                own = z[fold == k]
                folds[int(k)] = folds.get(int(k), 0) + own.T @ own
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(folds), pa.int32()), pa.array([m.ravel() for m in folds.values()], pa.list_(pa.float64()))],
            names=["fold", "products"])

    return run


def fold_moments(data: DataFrame, fold_col: str = "fold", features_col: str = "features",
                 label_col: str = "label") -> dict[int, Moments]:
    """The sums of every fold, in one scan."""
    ship_package(data.sparkSession)
    rows = data.select(F.col(fold_col).cast("int").alias("fold"), F.col(label_col).cast("double").alias("label"),
                       vector_to_array(features_col).alias("x"))
    first = rows.first()
    if first is None:
        raise ValueError("a linear fit needs rows")
    origin = np.array([*first["x"], first["label"]])
    sums = rows.mapInArrow(_sums(origin), "fold int, products array<double>").select(
        "fold", F.posexplode("products").alias("cell", "v")).groupBy("fold", "cell").agg(F.sum("v").alias("v"))
    size = len(origin) + 1
    folds: dict[int, np.ndarray] = {}
    for r in sums.collect():
        folds.setdefault(r["fold"], np.zeros(size * size))[r["cell"]] = r["v"]
    return {k: Moments(m.reshape(size, size), origin) for k, m in sorted(folds.items())}


def total(folds: Mapping[int, Moments]) -> Moments:
    parts = list(folds.values())
    return Moments(sum(m.products for m in parts), parts[0].origin)


def fold_fits(data: DataFrame, fold_col: str = "fold") -> tuple[LinearModel, dict[int, LinearModel]]:
    """The full least-squares fit, and per fold the fit without its rows."""
    folds = fold_moments(data, fold_col)
    whole = total(folds)
    return whole.fit(), {k: (whole - m).fit() for k, m in folds.items()}


def ridge(data: DataFrame, alpha: float, features_col: str = "features") -> LinearModel:
    """Closed-form ridge with an intercept that is not penalised."""
    moments = total(fold_moments(data.withColumn("_one", F.lit(0)), "_one", features_col))
    return moments.fit(alpha, features_col)
