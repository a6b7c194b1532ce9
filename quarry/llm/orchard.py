"""K-means over integer vectors with Orchard's nearest-centroid search.

Each centroid keeps a list of the others by their distance from it.  A vector
walks the list of the closest centroid found so far: when one in it is closer,
the walk goes on in that one's list, and centroids already looked at are marked
and passed over.  It ends at the first in the list that is strictly farther than
twice the current distance, as none from there on can be as close (squared:
strictly beyond four times).  All vectors of an Arrow batch walk together.

Vectors are scaled to integers, so distances, sums and centroids are exact and do
not depend on how rows are dealt.  Tasks add up their vectors per centroid before
the shuffle; the driver sees the centroids alone, ``k`` times ``dim`` numbers.

Defined results: a vector that is null, has not ``dim`` components, or has one
that is null or not finite is left out.  Repeated rows count each; a null
``vec_id`` is assigned like any other and is the last to become a start.  With
fewer than ``k`` vectors there are as many centroids as vectors.  Equal hashes
of starts go by their components, equal distances to the smaller centroid.  A
component whose scaled size passes ``MOST`` raises, as squared distances would
leave 64 bits.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import materialize, ship_package

K = 16
ROUNDS = 3
DIM = 64
SCALE = 64
#: Largest scaled component: four times a squared distance of 64 such fits 64 bits.
MOST = 1 << 26


class Orchard:
    """Exact nearest centroids, smaller numbers first among equals."""

    def __init__(self, centroids: np.ndarray):
        self.c = centroids
        k = len(centroids)
        gap = ((centroids[:, None] - centroids[None]) ** 2).sum(axis=2)
        #: Per centroid the others, nearest first, and how far they are.
        self.others = np.array([[j for j in np.lexsort((np.arange(k), gap[i])) if j != i] for i in range(k)]).reshape(k, -1)
        self.far = np.take_along_axis(gap, self.others, axis=1) if k > 1 else gap[:, :0]

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Centroid and squared distance of every vector, and the distances taken."""
        n, k = len(x), len(self.c)
        now, at = np.zeros(n, np.int64), np.zeros(n, np.int64)
        best = ((x - self.c[0]) ** 2).sum(axis=1)
        seen = np.zeros((n, k), bool)
        seen[:, 0] = True
        taken, walking = n, np.arange(n if k > 1 else 0)
        while len(walking):
            walking = walking[self.far[now[walking], at[walking]] <= 4 * best[walking]]
            other = self.others[now[walking], at[walking]]
            at[walking] += 1
            new = ~seen[walking, other]
            look, other = walking[new], other[new]
            seen[look, other] = True
            d = ((x[look] - self.c[other]) ** 2).sum(axis=1)
            taken += len(look)
            closer = (d < best[look]) | ((d == best[look]) & (other < now[look]))
            hit = look[closer]
            now[hit], best[hit], at[hit] = other[closer], d[closer], 0
            walking = walking[at[walking] < k - 1]
        return now, best, taken


def integer_vectors(vectors: DataFrame, dim: int = DIM, scale: int = SCALE) -> DataFrame:
    """``vec_id, q``: the vectors that count, scaled and floored."""
    x = F.transform("embedding", lambda v: v.cast("double"))
    fine = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    small = F.forall(F.col("x"), lambda v: F.abs(v * scale) <= MOST)
    return vectors.where((F.size("embedding") == dim) & fine).select("vec_id", x.alias("x")).select(
        "vec_id", F.when(small, F.transform("x", lambda v: F.floor(v * scale).cast("int"))).otherwise(
            F.raise_error(F.lit("a component is too large for exact 64-bit distances"))).alias("q"))


def _matrix(column, dim: int) -> np.ndarray:
    return column.flatten().to_numpy().astype(np.int64).reshape(-1, dim)


def _sums(centroids: np.ndarray):
    def run(batches):
        search, k, dim = Orchard(centroids), *centroids.shape
        count, total = np.zeros(k, np.int64), np.zeros((k, dim), np.int64)
        for b in batches:
            x = _matrix(b.column(0), dim)
            who = search.nearest(x)[0]
            count += np.bincount(who, minlength=k)
            for j in np.unique(who):
                total[j] += x[who == j].sum(axis=0)
        used = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays(
            [pa.array(used.astype(np.int32)), pa.array(count[used]), pa.array(list(total[used]), pa.list_(pa.int64()))],
            names=["cluster", "n", "total"])

    return run


def _assigned(centroids: np.ndarray):
    def run(batches):
        search = Orchard(centroids)
        for b in batches:
            who, d, _ = search.nearest(_matrix(b.column(1), centroids.shape[1]))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(who.astype(np.int32)), pa.array(d)],
                                             names=["vec_id", "cluster", "distance"])

    return run


def starts(points: DataFrame, k: int = K) -> np.ndarray:
    """The vectors with the smallest hashes of their ids."""
    tag = F.sha2(F.concat(F.lit("1:"), F.col("vec_id").cast("string")), 256)
    first = points.orderBy(tag.asc_nulls_last(), "q").limit(k).select("q").collect()
    return np.array([r["q"] for r in first], np.int64)


def moved(points: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after one round; those without vectors stay."""
    parts = points.select("q").mapInArrow(_sums(centroids), "cluster int, n long, total array<long>")
    sums = parts.select("cluster", "n", F.posexplode("total").alias("axis", "v")).groupBy("cluster", "axis").agg(
        F.sum("n").alias("n"), F.sum("v").alias("v"))
    out = centroids.copy()
    for r in sums.collect():
        out[r["cluster"], r["axis"]] = r["v"] // r["n"]
    return out


def clusters(vectors: DataFrame, k: int = K, rounds: int = ROUNDS, dim: int = DIM, scale: int = SCALE) -> DataFrame:
    """``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256,
    centroid``: every vector with its centroid after ``rounds`` rounds."""
    spark = vectors.sparkSession
    ship_package(spark)
    points = materialize(integer_vectors(vectors.select("vec_id", "embedding"), dim, scale), "integer_vectors")
    centroids = starts(points, k).reshape(-1, dim)
    schema = "cluster int, cluster_inertia long, inertia long, centroid_sha256 string, centroid array<long>"
    if not len(centroids):
        kind = dict(points.dtypes)["vec_id"]
        return spark.createDataFrame([], f"vec_id {kind}, cluster int, distance long, {schema.partition(', ')[2]}")
    for _ in range(rounds):
        centroids = moved(points, centroids)
    kind = dict(points.dtypes)["vec_id"]
    own = materialize(points.mapInArrow(_assigned(centroids), f"vec_id {kind}, cluster int, distance long"), "assigned")
    inertia = {r["cluster"]: r["s"] for r in own.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}
    whole = sum(inertia.values())
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    ends = spark.createDataFrame([(j, s, whole, digest[j], centroids[j].tolist()) for j, s in inertia.items()], schema)
    # At most k rows.
    return own.join(F.broadcast(ends), "cluster").select("vec_id", "cluster", "distance", *ends.columns[1:])
