"""Connected components of an edge table, by large-star and small-star rounds.

Both rounds are a grouped minimum and a join back on the vertex; a hot vertex is
one hot join key whose other side is a single row; the minima are written first,
so the join reads plain exchanges and AQE splits such a key.  Each round
is written to the shared folder, so a lost executor costs a re-read.  The rounds
end when the edges form stars: no vertex has two smaller neighbours, or both a
smaller and a larger one.  The driver sees only the count of vertices that do.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import materialize


def _is_stars(edges: DataFrame) -> bool:
    """Whether every edge goes straight from a vertex to its component's smallest."""
    ends = edges.select(F.col("u").alias("id"), F.lit(1).alias("up")).union(edges.select("v", F.lit(0)))
    seen = ends.groupBy("id").agg(F.sum("up").alias("ups"), F.min("up").alias("low"))
    return seen.where("ups > 1 or (ups = 1 and low = 0)").count() == 0


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """``id, label`` of every vertex that has an edge to another: ``label`` is
    the smallest id of its component.  Null ends and loops are ignored."""
    u, v = F.greatest(a, b), F.least(a, b)
    cur = edges.where(f"{a} is not null and {b} is not null and {a} <> {b}").select(
        u.alias("u"), v.alias("v")).distinct()
    cur = materialize(cur, "edges")
    for _ in range(max_rounds):
        if _is_stars(cur):
            tips = cur.select(F.col("u").alias("id"), F.col("v").alias("label"))
            roots = cur.select(F.col("v").alias("id"), F.col("v").alias("label")).distinct()
            return tips.union(roots)
        both = cur.union(cur.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        least = materialize(least, "least")
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # Now every edge goes from a vertex to a smaller one.
        large = materialize(large, "large")
        low = materialize(large.groupBy("u").agg(F.min("v").alias("m")), "least")
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        cur = materialize(small.union(low.select("u", "m")).distinct(), "edges")
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
