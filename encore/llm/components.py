"""Connected components of a graph too large for one machine.

Alternating star contractions: in a large-star step every vertex gives its larger neighbours to the smallest vertex it
knows, in a small-star step its smaller ones. Both keep the components, and after a few rounds all edges run from a
vertex to the smallest of its component. Every round is written to the shared folder, which cuts the lineage. Minima are
aggregated before they shuffle; a vertex with very many edges is joined with its single minimum, which adaptive
execution splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from encore.storage import materialize


def _star(edges: DataFrame, large: bool) -> DataFrame:
    both = edges.union(edges.select("v", "u")) if large else edges
    least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("w"), F.least("u", "m").alias("m"))
    # By a shuffle at every size: small files may hold a large table, which would pass the driver.
    moved = both.join(least.hint("merge"), both["u"] == least["w"])
    moved = moved.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")) if large else (
        moved.select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select(F.col("w").alias("u"), F.col("m").alias("v")))
    )
    return moved.filter("u <> v").distinct()


def components(edges: DataFrame, left: str, right: str) -> DataFrame:
    """(id, component) for every vertex on an edge between different vertices; component is the smallest id reachable.

    Loops and repeated edges change nothing; edges with a null end are ignored. No edges give no rows.
    """
    a, b = F.col(left), F.col(right)
    now = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"), (a.isNull() | b.isNull()).alias("_n"))
    now = materialize(now.filter("NOT _n AND u <> v").select("u", "v").distinct(), "edges")
    mark = None
    while True:
        now = materialize(_star(_star(now, True), False), "stars")
        seen = now.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.bit_xor(F.xxhash64("v", "u"))).first()
        if seen == mark:
            return now.select(F.col("u").alias("id"), F.col("v").alias("component")).union(
                now.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
            )
        mark = seen
