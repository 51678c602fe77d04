"""Connected components of an edge table, by alternating large and small stars.

Every round is written to the shared folder, which cuts the lineage. Only minima per node
are aggregated and joined back, so a node with very many edges spreads over tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from crmflow.storage import materialize


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m"))
    least = least.select("a", F.least("a", "m").alias("m"))
    return both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b")
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionAll(least.select("a", F.col("m").alias("b")))


def components(edges: DataFrame) -> DataFrame:
    """``edges`` with long columns a and b as rows (node, component), component the smallest node.

    Null ends and loops are left out, and nodes without other edges have no row.
    """
    current = materialize(edges.select("a", "b").filter("a <> b").distinct(), "edges")
    before = None
    while True:
        current = materialize(_small_star(_large_star(current).distinct()).distinct(), "edges")
        state = current.agg(
            F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.hash("a", "b").cast("bigint"))
        ).first()
        if state == before:
            return current.select(F.col("a").alias("node"), F.col("b").alias("component"))
        before = state
