"""Connected components over distributed edges.

Alternating large-star and small-star steps over a DataFrame of edges: every step groups by node with
a combinable minimum and joins it back (a join that adaptive execution can split when a hub is hot).
Each round is staged in the shared folder, so lost executors cost one round at most. Only three
numbers per round reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import few_files, stage


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Point every neighbour (large: the greater ones; small: the smaller ones) at the least of them."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else edges
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    joined = both.join(least, "a")
    if large:
        out = joined.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:   # edges run from the greater node a to the smaller b
        out = joined.select(F.explode(F.array("a", "b")).alias("a"), F.col("m").alias("b"))
    return out.where("a <> b").distinct()


def connected_components(edges: DataFrame, about: int = 1 << 40, max_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b: long); component is its smallest node.

    Self-edges, repeated edges and either direction are fine; rows with a null end are ignored.
    No edges give no rows. ``about``, how many edges there may be, only sizes the first round's files.
    """
    cur = stage(few_files(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                          .distinct(), about), "edges")
    n, seen = cur.count(), None
    for _ in range(max_rounds):
        nxt = stage(few_files(_star(_star(cur, True), False), n), "edges")
        # a fixed point: every node points at one root and no root points anywhere
        now = nxt.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        cur, n = nxt, now.n
        if now == seen:
            return cur.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
                cur.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
        seen = now
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
