"""Connected components of a graph given as edges, by alternating large-star and small-star steps.

Each step is a grouped minimum and a join; no neighbourhood is gathered in one place, and a root that many edges
meet is dealt to SALTS tasks. Edges are written to the
shared folder after each round, so lineage stays short. Loops and repeated edges do no harm; edges with a NULL
end are left out; without edges the result is empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import shared


SALTS = 16


def _with_least(edges: DataFrame, least: DataFrame) -> DataFrame:
    """edges (a, b) with the row of `least` of their a; the edges of one a lie in SALTS tasks."""
    salted = edges.withColumn("salt", F.pmod(F.xxhash64("b"), F.lit(SALTS)))
    copies = least.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    return salted.join(copies, ["a", "salt"]).drop("salt")


def _star(edges: DataFrame, large: bool) -> DataFrame:
    if large:
        near = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = near.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        linked = _with_least(near.where(F.col("b") > F.col("a")), least).select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = down.groupBy("a").agg(F.min("b").alias("m"))
        linked = _with_least(down, least).select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
    return linked.where(F.col("a") != F.col("b")).distinct()


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """edges (a, b) -> (node, component): component is the smallest node reached. Raises if `rounds` do not suffice."""
    now = shared.keep(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "cc")
    state = None
    for _ in range(rounds):
        before, now = now, shared.keep(_star(_star(now, True), False), "cc")
        shared.discard(before)
        # the stars no longer change when every node points to one root and the sum over the edges stays
        found = now.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
        if (found["n"], found["s"]) == state:
            break
        state = (found["n"], found["s"])
    else:
        raise RuntimeError("the components did not settle")
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
