"""Connected components of a link table by alternating large and small stars.

Each round is two aggregations and two joins on narrow rows; minima are taken inside the map
tasks first, so a node with very many neighbours is one partial sum per task, and the joins are
plain equi-joins that adaptive execution may split. Nothing is collected. Every round is written
to the shared folder, so a lost executor costs one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.session import materialize

MAX_ROUNDS = 60


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b")
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    others = down.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return others.union(least.select("a", F.col("m").alias("b"))).where("a <> b").distinct()


def _digest(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first())


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``links (a, b)`` but the roots; the root is the least node.

    Rows with equal ends say nothing and are dropped; repeated links are allowed.
    """
    edges = materialize(_small_star(links.select("a", "b")), "star")
    before = _digest(edges)
    if not before[0]:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    for _ in range(MAX_ROUNDS):
        edges = materialize(_small_star(_large_star(edges)), "star")
        now = _digest(edges)
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("components did not settle")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
