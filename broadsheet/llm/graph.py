"""Connected components of a graph given as edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from broadsheet.session import durable

MAX_ROUNDS = 100


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node hands its larger neighbours over to the smallest node that it knows."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.least("a", "m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node ties its smaller neighbours and itself to the smallest of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    others = edges.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return others.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``(id, comp)`` for every node of ``(a, b)`` edges: the smallest id that it reaches.

    Alternates large and small stars until nothing changes, which takes a number of rounds that grows with the logarithm of
    the graph. Each round is written, so that a lost executor costs one round. Nulls are not allowed; loops are ignored.
    """
    now = durable(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    mark = None
    for _ in range(MAX_ROUNDS):
        now = durable(_small_star(_large_star(now)))
        last, mark = mark, tuple(now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if mark == last or mark[0] == 0:
            break
    else:
        raise RuntimeError("components did not settle")
    return now.select(F.col("a").alias("id"), F.col("b").alias("comp")).unionByName(
        now.select(F.col("b").alias("id"), F.col("b").alias("comp")).distinct()
    )
