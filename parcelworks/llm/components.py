"""Connected components by alternating stars, in a few rounds of joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelworks.session import in_few_tasks, stage_table, to_all


def _pairs(first: tuple[str, str], second: tuple[str, str], names: tuple[str, str]) -> Column:
    """Two rows of two columns out of each row."""
    return F.inline(F.array(*[F.struct(*[F.col(c).alias(n) for c, n in zip(pair, names, strict=True)]) for pair in (first, second)]))


def _large_star(edges: DataFrame, count: int) -> DataFrame:
    least = edges.select(_pairs(("hi", "lo"), ("lo", "hi"), ("at", "to"))).groupBy("at").agg(F.min("to").alias("least"))
    far = edges.join(to_all(least, 2 * count), F.col("lo") == F.col("at"))
    return far.select("hi", F.least("at", "least").alias("lo"))


def _small_star(edges: DataFrame, count: int) -> DataFrame:
    least = edges.groupBy(F.col("hi").alias("at")).agg(F.min("lo").alias("least"))
    near = edges.join(to_all(least, count), F.col("hi") == F.col("at"))
    return near.select(_pairs(("lo", "least"), ("hi", "least"), ("hi", "lo"))).where("hi != lo").distinct()


def _settled(edges: DataFrame, count: int) -> bool:
    """Every node has one edge to a least node, or is one."""
    up = F.inline(F.array(*[F.struct(F.col(c).alias("node"), F.lit(n).alias("up")) for c, n in (("hi", 1), ("lo", 0))]))
    roles = edges.select(up).groupBy("node").agg(F.sum("up").alias("up"), F.min("up").alias("least"))
    return not in_few_tasks(roles, 2 * count).where("up > least").agg(F.count(F.lit(1))).first()[0]


def components(edges: DataFrame, a: str = "a", b: str = "b", rows: int | None = None) -> DataFrame:
    """``node`` and ``component`` (its least node) for every node of an undirected edge.

    Loops and repeated edges are harmless; without edges the result is empty. No group is
    gathered: least neighbours are combined before the shuffle, and joins on a hot node
    are inner joins that adaptive execution can split; up to a fixed number of least
    neighbours are sent to the edges instead. Each round is written to the shared folder,
    by no more tasks than its edges need. ``rows``: a bound of their number, if one is known.
    """
    now = edges.select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo")).where("hi != lo").distinct()
    now = stage_table(in_few_tasks(now, rows), "edges")
    # A round never adds edges.
    count = now.count()
    while not _settled(now, count):
        now = stage_table(in_few_tasks(_small_star(_large_star(now, count), count), count), "edges")
    nodes = now.select(F.col("hi").alias("node"), F.col("lo").alias("component"))
    return nodes.unionByName(now.select(F.col("lo").alias("node"), F.col("lo").alias("component")).distinct())
