"""Connected components of an undirected edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import settle, settle_table


def _both(edges: DataFrame) -> DataFrame:
    return edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _large_star(edges: DataFrame) -> DataFrame:
    near = _both(edges)
    least = near.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return near.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    joined = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return joined.unionByName(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()


def components(edges: DataFrame, rounds: int = 40) -> DataFrame:
    """(u, v) links -> (node, root): root is the least node reachable. Nodes without links are absent.

    Per round: two minimum aggregations (combined before the shuffle) and two joins whose hub keys
    adaptive execution can split; the edge table is checkpointed, so lost executors cost one round.
    No vertex set is gathered on the driver; only an edge count and a checksum are.
    """
    now = settle(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    mark = None
    for _ in range(rounds):
        now = settle(_small_star(_large_star(now)))
        seen = now.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen == mark:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        mark = seen
    raise RuntimeError(f"components did not settle in {rounds} rounds")


#: A root with more than this part of all rows is hot; there are fewer hot roots than this.
PARTS = 1000


def least_of_root(named: DataFrame, value: str, into: str) -> DataFrame:
    """The rows of `named`, a settled table with `root`, with the least `value` of their root as `into`.

    Minima are combined before the shuffle. Roots that hold over a PARTS-th of all rows, fewer than PARTS by count, are looked up by
    broadcast, so that the rows of no root meet in one task; the others meet by root.
    """
    least = settle_table(named.groupBy("root").agg(F.min(value).alias(into), F.count("*").alias("__n")))
    total = least.agg(F.sum("__n")).first()[0] or 0
    is_hot = F.col("__n") * PARTS > total
    hot = F.broadcast(least.where(is_hot).drop("__n"))  # fewer than PARTS rows
    rest = named.join(F.broadcast(least.where(is_hot).select("root")), "root", "left_anti")
    return named.join(hot, "root").unionByName(rest.join(least.where(~is_hot).drop("__n"), "root"))
