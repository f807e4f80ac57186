"""Connected components and blockwise comparison, for operators that link rows."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import settled


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, root) for the nodes of edges (a, b): the root is the smallest node that links reach.

    Alternating large and small stars: every round hangs nodes under smaller ones and keeps at most as many
    edges as there were. Minima combine on the map side; the joins are on plain columns, so that adaptive
    execution can split a hub. A round ends in a checkpoint, and all ends when nothing changes.
    """
    now = settled(edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    mark = None
    for _ in range(rounds):
        found = now.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if mark == (found["n"], found["h"]) or not found["n"]:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        mark = (found["n"], found["h"])
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        now = settled(small.unionByName(low.select("a", F.col("m").alias("b"))).distinct())
    raise RuntimeError(f"components have not settled after {rounds} rounds")


def in_blocks(rows: DataFrame, group: list[str], salt: Column, size: int, counted: DataFrame | None = None, guest: Column | None = None) -> DataFrame:
    """Deal the rows of every group into blocks, and each row to the pairs (p, q) of blocks it is part of.

    Any two rows of a group meet in one pair of blocks, but for two guests, which need not meet; blocks hold
    about ``size`` rows. Adds ``block``, ``p`` and ``q``; the group columns must not be null. ``counted`` has
    a row for each of ``rows`` and is cheaper to count; what is counted meets the rows in a join on plain columns.
    """
    guest = F.lit(False) if guest is None else guest
    blocks = lambda kind: F.ceil(F.count(F.when(kind, 1)) / size).cast("int")
    sizes = (rows if counted is None else counted).groupBy(*group).agg(blocks(~guest).alias("_own"), blocks(guest).alias("_guests"))
    # guests without a host have nobody to meet
    dealt = rows.join(sizes.where("_own > 0"), group)
    block = F.when(guest, F.col("_own") + F.pmod(salt, F.greatest("_guests", F.lit(1)))).otherwise(F.pmod(salt, F.greatest("_own", F.lit(1))))
    dealt = dealt.withColumn("block", block.cast("int"))
    others = F.sequence(F.lit(0), F.when(guest, F.col("_own")).otherwise(F.col("_own") + F.col("_guests")) - 1)
    dealt = dealt.withColumn("_other", F.explode(others))
    return dealt.select("*", F.least("block", "_other").alias("p"), F.greatest("block", "_other").alias("q")).drop("_other", "_own", "_guests")
