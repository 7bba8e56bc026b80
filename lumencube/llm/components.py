"""Connected components of a distributed edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import shared_dir, written


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """Label every node of ``edges`` with the smallest node it can reach.

    Returns (node, component) with one row for each node that some edge names. Null ends,
    loops and repeated edges don't matter; an empty table gives an empty result. Each round is
    two aggregations and joins on the shuffle, written to the shared folder; nothing but one
    checksum comes to the driver, and no neighbour list is ever gathered in one row. The edges of a
    hub meet one row in each join, so adaptive execution can split them.
    """
    spark = edges.sparkSession
    home = shared_dir(spark)
    lo, hi = F.least(F.col(a), F.col(b)), F.greatest(F.col(a), F.col(b))
    now = edges.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
    now = written(now.select(hi.alias("u"), lo.alias("v")).distinct(), f"{home}/cc0")
    mark = _mark(now)
    for k in range(1, max_rounds + 1):
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # aggregates are tables of their own: joined in the stage that sums them, a hub's edges could not be split
        least = written(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), f"{home}/least{k}")
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = written(large.where("u != v").distinct(), f"{home}/large{k}")
        small_least = written(large.groupBy("u").agg(F.min("v").alias("m")), f"{home}/small{k}")
        small = large.join(small_least, "u")
        now = small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(small_least.select("u", F.col("m").alias("v")))
        now = written(now.where("u != v").distinct(), f"{home}/cc{k}")
        if (new := _mark(now)) == mark:
            break
        mark = new
    else:
        raise RuntimeError("components did not settle")
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.xxhash64("v", "u").bitwiseAND(0xFFFFFFFF))).first()
    return tuple(row)
