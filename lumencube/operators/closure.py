"""Transitive closure of a relation, cycles included."""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..scratch import PART_ROWS, shared_dir, written

#: Rounds that follow one edge each, before rounds double; edges for each bucket of the tables.
SINGLE_ROUNDS, BUCKET_EDGES = 24, 100_000
_SETTINGS = {"spark.sql.requireAllClusterKeysForCoPartition": "false", "spark.sql.sources.bucketing.enabled": "true"}


@contextmanager
def _bucket_joins(spark: SparkSession) -> Iterator[None]:
    """Tables in buckets by one column are joined on two without being dealt anew; the settings are put back afterwards."""
    before = {k: spark.conf.get(k, None) for k in _SETTINGS}
    for k, v in _SETTINGS.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def transitive_closure(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 100) -> DataFrame:
    """All (a, b) with a path of one edge or more from a to b, each once; null ends have no part.

    Semi-naive. The first ``SINGLE_ROUNDS`` rounds put one edge before the newest pairs, so a pair is made once for each edge that begins a shortest path, not
    for each node between its ends; then each round joins the new pairs with all pairs known, so the rounds grow with the logarithm of the longest path.
    Each round adds its pairs to a table in buckets by ``a``, and the edges are in as many buckets by their end: what a round
    makes is dealt out once, and neither the newest pairs nor those known are dealt or written again. Sorted pairs take a few bits each in their files, from
    which Spark would take tables of many millions for small ones and send them through the driver, so joins are merge joins by hint.
    """
    spark = edges.sparkSession
    home, table, links = shared_dir(spark, "closure"), f"closure_{uuid.uuid4().hex}", f"links_{uuid.uuid4().hex}"
    first = written(edges.select(F.col(a).alias("a"), F.col(b).alias("b")).na.drop().distinct(), f"{home}/edges")
    n = max(spark.sparkContext.defaultParallelism, math.ceil(first.count() / BUCKET_EDGES))

    def added(pairs: DataFrame, k: int) -> DataFrame:
        """The pairs, once they are in the table as those of round ``k``."""
        rows = pairs.withColumn("round", F.lit(k))
        rows.write.mode("append").partitionBy("round").bucketBy(n, "a").sortBy("a", "b").option("path", f"{home}/pairs").saveAsTable(table)
        return spark.table(table).where(F.col("round") == k).select("a", "b")

    with _bucket_joins(spark):
        try:
            first.select(F.col("a").alias("s"), F.col("b").alias("m")).repartition(n, "m").write.bucketBy(n, "m").sortBy("m").option("path", f"{home}/links").saveAsTable(links)
            new = added(first.repartition(n, "a"), 0)
            for k in range(1, max_rounds + 1):
                known = spark.table(table).where(F.col("round") < k).select("a", "b")
                if k <= SINGLE_ROUNDS:
                    found = spark.table(links).join(new.select(F.col("a").alias("m"), "b").hint("merge"), "m").select(F.col("s").alias("a"), "b")
                else:
                    left = new.select("a", F.col("b").alias("m")).join(known.select(F.col("a").alias("m"), "b").hint("merge"), "m").select("a", "b")
                    right = known.select("a", F.col("b").alias("m")).join(new.select(F.col("a").alias("m"), "b").hint("merge"), "m").select("a", "b")
                    found = left.unionByName(right)
                new = added(found.repartition(n, "a").distinct().join(known.hint("merge"), ["a", "b"], "left_anti"), k)
                if new.isEmpty():
                    return spark.read.schema(first.schema).parquet(f"{home}/pairs").select("a", "b")
        finally:
            for name in (table, links):
                spark.sql(f"DROP TABLE IF EXISTS {name}")  # the files stay
    raise RuntimeError("the closure did not end")


def reachable(edges: DataFrame, starts: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 1000) -> DataFrame:
    """(start, node): what each value of ``starts`` (column start) reaches by one edge or more; only the frontier is joined.

    Tables of over ``PART_ROWS`` rows, which are counted, are joined by merge joins, as in ``transitive_closure``.
    """
    home = shared_dir(edges.sparkSession, "closure")
    links = edges.select(F.col(a).alias("__a"), F.col(b).alias("__b")).na.drop().distinct()
    front = written(starts.select("start").na.drop().distinct().withColumn("node", F.col("start")), f"{home}/starts")
    seen = None

    def sized(rows: DataFrame) -> DataFrame:
        return rows.hint("merge") if rows.count() > PART_ROWS else rows

    for k in range(max_rounds):
        step = sized(front).join(links, F.col("node") == F.col("__a")).select("start", F.col("__b").alias("node")).distinct()
        if seen is not None:
            step = step.join(sized(seen), ["start", "node"], "left_anti")
        front = written(step, f"{home}/front{k}")
        if front.isEmpty():
            return seen if seen is not None else front
        seen = front if seen is None else written(seen.unionByName(front), f"{home}/seen{k}")
    raise RuntimeError("the closure did not end")
