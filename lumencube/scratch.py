"""Scratch tables in the folder that the driver and every executor share."""

from __future__ import annotations

import atexit
import contextlib
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Rows of a partition in ``parts``.
PART_ROWS = 250_000
_made: list[tuple[SparkSession, str]] = []


def shared_dir(spark: SparkSession, label: str = "lumencube") -> str:
    """A new folder under ``spark.checkpoint.dir``, as the cluster names it.

    Only a local master without that setting gets a temporary folder of its own; elsewhere a missing
    setting is an error. The folder is removed when the driver's Python ends.
    """
    conf = spark.sparkContext.getConf()
    base = conf.get("spark.checkpoint.dir")
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", conf.get("spark.master", "local")):  # local-cluster has executors of its own
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="lumencube-")
        spark.sparkContext._conf.set("spark.checkpoint.dir", base)
    if not _made:
        atexit.register(_clean)
    path = f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"
    _made.append((spark, path))
    return path


def _clean() -> None:
    for spark, path in _made:
        with contextlib.suppress(Exception):  # the session may have ended; what is left is scratch
            place = spark._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
    _made.clear()


def written(df: DataFrame, path: str, by: list[str] | None = None) -> DataFrame:
    """Cut the lineage of ``df`` with a Parquet table at ``path``; survives lost executors."""
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*by) if by else writer).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def parts(df: DataFrame, rows: int | None = None) -> int:
    """So many partitions that one has about ``rows`` rows of ``df``, ``PART_ROWS`` by default. One pass counts them."""
    return max(-(-df.count() // (rows or PART_ROWS)), df.sparkSession.sparkContext.defaultParallelism)


def distinct(df: DataFrame, n: int) -> DataFrame:
    """Each row once. Rows are dealt out to ``n`` partitions first, so a task holds its share however few files ``df`` has and whatever adaptive execution would merge."""
    return df.repartition(n, *df.columns).dropDuplicates()
