"""Session settings that the operators rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Case-sensitive names, errors on invalid casts, zone-less dates, plans adapted to real sizes.
SETTINGS = {
    "spark.sql.caseSensitive": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
}


def session(app: str = "lumencube", **extra: str) -> SparkSession:
    """A session with SETTINGS and ``extra`` (dots as double underscores); the master is the environment's."""
    return SparkSession.builder.appName(app).config(map=SETTINGS | {k.replace("__", "."): v for k, v in extra.items()}).getOrCreate()
