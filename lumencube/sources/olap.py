"""Quoted exports of OLAP tools: titles, sub-headers and totals around the rows that count."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.numbers import italian_number, start_year
from ..functions.text import strip

# Row labels that are no data.
TOTAL = "Totale"
SUBHEADERS = ("Provincia di residenza", "Provincia  della sede INPS")


def _cells(spark: SparkSession, path: str, encoding: str):
    lines = spark.read.option("encoding", encoding).text(path)
    cells = F.regexp_extract_all("value", F.lit('"([^"]*)"'), F.lit(1))
    return lines.select(F.transform(cells, strip).alias("cells"))


def read_export(spark: SparkSession, path: str, columns: Sequence[str], drop: Sequence[str] = (TOTAL, *SUBHEADERS), encoding: str = "utf-8") -> DataFrame:
    """Rows with exactly as many quoted cells as ``columns``, as text, without those labelled ``drop``.

    Titles have another number of cells, so no line numbers are needed and the file splits.
    """
    rows = _cells(spark, path, encoding).where(F.size("cells") == len(columns)).where(~F.get("cells", F.lit(0)).isin(*drop))
    return rows.select(*[F.get("cells", F.lit(k)).alias(c) for k, c in enumerate(columns)])


def read_start_years(spark: SparkSession, path: str, encoding: str = "utf-8") -> DataFrame:
    """Pensions by start year: label, year, count, start age, mean, mean at start, age; rows without year or count go."""
    cells = _cells(spark, path, encoding).where(F.size("cells") >= 3)
    get = lambda k: F.get("cells", F.lit(k))
    names = ("eta_decorrenza", "importo_medio", "importo_medio_decorrenza", "eta")
    rows = cells.select(start_year(get(0)).alias("anno_decorrenza"), italian_number(get(2)).cast("bigint").alias("numero_pensioni"), *[italian_number(get(3 + k)).alias(n) for k, n in enumerate(names)])
    return rows.where(F.col("anno_decorrenza").isNotNull() & F.col("numero_pensioni").isNotNull())
