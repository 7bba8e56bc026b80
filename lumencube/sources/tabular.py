"""CSV, Parquet and GeoJSON sources; NaN is null from the start."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, StructType

BOM = "\ufeff"


def nan_to_null(data: DataFrame) -> DataFrame:
    """One kind of missing value: NaN becomes null in every floating column."""
    floats = [f.name for f in data.schema if isinstance(f.dataType, (DoubleType, FloatType))]
    return data.withColumns({c: F.nanvl(data[c], F.lit(None)) for c in floats}) if floats else data


def read_csv(spark: SparkSession, path: str, *, sep: str = ",", quote: str = '"', encoding: str = "utf-8", header: bool = True, schema: StructType | str | None = None, infer: bool = True, keep_default_na: bool = True, na_values: tuple[str, ...] = ("NaN", "nan", "NA", "N/A", "n/a", "null", "NULL", "None"), **options) -> DataFrame:
    """A CSV with a header.

    ``infer=False`` reads every column as text. ``keep_default_na=False`` keeps the text NA and turns
    empty cells into empty text. A byte-order mark is dropped. Types are inferred after the missing
    values are known. Pass ``schema`` where rows may be longer than the first line.
    """
    bom = encoding.lower() in ("utf-8-sig", "utf_8_sig")
    reader = spark.read.option("sep", sep).option("quote", quote).option("header", header).option("encoding", "utf-8" if bom else encoding).option("escape", quote).options(**options)
    data = (reader.schema(schema) if schema else reader.option("inferSchema", False)).csv(path)
    data = data.toDF(*[c.removeprefix(BOM) for c in data.columns])
    if not keep_default_na:
        return data.na.fill("")
    text = [c for c, kind in data.dtypes if kind == "string"]
    data = data.withColumns({c: F.when(~F.col(f"`{c}`").isin(*na_values), F.col(f"`{c}`")) for c in text})
    return nan_to_null(_inferred(data, text) if infer and schema is None else data)


def _inferred(data: DataFrame, text: list[str]) -> DataFrame:
    """bigint, double or boolean where every value of a column is one; one aggregation for all columns."""
    if not text:
        return data
    tests = []
    for k, c in enumerate(text):
        v = F.col(f"`{c}`")
        some = v.isNotNull()
        tests += [
            F.count(v).alias(f"n{k}"),
            F.count_if(some & v.rlike(r"^[+-]?\d{1,18}$")).alias(f"i{k}"),
            F.count_if(some & v.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$")).alias(f"d{k}"),
            F.count_if(some & v.isin("True", "False", "true", "false")).alias(f"b{k}"),
        ]
    row = data.agg(*tests).first()
    kinds = {}
    for k, c in enumerate(text):
        for letter, kind in (("i", "bigint"), ("d", "double"), ("b", "boolean")):
            if row[f"n{k}"] and row[f"{letter}{k}"] == row[f"n{k}"]:
                kinds[c] = kind
                break
    return data.withColumns({c: F.col(f"`{c}`").cast(kind) for c, kind in kinds.items()}) if kinds else data


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return nan_to_null(spark.read.parquet(path))


def read_quoted_csv(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """Comma-separated with single quotes and a header, under an explicit schema."""
    return spark.read.option("quote", "'").option("escape", "'").option("header", True).schema(schema).csv(path)


def read_geojson(spark: SparkSession, path: str, download_from: str | None = None) -> DataFrame:
    """One row for each feature: its properties and geometry. Fetches the file first if it is absent and an address is given."""
    if download_from:
        from .remote import fetch_if_absent

        fetch_if_absent(download_from, path)
    whole = spark.read.option("multiLine", True).json(path)
    return whole.select(F.explode("features").alias("f")).select("f.properties.*", F.to_json("f.geometry").alias("geometry"))
