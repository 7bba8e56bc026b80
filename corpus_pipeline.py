"""Corpus pipeline: language ID, line dedup, SimHash near-dedup, benchmark decontamination, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns
of ``docs``, whatever their names, and keep null ids, texts and other values as their docstrings say;
an empty table stays empty. Only doc_id, text, lang and n_chars are read. ``run`` writes each result as Parquet in the shared folder and gives the reread
table to the next stage.
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumencube.llm import decontaminate, langid, linededup, packing, simhash
from lumencube.llm.common import apart, shared_dir, table, written


def _keeps_columns(stage):
    """The stage sees the columns it reads and all others under names of their own, and gives all their names back."""

    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        read = {c: c for c in ("doc_id", "text", "lang", "n_chars") if c in docs.columns}
        return stage(spark, apart(docs, **read), sf_dir).toDF(*docs.columns)

    return run


@_keeps_columns
def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the language models reject, those without a letter (null and empty texts) among them."""
    return langid.without_rejected(docs, langid.learn(docs.where(~langid.held_out())))


@_keeps_columns
def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop repeated lines; every document stays, n_chars follows its text. Null texts become empty; rows with a null id stay as they are."""
    kept = linededup.dedup_lines(docs).select(*docs.columns)
    return kept.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


@_keeps_columns
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one row of each group: of those with its smallest id the one whose text has the smallest hash (any of
    rows equal in both). Rows with a null id stay as they are."""
    groups = simhash.near_duplicates(docs).where(F.col("doc_id") == F.col("component_id"))
    texts = groups.groupBy("doc_id", "print").agg(F.count(F.lit(1)).alias("n"))
    first = texts.groupBy(F.col("doc_id").alias("__id")).agg(F.min(F.struct("print", "n")).alias("f")).select("__id", F.col("f.print").alias("__print"), F.col("f.n").alias("__n"))
    first = written(first, f"{shared_dir(spark)}/first")
    chosen = docs.where(F.col("doc_id").isNotNull()).join(first, (F.col("doc_id").cast("long") == F.col("__id")) & (F.xxhash64(F.col("text").cast("string")) == F.col("__print")))
    out = chosen.where(F.col("__n") == 1).select(*docs.columns)
    if not first.where(F.col("__n") > 1).isEmpty():
        again = chosen.where(F.col("__n") > 1).groupBy("__id").agg(F.any_value(F.struct(*docs.columns)).alias("row"))
        out = out.unionByName(again.select("row.*"))
    return out.unionByName(docs.where(F.col("doc_id").isNull()))


@_keeps_columns
def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that hold a test item of ``benchmark``; null and empty texts stay."""
    return decontaminate.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all remaining documents and their places in sequences; null texts are one end id."""
    return packing.pack(apart(docs, doc_id="doc_id", text="text"))


STAGES = [
    ("language ID", language_id),
    ("line dedup", line_dedup),
    ("SimHash near-dedup", near_dedup),
    ("benchmark decontamination", decontamination),
    ("best-fit packing", best_fit_packing),
]

#: SQL can express neither the language models nor the token ids; tests/llm/test_pipeline.py has the brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, home = table(spark, sf_dir, "documents"), shared_dir(spark)
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = written(docs, f"{home}/stage{k}")
    return docs
