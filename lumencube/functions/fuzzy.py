"""Similarity of short texts by the longest common subsequence."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def lcs_length(a: str, b: str) -> int:
    """Bit-parallel: one machine operation for each character of ``b``."""
    if not a or not b:
        return 0
    places: dict[str, int] = {}
    for k, c in enumerate(a):
        places[c] = places.get(c, 0) | 1 << k
    full = (1 << len(a)) - 1
    row = full
    for c in b:
        match = row & places.get(c, 0)
        row = ((row + match) | (row - match)) & full
    return len(a) - row.bit_count()


def ratio(a: str, b: str) -> float:
    """100 x 2 x LCS / (len(a) + len(b)); two empty texts are alike."""
    both = len(a) + len(b)
    return 100.0 * 2 * lcs_length(a, b) / both if both else 100.0


def ratio_column(a: Column, b: Column) -> Column:
    """``ratio`` in Arrow batches; null if either is null."""

    @F.pandas_udf("double")
    def score(left: pd.Series, right: pd.Series) -> pd.Series:
        return pd.Series([None if x is None or y is None else ratio(x, y) for x, y in zip(left, right, strict=True)], dtype="float64")

    return score(a, b)


def may_reach(a: Column, b: Column, least: float) -> Column:
    """False only where ``ratio`` is surely under ``least``: the edit distance is at most the insertions and deletions."""
    both = F.char_length(a) + F.char_length(b)
    return F.levenshtein(a, b) <= F.floor(F.lit(1 - least / 100) * both + 1e-9)


def _length_bounds(n: Column, least: float) -> tuple[Column, Column]:
    """The least and greatest length of a text whose ratio with one of ``n`` characters may be ``least``."""
    low, high = F.ceil(n * (least / (200 - least)) - 1e-9), F.floor(n * ((200 - least) / least) + 1e-9)
    return low.cast("int"), F.greatest(low, high).cast("int")


def _edits(n: Column, least: float) -> Column:
    """The insertions and deletions allowed between a name of ``n`` characters and a text of any length that may match."""
    return F.floor(n * (2 * (100 - least) / least) + 1e-9).cast("int")


def _blocked(keys: DataFrame, names: DataFrame, least: float) -> DataFrame:
    """Distinct (key, name) that may have a ratio of ``least`` > 0: their lengths fit and the key has a part of the
    name, moved by no more places than edits are allowed.

    A name is cut into one part more than edits are allowed, so one of them is whole in any text that matches. If that
    is more than it has characters, the lengths alone decide.
    """
    n, parts = F.col("__n"), F.col("__parts")
    start, end = F.floor(F.col("__i") * n / parts).cast("int"), F.floor((F.col("__i") + 1) * n / parts).cast("int")
    blind = _edits(n, least) >= F.greatest(n, F.lit(1))

    def numbered(rows: DataFrame) -> DataFrame:
        rows = rows.withColumn("__parts", F.when(blind, 1).otherwise(_edits(n, least) + 1))
        return rows.withColumn("__i", F.explode(F.sequence(F.lit(0), parts - 1))).withColumns({"__from": start, "__len": end - start})

    cut = numbered(names.select("name", F.char_length("name").alias("__n")))
    cut = cut.select("name", "__n", "__i", F.when(blind, "").otherwise(F.substr("name", F.col("__from") + 1, F.col("__len"))).alias("__part"))
    said = keys.select("key", F.explode(F.sequence(*_length_bounds(F.char_length("key"), least))).alias("__n"))
    size = F.char_length("key")
    move = F.floor(F.lit(1 - least / 100) * (size + n) + 1e-9).cast("int")
    first, last = F.greatest(F.lit(0), F.col("__from") - move), F.least(size - F.col("__len"), F.col("__from") + move)
    pieces = F.when(blind, F.array(F.lit(""))).when(last < first, F.array().cast("array<string>"))
    pieces = pieces.otherwise(F.array_distinct(F.transform(F.sequence(first, F.greatest(first, last)), lambda p: F.substr("key", p + 1, F.col("__len")))))
    said = numbered(said).select("key", "__n", "__i", F.explode(pieces).alias("__part"))
    return said.join(cut, ["__n", "__i", "__part"]).select("key", "name").where(may_reach(F.col("key"), F.col("name"), least)).distinct()


def _sharing(keys: DataFrame, names: DataFrame) -> DataFrame:
    """Distinct (key, name) with a character in common, or both empty: all others have a ratio of 0."""

    def each(c: str) -> Column:
        return F.explode(F.when(F.col(c) == "", F.array(F.lit(""))).otherwise(F.array_distinct(F.regexp_extract_all(c, F.lit("(?s)."), F.lit(0))))).alias("__c")

    return keys.select("key", each("key")).join(names.select("name", each("name")), "__c").select("key", "name").distinct()


def best_matches(keys: DataFrame, names: DataFrame, least: float, tie: str) -> DataFrame:
    """(key, the columns of ``names``, score): for each distinct ``key`` the ``name`` with the best ratio of ``least`` or more.

    Ties go to the lowest ``tie``; null keys and names match nothing. Each distinct name is compared once, and keys
    meet names by equi-joins only: on a part of the name and both lengths, so neither a frequent name nor a frequent
    length brings all texts together; the edit distance then leaves few pairs to Python. Thresholds so low that a
    name has no part left (about 67 and less) meet on the lengths, and 0 on any shared character.
    """
    left = keys.select("key").where(F.col("key").isNotNull()).distinct()
    rows = names.where(F.col("name").isNotNull()).groupBy("name").agg(F.min(F.struct(F.col(tie).alias("__tie"), *[F.col(c).alias(f"__c{k}") for k, c in enumerate(names.columns)])).alias("row"))
    distinct = names.select("name").where(F.col("name").isNotNull()).distinct()
    pairs = _blocked(left, distinct, least) if least > 0 else _sharing(left, distinct)
    scored = pairs.withColumn("score", ratio_column(F.col("key"), F.col("name"))).where(F.col("score") >= least)
    best = scored.join(rows, "name").groupBy("key").agg(F.min(F.struct((-F.col("score")).alias("__score"), "row")).alias("b"))
    found = best.select("key", "b.row", (-F.col("b.__score")).alias("score"))
    if least <= 0:  # a ratio of 0 is enough: the lowest of all rows, which is one row by construction
        lowest = rows.agg(F.min("row").alias("row")).where(F.col("row").isNotNull()).select(F.lit(0).alias("__one"), "row")
        rest = left.join(found, "key", "left_anti").withColumn("__one", F.lit(0)).join(F.broadcast(lowest), "__one")
        found = found.unionByName(rest.select("key", "row", F.lit(0.0).alias("score")))
    return found.select("key", *[F.col(f"row.__c{k}").alias(c) for k, c in enumerate(names.columns)], "score")
