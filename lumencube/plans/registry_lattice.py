"""Registered queries: a stored lattice of grouping sets, fed in parts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from ..operators import lattice as L
from ..scratch import shared_dir
from .registry import nth, query, t

_FLAGS = ("l_returnflag", "l_linestatus", "year")


@query(
    "SELECT l_returnflag, l_linestatus, year(l_shipdate) AS year, CAST(GROUPING(l_returnflag, l_linestatus, year(l_shipdate)) AS BIGINT) AS level, count(*) AS n, round(sum(l_extendedprice), 2) AS total,"
    " min(l_quantity) AS least, max(l_quantity) AS most, count(DISTINCT l_partkey) > 0 AS parts_within_error, median(l_extendedprice) > 0 AS median_within_error"
    " FROM lineitem GROUP BY ROLLUP (l_returnflag, l_linestatus, year(l_shipdate))"
)
def lattice_rollup(spark, d):
    """Added in two halves and merged. Sketches are compared with exact values cell by cell: distinct counts within 4 standard errors, the median's rank within 3 %."""
    rows = t(spark, d, "lineitem").withColumn("year", F.year("l_shipdate").cast("bigint"))
    measures = {"n": L.rows(), "total": L.total("l_extendedprice"), "least": L.least("l_quantity"), "most": L.most("l_quantity"), "parts": L.distinct("l_partkey"), "median": L.quantile("l_extendedprice", 0.5)}
    store = L.Lattice(spark, f"{shared_dir(spark, 'lattice')}/sales", _FLAGS, measures, L.rollup(*_FLAGS))
    store.add(rows.where(nth("l_orderkey", 2) == 0))
    store.add(rows.where(nth("l_orderkey", 2) == 1))
    cells = store.read()
    exact = rows.rollup(*_FLAGS).agg(F.grouping_id().cast("long").alias("level"), F.count_distinct("l_partkey").alias("exact"))
    near = F.abs(F.col("parts") - F.col("exact")) <= F.greatest(F.lit(1.0), 4 * 1.04 / 64 * F.col("exact"))
    middle = (F.col("below") <= 0.53 * F.col("n")) & (F.col("upto") >= 0.47 * F.col("n"))
    both = _beside(_beside(cells, exact), _around(rows, cells, store))
    return both.select(*_FLAGS, "level", "n", F.round("total", 2).alias("total"), "least", "most", near.alias("parts_within_error"), middle.alias("median_within_error"))


def _beside(cells, other):
    """The cells with what another table says of each; null is equal to null."""
    named = other.select(*[F.col(c).alias(f"x_{c}") for c in ("level", *_FLAGS)], *[c for c in other.columns if c not in ("level", *_FLAGS)])
    same = cells.level == named.x_level
    for c in _FLAGS:
        same = same & cells[c].eqNullSafe(named[f"x_{c}"])
    return cells.join(named, same).drop(*[f"x_{c}" for c in ("level", *_FLAGS)])


def _around(rows, cells, store):
    """For each cell how many of its rows lie below its median, and how many up to it; one pass a level."""
    found = []
    for dims in store.sets:
        level = store.level(dims)
        own = cells.where(F.col("level") == level).select("level", *dims, "median")
        met = rows.withColumn("level", F.lit(level).cast("long")).join(own, ["level", *dims])
        sums = [F.sum((F.col("l_extendedprice") < F.col("median")).cast("long")).alias("below"), F.sum((F.col("l_extendedprice") <= F.col("median")).cast("long")).alias("upto")]
        found.append(met.groupBy("level", *dims).agg(*sums).select("level", *[F.col(c) if c in dims else F.lit(None).cast(rows.schema[c].dataType).alias(c) for c in _FLAGS], "below", "upto"))
    return reduce(lambda a, b: a.unionByName(b), found)


@query("SELECT o_orderpriority, count(*) AS n, round(sum(o_totalprice), 2) AS total, max(o_orderdate) AS latest FROM orders GROUP BY o_orderpriority")
def lattice_merged_grouping(spark, d):
    """A grouping that is not stored, merged from the smallest one that has its columns; after the parts were compacted."""
    rows = t(spark, d, "orders").withColumn("year", F.year("o_orderdate"))
    dims = ["o_orderstatus", "o_orderpriority", "year"]
    store = L.Lattice(spark, f"{shared_dir(spark, 'lattice')}/orders", dims, {"n": L.rows(), "total": L.total("o_totalprice"), "latest": L.most("o_orderdate")}, [dims, ["o_orderpriority", "year"]])
    for k in range(3):
        store.add(rows.where(nth("o_orderkey", 3) == k))
    store.compact()
    return store.group("o_orderpriority").withColumn("total", F.round("total", 2))


@query("SELECT o_orderstatus, o_orderpriority, CAST(GROUPING(o_orderstatus, o_orderpriority) AS BIGINT) AS level, count(*) AS n, count(CASE WHEN o_orderkey % 4 <> 0 THEN o_totalprice END) AS priced FROM (SELECT CASE WHEN o_orderkey % 7 <> 0 THEN o_orderstatus END AS o_orderstatus, o_orderpriority, o_orderkey, o_totalprice FROM orders) GROUP BY CUBE (o_orderstatus, o_orderpriority)")
def lattice_cube(spark, d):
    """Null is a value of its own beside the totals."""
    rows = t(spark, d, "orders").select(F.when(nth("o_orderkey", 7) != 0, F.col("o_orderstatus")).alias("o_orderstatus"), "o_orderpriority", F.when(nth("o_orderkey", 4) != 0, F.col("o_totalprice")).alias("price"))
    dims = ["o_orderstatus", "o_orderpriority"]
    store = L.Lattice(spark, f"{shared_dir(spark, 'lattice')}/cube", dims, {"n": L.rows(), "priced": L.count("price")}, L.cube(*dims))
    store.add(rows)
    return store.read()
