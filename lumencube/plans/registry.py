"""Registered queries: every operator over the driver's tables, with the SQL that gives the same rows.

The tables have no nulls, so queries that need them make them by rule on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..core import Dataset, Pipeline, PipelineStep
from ..functions.fuzzy import best_matches
from ..functions.numbers import start_year
from ..functions.text import province_key, slugify, snake_case_column, strip_accents, title_case
from ..operators import columns as C
from ..operators import link
from ..operators import reshape as P
from ..operators.closure import transitive_closure
from ..operators.index import composite_long, normalized, quintile_colours, ranked
from ..operators.observations import EmitObservations
from ..operators.rows import DropDuplicateRows, FilterRows, KeepFirst, LeftJoinEnrich
from . import cube_queries
from .profile import null_ratios
from .quality import conservation
from .sparql import Engine

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under its function's name with its oracle."""

    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def t(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def run(data: DataFrame, *steps: PipelineStep) -> DataFrame:
    return Pipeline(steps, on_error="raise").run(Dataset(data)).data


def nth(column: str, n: int) -> Column:
    return F.pmod(F.col(column), F.lit(n))


# columns ------------------------------------------------------------------------------------


@query("SELECT o_orderkey AS order_key, o_custkey AS cust_id, o_totalprice AS total_price, o_orderstatus AS status_flag FROM orders")
def normalize_column_names(spark, d):
    o = t(spark, d, "orders")
    messy = o.select(F.col("o_orderkey").alias("OrderKey"), F.col("o_custkey").alias("cust ID"), F.col("o_totalprice").alias(" Total-Price "), F.col("o_orderstatus").alias("status@Flag"))
    return run(messy, C.NormalizeColumnNames())


@query("SELECT c_custkey AS c_name, c_name AS c_custkey, c_acctbal AS balance FROM customer")
def rename_columns(spark, d):
    c = t(spark, d, "customer").select("c_custkey", "c_name", "c_acctbal")
    return run(c, C.RenameColumns({"c_custkey": "c_name", "c_name": "c_custkey", "c_acctbal": "balance"}))


@query("SELECT c_custkey, c_nationkey, c_acctbal FROM customer")
def drop_columns(spark, d):
    return run(t(spark, d, "customer"), C.DropColumns(["c_name", "c_mktsegment"]))


@query("SELECT * FROM orders")
def drop_empty_columns(spark, d):
    return run(t(spark, d, "orders").withColumn("nothing", F.lit(None).cast("string")), C.DropEmptyColumns())


@query("SELECT o_orderkey, CAST(trunc(o_totalprice) AS BIGINT) AS whole, CAST(o_totalprice AS VARCHAR) IS NOT NULL AS some, o_totalprice AS price FROM orders")
def cast_types_raise(spark, d):
    o = t(spark, d, "orders")
    text = o.select("o_orderkey", F.floor("o_totalprice").cast("string").alias("whole"), F.col("o_orderstatus").alias("some"), F.col("o_totalprice").cast("string").alias("price"))
    return run(text, C.CastTypes({"whole": "int", "some": "bool", "price": "float"}))


_BAD = "CASE WHEN o_orderkey % 7 = 0 THEN 'bad' WHEN o_orderkey % 7 = 1 THEN NULL ELSE CAST(o_totalprice AS VARCHAR) END"


@query(f"SELECT o_orderkey, TRY_CAST({_BAD} AS DOUBLE) AS price, CAST(trunc(TRY_CAST({_BAD} AS DOUBLE)) AS BIGINT) AS whole FROM orders")
def cast_types_coerce(spark, d):
    o = t(spark, d, "orders")
    bad = F.when(nth("o_orderkey", 7) == 0, "bad").when(nth("o_orderkey", 7) != 1, F.col("o_totalprice").cast("string"))
    return run(o.select("o_orderkey", bad.alias("price"), bad.alias("whole")), C.CastTypes({"price": "float", "whole": "Int64"}, errors="coerce"))


@query("SELECT o_orderkey, date_trunc('day', o_orderdate) AS day FROM orders")
def parse_dates(spark, d):
    o = t(spark, d, "orders").select("o_orderkey", F.date_format("o_orderdate", "dd/MM/yyyy").alias("day"))
    return run(o, C.ParseDates("day", "%d/%m/%Y"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE date_trunc('second', o_orderdate) END AS at FROM orders")
def parse_dates_coerce(spark, d):
    text = F.when(nth("o_orderkey", 5) == 0, "not a date").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))
    return run(t(spark, d, "orders").select("o_orderkey", text.alias("at")), C.ParseDates(["at"], "%Y-%m-%d %H:%M:%S", errors="coerce"))


def _gaps(spark, d):
    return t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.when(F.pmod(F.col("l_orderkey") + F.col("l_linenumber"), F.lit(5)) != 0, F.col("l_discount")).alias("x"))


_GAPS = "SELECT l_orderkey, l_linenumber, CASE WHEN (l_orderkey + l_linenumber) % 5 <> 0 THEN l_discount END AS x FROM lineitem"


@query(f"WITH g AS ({_GAPS}) SELECT l_orderkey, l_linenumber, round(coalesce(x, (SELECT avg(x) FROM g)), 6) AS x FROM g")
def fill_missing_mean(spark, d):
    return run(_gaps(spark, d), C.FillMissing("x", "mean")).withColumn("x", F.round("x", 6))


@query(f"WITH g AS ({_GAPS}) SELECT l_orderkey, l_linenumber, round(coalesce(x, (SELECT median(x) FROM g)), 6) AS x FROM g")
def fill_missing_median(spark, d):
    return run(_gaps(spark, d), C.FillMissing("x", "median")).withColumn("x", F.round("x", 6))


@query(f"WITH g AS ({_GAPS}) SELECT l_orderkey, l_linenumber, coalesce(x, -1.0) AS x FROM g")
def fill_missing_constant(spark, d):
    return run(_gaps(spark, d), C.FillMissing("x", "constant", -1.0))


_SQUEEZE = "nullif(trim(regexp_replace({}, '\\s+', ' ', 'g')), '')"
_ASCII = "regexp_replace(lower(strip_accents(translate(text, chr(8217) || chr(8216) || '`', ''''''''))), '[^\\x00-\\x7F]', '', 'g')"


@query("SELECT doc_id, " + _SQUEEZE.format(_ASCII) + " AS key FROM documents")
def add_normalized_key(spark, d):
    return run(t(spark, d, "documents").select("doc_id", "text"), C.AddNormalizedKey("text", "key"), C.DropColumns(["text"]))


@query("SELECT doc_id, regexp_replace(strip_accents(text), '[^\\x00-\\x7F]', '', 'g') AS plain FROM documents")
def strip_accents_column(spark, d):
    return t(spark, d, "documents").select("doc_id", strip_accents(F.col("text")).alias("plain"))


@query("SELECT doc_id, trim(regexp_replace(regexp_replace(strip_accents(lower(trim(text, chr(32) || chr(9) || chr(10) || chr(13)))), '\\s*-\\s*', '-', 'g'), '\\s+', ' ', 'g')) AS key FROM documents")
def place_name_key(spark, d):
    return t(spark, d, "documents").select("doc_id", province_key(F.col("text")).alias("key"))


_SLUG = "regexp_replace(regexp_replace(regexp_replace(strip_accents(lower(c_name || ' / ' || c_mktsegment)), '[\\s\\-/'']+', '-', 'g'), '[^a-z0-9-]', '', 'g'), '-+', '-', 'g')"


@query(f"SELECT c_custkey, regexp_replace({_SLUG}, '^-+|-+$', '', 'g') AS slug FROM customer")
def slugify_column(spark, d):
    return t(spark, d, "customer").select("c_custkey", slugify(F.concat_ws(" / ", "c_name", "c_mktsegment")).alias("slug"))


@query("SELECT p_partkey, trim(regexp_replace(lower(regexp_replace(p_name || ' ' || p_type, '([a-z0-9])([A-Z])', '\\1_\\2', 'g')), '[^a-z0-9]+', '_', 'g'), '_') AS snake FROM part")
def snake_case_values(spark, d):
    return t(spark, d, "part").select("p_partkey", snake_case_column(F.concat_ws(" ", "p_name", "p_type")).alias("snake"))


@query("SELECT p_partkey, array_to_string(list_transform(string_split(lower(p_type), ' '), lambda x: upper(x[1]) || x[2:]), ' ') AS title FROM part")
def title_case_values(spark, d):
    return t(spark, d, "part").select("p_partkey", title_case(F.col("p_type")).alias("title"))


_IT = "CASE WHEN o_orderkey % 9 = 0 THEN '-' WHEN o_orderkey % 9 = 1 THEN ' n.d. ' WHEN o_orderkey % 9 = 2 THEN '12%' ELSE replace(replace(replace(format('{:,.2f}', o_totalprice), ',', 'x'), '.', ','), 'x', '.') END"


def _italian(spark, d):
    money = F.translate(F.format_number("o_totalprice", 2), ",.", ".,")
    text = F.when(nth("o_orderkey", 9) == 0, "-").when(nth("o_orderkey", 9) == 1, " n.d. ").when(nth("o_orderkey", 9) == 2, "12%").otherwise(money)
    return t(spark, d, "orders").select("o_orderkey", "o_totalprice", text.alias("amount"))


@query("SELECT o_orderkey, o_totalprice, CASE WHEN o_orderkey % 9 > 2 THEN round(o_totalprice, 2) END AS amount FROM orders")
def parse_italian_numbers(spark, d):
    return run(_italian(spark, d), C.ParseItalianNumbers(["amount", "o_totalprice"])).withColumn("amount", F.round("amount", 2))


@query("SELECT o_orderkey, CAST(CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE o_orderkey % 100 END AS BIGINT) AS pct, o_orderpriority AS other FROM orders")
def parse_italian_numbers_auto(spark, d):
    text = F.when(nth("o_orderkey", 4) == 0, "-").otherwise(F.concat((F.col("o_orderkey") % 100).cast("string"), F.lit(" %")))
    return run(t(spark, d, "orders").select("o_orderkey", text.alias("pct"), F.col("o_orderpriority").alias("other")), C.ParseItalianNumbersAuto())


@query("SELECT o_orderkey, CAST(CASE WHEN o_orderkey % 6 = 0 THEN NULL ELSE year(o_orderdate) END AS INTEGER) AS year FROM orders")
def start_years_from_labels(spark, d):
    label = F.when(nth("o_orderkey", 6) == 0, "Totale").otherwise(F.concat(F.lit("Decorrenza nel "), F.year("o_orderdate").cast("string"), F.lit(" e dopo")))
    return t(spark, d, "orders").select("o_orderkey", start_year(label).alias("year"))


@query("SELECT o_orderkey, round(o_totalprice * (o_orderkey % 11) * 13 / 1000000.0, 9) AS annual FROM orders WHERE o_orderkey % 3 > 0 UNION ALL SELECT o_orderkey, NULL FROM orders WHERE o_orderkey % 3 = 0")
def estimate_annual(spark, d):
    o = t(spark, d, "orders").select("o_orderkey", F.when(nth("o_orderkey", 3) > 0, F.col("o_totalprice")).alias("m"), nth("o_orderkey", 11).alias("n"))
    return run(o, C.EstimateAnnualAmount("n", "m", "annual", scale=1e-6), C.DropColumns(["n", "m"])).withColumn("annual", F.round("annual", 9))


_CODES = {"1-URGENT": 1, "2-HIGH": 2, "3-MEDIUM": 3, "4-NOT SPECIFIED": 4, "5-LOW": 5}


@query("SELECT o_orderkey, CAST(try_cast(left(o_orderpriority, 1) AS BIGINT) AS BIGINT) AS code, CASE o_orderpriority WHEN '1-URGENT' THEN 'soon' WHEN '2-HIGH' THEN 'soon' WHEN '5-LOW' THEN 'later' END AS speed FROM orders")
def static_mapping(spark, d):
    o = t(spark, d, "orders").select("o_orderkey", "o_orderpriority")
    maps = {"code": _CODES, "speed": {"1-URGENT": "soon", "2-HIGH": "soon", "5-LOW": "later"}}
    return run(o, C.EnrichWithStaticMapping("o_orderpriority", maps), C.DropColumns(["o_orderpriority"]))


@query("SELECT o_orderkey, 'x' AS constant, CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') AND year(o_orderdate) BETWEEN 1993 AND 1996 THEN 'E' ELSE 'A' END AS status, CASE WHEN o_orderkey % 2 = 0 THEN 'a,b' ELSE '' END AS sources FROM orders")
def constant_and_conditional_columns(spark, d):
    o = t(spark, d, "orders")
    status = F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH") & F.year("o_orderdate").between(1993, 1996), "E").otherwise("A")
    sources = F.array_join(F.filter(F.array(F.when(nth("o_orderkey", 2) == 0, "a"), F.when(nth("o_orderkey", 2) == 0, "b")), lambda x: x.isNotNull()), ",")
    return run(o, C.WithColumn("constant", "x"), C.WithColumn("status", status), C.WithColumn("sources", sources)).select("o_orderkey", "constant", "status", "sources")


_DIGITS = "regexp_replace(phone, '\\D', '', 'g')"


@query(f"WITH p AS (SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN '0039 ' || c_custkey || '-55' WHEN c_custkey % 3 = 1 THEN '+39/' || c_custkey ELSE 'none' END AS phone FROM customer) SELECT c_custkey, '+39 ' || nullif(regexp_replace(regexp_replace({_DIGITS}, '^00', ''), '^39', ''), '') AS phone FROM p")
def format_phone(spark, d):
    key = F.col("c_custkey").cast("string")
    phone = F.when(nth("c_custkey", 3) == 0, F.concat(F.lit("0039 "), key, F.lit("-55"))).when(nth("c_custkey", 3) == 1, F.concat(F.lit("+39/"), key)).otherwise("none")
    return run(t(spark, d, "customer").select("c_custkey", phone.alias("phone")), C.FormatItalianPhone("phone"))


@query("SELECT p_partkey, left(p_name, 7) AS p_name, left(p_type, 30) AS p_type FROM part")
def smart_trim(spark, d):
    p = t(spark, d, "part").select("p_partkey", F.concat(F.lit("  "), "p_name").alias("p_name"), "p_type")
    return run(p, C.StripStringColumns(), C.SmartTrim(["p_name", "p_type"], {"p_name": 7}))


# rows ---------------------------------------------------------------------------------------


@query("SELECT DISTINCT l_returnflag, l_linestatus, l_linenumber FROM lineitem")
def drop_duplicate_rows(spark, d):
    return run(t(spark, d, "lineitem").select("l_returnflag", "l_linestatus", "l_linenumber"), DropDuplicateRows())


@query("SELECT o_custkey, o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS k FROM orders) WHERE k = 1")
def dedup_keep_first(spark, d):
    return run(t(spark, d, "orders").select("o_custkey", "o_orderkey", "o_totalprice"), KeepFirst(["o_custkey"], ["o_orderkey"]))


@query("SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE CASE WHEN l_linenumber <> 3 THEN l_quantity END > 25 AND l_returnflag NOT IN ('R')")
def filter_rows(spark, d):
    some = FilterRows(lambda x: (F.when(x["l_linenumber"] != 3, x["l_quantity"]) > 25) & ~x["l_returnflag"].isin("R"))
    return run(t(spark, d, "lineitem"), some).select("l_orderkey", "l_linenumber", "l_quantity")


@query("SELECT c_custkey, n_name, n_regionkey FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey AND n_nationkey < 15")
def left_join_enrich(spark, d):
    nation = t(spark, d, "nation").where("n_nationkey < 15")
    return run(t(spark, d, "customer"), LeftJoinEnrich(Dataset(nation), "c_nationkey", "n_nationkey", ["n_name", "n_regionkey"])).select("c_custkey", "n_name", "n_regionkey")


@query("SELECT l.l_orderkey, l.l_linenumber, l.l_quantity, r.l_quantity AS l_quantity_right FROM lineitem l LEFT JOIN (SELECT * FROM lineitem WHERE l_linenumber < 3) r ON l.l_orderkey = r.l_orderkey AND l.l_linenumber = r.l_linenumber")
def left_join_composite(spark, d):
    rows = t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return run(rows, LeftJoinEnrich(rows.where("l_linenumber < 3"), ["l_orderkey", "l_linenumber"], columns=["l_quantity"]))


@query("WITH c AS (SELECT c_custkey, CASE WHEN c_nationkey > 3 THEN c_nationkey END AS k FROM customer), n AS (SELECT CASE WHEN n_nationkey > 0 THEN n_nationkey END AS k, n_name FROM nation) SELECT c_custkey, n_name FROM c LEFT JOIN n ON c.k IS NOT DISTINCT FROM n.k")
def left_join_null_key(spark, d):
    c = t(spark, d, "customer").select("c_custkey", F.when(F.col("c_nationkey") > 3, F.col("c_nationkey")).alias("k"))
    n = t(spark, d, "nation").select(F.when(F.col("n_nationkey") > 0, F.col("n_nationkey")).alias("kk"), "n_name")
    return run(c, LeftJoinEnrich(n, "k", "kk"), C.DropColumns(["k"]))


@query("SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 150000)")
def anti_exists(spark, d):
    return t(spark, d, "customer").join(t(spark, d, "orders").where("o_totalprice > 150000"), F.col("c_custkey") == F.col("o_custkey"), "left_anti").select("c_custkey")


@query("SELECT n_name, r_name FROM nation LEFT JOIN (SELECT * FROM region WHERE r_name LIKE 'A%') ON n_regionkey = r_regionkey")
def optional_left(spark, d):
    r = t(spark, d, "region").where(F.col("r_name").startswith("A"))
    return t(spark, d, "nation").join(r, F.col("n_regionkey") == F.col("r_regionkey"), "left").select("n_name", "r_name")


@query("SELECT n_nationkey, label FROM nation JOIN (VALUES (1, 'one'), (3, 'three'), (99, 'none')) v(k, label) ON n_nationkey = k")
def values_join(spark, d):
    v = spark.createDataFrame([(1, "one"), (3, "three"), (99, "none")], "k int, label string")
    return t(spark, d, "nation").join(v, F.col("n_nationkey") == F.col("k")).select("n_nationkey", "label")


@query("SELECT a.n_name AS a, b.n_name AS b FROM nation a JOIN nation b ON a.n_regionkey = b.n_regionkey AND a.n_nationkey <> b.n_nationkey")
def theta_self_join(spark, d):
    n = t(spark, d, "nation")
    a, b = n.select(F.col("n_name").alias("a"), F.col("n_regionkey").alias("r"), F.col("n_nationkey").alias("i")), n.select(F.col("n_name").alias("b"), F.col("n_regionkey").alias("r"), F.col("n_nationkey").alias("j"))
    return a.join(b, "r").where("i <> j").select("a", "b")


@query("SELECT 'nation' AS kind, n_name AS name, CAST(n_nationkey AS BIGINT) AS k FROM nation UNION ALL SELECT 'region', r_name, NULL FROM region UNION ALL SELECT 'part', p_brand, CAST(p_size AS BIGINT) FROM part")
def union_branches(spark, d):
    a = t(spark, d, "nation").select(F.lit("nation").alias("kind"), F.col("n_name").alias("name"), F.col("n_nationkey").cast("bigint").alias("k"))
    b = t(spark, d, "region").select(F.lit("region").alias("kind"), F.col("r_name").alias("name"))
    p = t(spark, d, "part").select(F.lit("part").alias("kind"), F.col("p_brand").alias("name"), F.col("p_size").cast("bigint").alias("k"))
    return a.unionByName(b, allowMissingColumns=True).unionByName(p)


@query("SELECT DISTINCT c_mktsegment AS v FROM customer EXCEPT SELECT 'BUILDING'")
def set_difference(spark, d):
    return t(spark, d, "customer").select(F.col("c_mktsegment").alias("v")).subtract(spark.createDataFrame([("BUILDING",)], "v string"))


# aggregation and shape ----------------------------------------------------------------------


_FLAGS = ("A", "N", "R")


def _wide(spark, d):
    per = [F.sum(F.when(F.col("l_returnflag") == f, F.col("l_quantity"))).alias(f"n_{f}") for f in _FLAGS] + [F.avg(F.when(F.col("l_returnflag") == f, F.col("l_extendedprice"))).alias(f"m_{f}") for f in _FLAGS]
    return t(spark, d, "lineitem").groupBy("l_suppkey").agg(*per)


_LONG = "SELECT l_suppkey, {f} AS flag, sum(CASE WHEN l_returnflag = {f} THEN l_quantity END) AS n, avg(CASE WHEN l_returnflag = {f} THEN l_extendedprice END) AS m FROM lineitem GROUP BY l_suppkey"
_ALL = " UNION ALL ".join(_LONG.format(f=f"'{f}'") for f in _FLAGS)


@query(f"SELECT l_suppkey, flag, round(n, 2) AS n, round(m, 4) AS m FROM ({_ALL})")
def paired_unpivot(spark, d):
    got = run(_wide(spark, d), P.PairedUnpivot({f: {"n": f"n_{f}", "m": f"m_{f}"} for f in _FLAGS}, ["l_suppkey"], "flag"))
    return got.select("l_suppkey", "flag", F.round("n", 2).alias("n"), F.round("m", 4).alias("m"))


@query(f"WITH a AS ({_ALL}) SELECT l_suppkey, flag, 'count' AS measure_type, round(n, 2) AS value, false AS is_estimated FROM a UNION ALL SELECT l_suppkey, flag, 'mean', round(m, 2), false FROM a UNION ALL SELECT l_suppkey, flag, 'annual', round(n * m * 13, 2), true FROM a")
def unpivot_with_estimate(spark, d):
    step = P.UnpivotMeasures({f: (f"n_{f}", f"m_{f}") for f in _FLAGS}, {"count": "count", "mean": "mean", "annual": "annual"}, ["l_suppkey"], "flag")
    return run(_wide(spark, d), step).withColumn("value", F.round("value", 2))


_YEARS = range(1992, 1999)
_BY_YEAR = "SELECT o_custkey, year(o_orderdate) AS y, CAST(count(*) AS DOUBLE) AS n, avg(o_totalprice) AS m FROM orders WHERE year(o_orderdate) BETWEEN 1992 AND 1998 GROUP BY ALL"


@query(f"WITH a AS ({_BY_YEAR}) SELECT o_custkey, CAST(y AS INTEGER) AS anno, 'count' AS measure_type, n AS value FROM a UNION ALL SELECT o_custkey, CAST(y AS INTEGER), 'mean', round(m, 4) FROM a UNION ALL SELECT o_custkey, CAST(y AS INTEGER), 'annual', round(n * m * 13, 4) FROM a")
def unpivot_skip_all_null(spark, d):
    o = t(spark, d, "orders").withColumn("y", F.year("o_orderdate"))
    aggs = [F.nullif(F.count_if(F.col("y") == y), F.lit(0)).alias(f"n_{y}") for y in _YEARS] + [F.avg(F.when(F.col("y") == y, F.col("o_totalprice"))).alias(f"media_{y}") for y in _YEARS]
    step = P.UnpivotYears({"count": "count", "mean": "mean", "annual": "annual"}, "o_custkey", _YEARS)
    return run(o.groupBy("o_custkey").agg(*aggs), step).drop("is_estimated").withColumn("value", F.round("value", 4))


_REGROUP = {"ALGERIA": "AFRICA", "ETHIOPIA": "AFRICA", "KENYA": "AFRICA", "NATION_1": "G1", "NATION_2": "G1", "NATION_7": "G2", "NATION_8": "G2", "NATION_9": "G2"}


def _nation_stats(spark, d):
    c, n = t(spark, d, "customer"), t(spark, d, "nation")
    stats = c.groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("n"), F.avg("c_acctbal").alias("mean"), F.sum("c_acctbal").alias("total"))
    return n.join(stats, F.col("n_nationkey") == F.col("c_nationkey"), "left").select(F.when(F.col("n_nationkey") < 6, F.concat(F.lit("low"), (F.col("n_nationkey") % 2).cast("string"))).otherwise(F.col("n_name")).alias("grp"), F.col("n_nationkey").cast("bigint").alias("k"), F.coalesce("n", F.lit(0)).alias("n"), "mean", "total")


_NATIONS = "SELECT CASE WHEN n_nationkey < 6 THEN 'low' || CAST(n_nationkey % 2 AS VARCHAR) ELSE n_name END AS grp, CAST(n_nationkey AS BIGINT) AS k, count(c_custkey) AS n, avg(c_acctbal) AS mean, sum(c_acctbal) AS total FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey GROUP BY ALL"


@query(
    f"WITH s AS ({_NATIONS}), m AS (SELECT CASE WHEN grp = 'low0' THEN 'EVEN' ELSE 'ODD' END AS g, * FROM s WHERE grp LIKE 'low%') SELECT g AS grp, min(k) AS k, CAST(sum(n) AS BIGINT) AS n, round(sum(CASE WHEN mean IS NOT NULL AND n > 0 THEN mean * n END) / sum(CASE WHEN mean IS NOT NULL AND n > 0 THEN n END), 6) AS mean, round(coalesce(sum(total), 0), 4) AS total FROM m GROUP BY g UNION ALL SELECT grp, k, n, round(mean, 6), round(total, 4) FROM s WHERE grp NOT LIKE 'low%'"
)
def weighted_regroup(spark, d):
    step = P.WeightedRegroup("grp", {"low0": "EVEN", "low1": "ODD"}, ["n"], {"mean": "n"}, ["total"], order_by=["k"])
    return run(_nation_stats(spark, d), step).withColumns({"mean": F.round("mean", 6), "total": F.round("total", 4)})


@query("WITH a AS (SELECT o_orderstatus AS code, CASE WHEN o_orderkey % 4 = 0 THEN 0 ELSE o_orderkey END AS f1, o_custkey AS a1, o_orderkey % 10 AS f2, o_custkey % 10 AS a2 FROM orders WHERE o_orderstatus <> 'P') SELECT code, 'x' AS kind, 'ux' AS uri, CAST(sum(f1) AS BIGINT) AS freq, CAST(sum(a1) AS BIGINT) AS amount FROM a GROUP BY code UNION ALL SELECT code, 'y', 'uy', CAST(sum(f2) AS BIGINT), CAST(sum(a2) AS BIGINT) FROM a GROUP BY code")
def aggregate_unpivot(spark, d):
    o = t(spark, d, "orders")
    text = lambda c: c.cast("string")
    rows = o.select("o_orderstatus", F.when(nth("o_orderkey", 4) == 0, "").otherwise(text(F.col("o_orderkey"))).alias("f1"), text(F.col("o_custkey")).alias("a1"), text(nth("o_orderkey", 10)).alias("f2"), text(nth("o_custkey", 10)).alias("a2"))
    return run(rows, P.AggregateUnpivot("o_orderstatus", {"x": ("f1", "a1"), "y": ("f2", "a2")}, {"x": "ux", "y": "uy"}, sentinel="P"))


_RANGES = {"early": (1990, 1993), "middle": (1994, 1996), "late": (1997, 2005), "never": (9999, 9999)}
_BUCKET = "CASE WHEN y BETWEEN 1990 AND 1993 THEN 'early' WHEN y BETWEEN 1994 AND 1996 THEN 'middle' WHEN y BETWEEN 1997 AND 2005 THEN 'late' END"
_SHARES = f"SELECT b.bucket, CAST(count(o.bucket) AS DOUBLE) AS total, coalesce(round(count(o.bucket) / nullif((SELECT count(*) FROM (SELECT {_BUCKET} AS k FROM (SELECT year(o_orderdate) AS y FROM orders)) WHERE k IS NOT NULL), 0), 9), 0) AS share FROM (VALUES ('early'), ('middle'), ('late'), ('never')) b(bucket) LEFT JOIN (SELECT {_BUCKET} AS bucket FROM (SELECT year(o_orderdate) AS y FROM orders)) o ON b.bucket = o.bucket GROUP BY b.bucket"


def _composition(spark, d):
    o = t(spark, d, "orders").select(F.year("o_orderdate").alias("y"), F.lit(1).alias("n"))
    return P.bucket_share(o, "y", "n", _RANGES).withColumn("share", F.round("share", 9))


@query(_SHARES)
def bucket_share(spark, d):
    return _composition(spark, d)


@query(f"WITH c AS (SELECT c_nationkey, count(*) AS n FROM customer GROUP BY c_nationkey) SELECT c_nationkey, n, bucket AS regime_notation, round(n * share, 6) AS projected, 'E' AS _status FROM c CROSS JOIN ({_SHARES})")
def project_shares_long(spark, d):
    c = t(spark, d, "customer").groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("n"))
    return run(c, P.ProjectShares("n", _composition(spark, d))).withColumn("projected", F.round("projected", 6))


@query(f"WITH c AS (SELECT c_nationkey, count(*) AS n FROM customer GROUP BY c_nationkey), s AS ({_SHARES}) SELECT c_nationkey, n, {', '.join(f'''round(n * (SELECT share FROM s WHERE bucket = '{b}'), 6) AS projected_{b}''' for b in _RANGES)}, 'E' AS _status FROM c")
def project_shares_wide(spark, d):
    c = t(spark, d, "customer").groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("n"))
    got = run(c, P.ProjectShares("n", _composition(spark, d), shape="wide"))
    return got.withColumns({f"projected_{b}": F.round(f"projected_{b}", 6) for b in _RANGES})


@query("SELECT user_id % 7 AS bucket, " + ", ".join(f"round(avg(CASE WHEN event_type = '{e}' THEN value END), 6) AS \"{e}\"" for e in ("click", "purchase", "view")) + " FROM events GROUP BY 1")
def pivot_mean(spark, d):
    labels = ["click", "purchase", "view"]
    got = P.pivot_mean(t(spark, d, "events").withColumn("bucket", nth("user_id", 7)), ["bucket"], "event_type", "value", labels)
    return got.select("bucket", *[F.round(x, 6).alias(x) for x in labels])


@query("SELECT c_mktsegment, count(*) AS n FROM customer WHERE c_acctbal > 0 GROUP BY c_mktsegment HAVING count(*) > 1")
def having_count(spark, d):
    return t(spark, d, "customer").where("c_acctbal > 0").groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n")).where("n > 1")


@query("SELECT c_nationkey, count(DISTINCT c_mktsegment) AS kinds, string_agg(DISTINCT c_mktsegment, '; ' ORDER BY c_mktsegment) AS listed FROM customer GROUP BY c_nationkey")
def group_concat_distinct(spark, d):
    return t(spark, d, "customer").groupBy("c_nationkey").agg(F.count_distinct("c_mktsegment").alias("kinds"), F.array_join(F.array_sort(F.collect_set("c_mktsegment")), "; ").alias("listed"))


@query("SELECT column_name AS \"column\", round(ratio, 6) AS null_ratio FROM (VALUES ('l_orderkey', 0.0), ('l_linenumber', 0.0), ('x', (SELECT 1 - count(x) / count(*) FROM (" + _GAPS + ")))) v(column_name, ratio)")
def profile_nulls(spark, d):
    return null_ratios(_gaps(spark, d)).withColumn("null_ratio", F.round("null_ratio", 6))


# linking ------------------------------------------------------------------------------------


_PAIRS = "SELECT DISTINCT l_partkey, l_suppkey FROM lineitem"


@query(
    f"WITH n AS (SELECT *, count(*) OVER (PARTITION BY l_suppkey) AS k FROM ({_PAIRS})) SELECT 'P' || l_partkey AS code, 'http://ex/s' || l_suppkey AS uri FROM (SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY k, l_suppkey) AS r FROM n) WHERE r = 1"
)
def lookup_tiebreak(spark, d):
    """Codes of several owners go to the owner with the fewest; half come over sameAs, half over exactMatch."""
    pairs = t(spark, d, "lineitem").select("l_partkey", "l_suppkey").distinct()
    owner, code = F.concat(F.lit("http://ex/s"), F.col("l_suppkey").cast("string")), F.concat(F.lit(link.NUTS + "P"), F.col("l_partkey").cast("string"))
    iri, none = F.lit("iri").alias("o_kind"), F.lit(None).cast("string")
    same = pairs.where(nth("l_partkey", 2) == 0).select(owner.alias("s"), F.lit(link.OWL + "sameAs").alias("p"), code.alias("o"), iri, none.alias("lang"))
    match = pairs.where(nth("l_partkey", 2) == 1).select(code.alias("s"), F.lit(link.SKOS + "exactMatch").alias("p"), owner.alias("o"), iri, none.alias("lang"))
    dimension = pairs.select(owner.alias("uri"), F.lpad(F.col("l_suppkey").cast("string"), 9, "0").alias("istat")).distinct()
    return link.nuts_index(same.unionByName(match), dimension)


@query("SELECT n_nationkey, CASE WHEN n_nationkey % 3 = 2 THEN NULL ELSE n_name END AS matched, CASE n_nationkey % 3 WHEN 0 THEN 'direct' WHEN 1 THEN 'alias' END AS how FROM nation")
def cascade_match(spark, d):
    from ..operators.link import cascade

    n = t(spark, d, "nation")
    code = F.lpad(F.col("n_nationkey").cast("string"), 3, "0")
    dim = n.select(F.col("n_name").alias("label"), code.alias("istat"), F.col("n_name").alias("uri"))
    said = F.when(nth("n_nationkey", 3) == 0, F.concat(F.lit("  "), F.upper("n_name"), F.lit(" "))).when(nth("n_nationkey", 3) == 1, F.concat(F.lit("alias "), "n_nationkey")).otherwise(F.concat(F.lit("unheard of "), "n_nationkey"))
    rows = n.select("n_nationkey", province_key(said).alias("key"))
    aliases = {f"alias {k}": f"{k:03d}" for k in range(25)}
    found = cascade(rows.select("key").distinct(), dim, aliases, 95)
    return rows.join(found, "key").select("n_nationkey", F.col("uri").alias("matched"), "how")


_CUT = "substr(name, 1, 3) || substr(name, 5)"
# The longest common subsequence by rows of its table, one character of the key at a time.
_FUZZY = f"""
WITH RECURSIVE names AS (SELECT DISTINCT lower(p_name) AS name FROM part), keys AS (SELECT DISTINCT {_CUT} AS key FROM names),
pairs AS (SELECT key, name FROM keys, names WHERE 200.0 * least(length(key), length(name)) / (length(key) + length(name)) >= 90),
dp AS (
  SELECT key, name, 0 AS i, list_transform(range(length(name) + 1), lambda x: 0) AS row FROM pairs
  UNION ALL
  SELECT key, name, i + 1, list_transform(range(1, length(name) + 2), lambda j: list_max(list_transform(range(1, j + 1), lambda k: CASE WHEN k > 1 AND name[k - 1] = key[i + 1] THEN row[k - 1] + 1 ELSE row[k] END)))
  FROM dp WHERE i < length(key)),
scored AS (SELECT key, name, 200.0 * row[length(name) + 1] / (length(key) + length(name)) AS score FROM dp WHERE i = length(key))
SELECT key, name, round(score, 6) AS score FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY score DESC, name) AS r FROM scored WHERE score >= 90) WHERE r = 1"""


@query(_FUZZY)
def fuzzy_match(spark, d):
    names = t(spark, d, "part").select(F.lower("p_name").alias("name")).distinct()
    said = names.select(F.concat(F.substr("name", F.lit(1), F.lit(3)), F.substr("name", F.lit(5))).alias("key"))
    return best_matches(said, names, 90, "name").withColumn("score", F.round("score", 6))


@query(
    "WITH o AS (SELECT 'https://ex/sede-' || lower(replace(n_name, '_', '')) AS uri_sede, CASE WHEN n_nationkey = 7 THEN ['007', '011'] WHEN n_nationkey % 5 = 4 THEN [] ELSE [lpad(CAST(n_nationkey AS VARCHAR), 3, '0')] END AS codes FROM nation) SELECT DISTINCT uri_sede, unnest(codes) AS codice_istat FROM o"
)
def bridge_one_to_many(spark, d):
    """Offices by the names of nations; one has two provinces, those with a key of 4 modulo 5 none."""
    n = t(spark, d, "nation")
    dimension = n.where((nth("n_nationkey", 5) != 4)).select(F.concat(F.lit("http://ex/"), "n_name").alias("uri"), F.lpad(F.col("n_nationkey").cast("string"), 3, "0").alias("istat"), F.col("n_name").alias("label"))
    step = link.LinkOffice("sede", dimension, "https://ex/", {"nation_7": ["007", "011"]}, min_fuzzy_score=100)
    linked = step.apply(Dataset(n.select(F.concat(F.upper("n_name"), F.lit(" ")).alias("sede")))).data
    return step.bridge(linked)


# A hierarchy over all part keys, each with two lower ones, and a cycle.
_EDGES = "SELECT p_partkey AS a, p_partkey // 3 AS b FROM part UNION SELECT p_partkey, p_partkey // 5 FROM part UNION SELECT 0, 7 FROM part"


@query(f"WITH RECURSIVE e AS ({_EDGES}), r AS (SELECT a, b FROM e UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a) SELECT CAST(a AS BIGINT) AS a, CAST(b AS BIGINT) AS b FROM r")
def transitive_pairs(spark, d):
    k = t(spark, d, "part").select(F.col("p_partkey").cast("bigint").alias("k"))
    edges = [k.select(F.col("k").alias("a"), F.floor(F.col("k") / n).alias("b")) for n in (3, 5)]
    return transitive_closure(edges[0].unionByName(edges[1]).unionByName(k.select(F.lit(0).cast("bigint").alias("a"), F.lit(7).cast("bigint").alias("b"))))


# indices and reports ------------------------------------------------------------------------


_METRICS = "SELECT n_nationkey AS k, sum(c_acctbal) / count(*) AS m1, count(*) / 7.0 AS m2, 3.0 AS m3 FROM nation JOIN customer ON c_nationkey = n_nationkey GROUP BY n_nationkey"
_NORM = f"SELECT k, (m1 - min(m1) OVER ()) / (max(m1) OVER () - min(m1) OVER ()) AS n1, (m2 - min(m2) OVER ()) / (max(m2) OVER () - min(m2) OVER ()) AS n2, 0.5 AS n3, m1, m2, m3 FROM ({_METRICS})"


def _metrics(spark, d):
    c = t(spark, d, "customer").groupBy("c_nationkey").agg(F.sum("c_acctbal").alias("s"), F.count(F.lit(1)).alias("n"))
    return t(spark, d, "nation").join(c, F.col("n_nationkey") == F.col("c_nationkey")).select(F.col("n_nationkey").alias("k"), (F.col("s") / F.col("n")).alias("m1"), (F.col("n") / 7.0).cast("double").alias("m2"), F.lit(3.0).alias("m3"))


@query(f"SELECT k, round(n1, 6) AS m1_norm, round(n2, 6) AS m2_norm, round(n3, 6) AS m3_norm FROM ({_NORM})")
def minmax_index(spark, d):
    got = normalized(_metrics(spark, d), ["m1", "m2", "m3"])
    return got.select("k", *[F.round(f"{m}_norm", 6).cast("double").alias(f"{m}_norm") for m in ("m1", "m2", "m3")])


@query(
    f"WITH n AS ({_NORM}) SELECT k, 'm1' AS component, round(n1, 6) AS value, round(m1, 6) AS raw, 's1' AS sources FROM n UNION ALL SELECT k, 'm2', round(n2, 6), round(m2, 6), '' FROM n UNION ALL SELECT k, 'm3', round(n3, 6), round(m3, 6), 's3' FROM n UNION ALL SELECT k, 'aggregate', round((n1 + n2 + n3) / 3, 6), NULL, 's1,s3' FROM n"
)
def composite_index_long(spark, d):
    sources = {"m1": F.array(F.lit("s1")), "m3": F.array(F.lit("s3"), F.lit(None).cast("string"))}
    return composite_long(_metrics(spark, d), ["k"], ["m1", "m2", "m3"], sources).withColumn("sources", F.array_join("sources", ","))


_REVENUE = "SELECT n_nationkey AS istat, n_name AS label, round(sum(o_totalprice), 2) AS value FROM nation JOIN customer ON c_nationkey = n_nationkey JOIN orders ON o_custkey = c_custkey GROUP BY ALL"


def _revenue(spark, d):
    """Orders are summed by customer before they meet the nations: two small joins."""
    o = t(spark, d, "orders").groupBy("o_custkey").agg(F.sum("o_totalprice").alias("s"))
    c = t(spark, d, "customer").join(o, F.col("c_custkey") == F.col("o_custkey")).groupBy("c_nationkey").agg(F.round(F.sum("s"), 2).alias("value"))
    return t(spark, d, "nation").join(c, F.col("n_nationkey") == F.col("c_nationkey")).select(F.col("n_nationkey").alias("istat"), F.col("n_name").alias("label"), "value")


def _as_index(spark, d):
    r = _revenue(spark, d)
    return r.select("istat", F.lit("aggregate").alias("component"), "value", F.lit(None).cast("double").alias("raw")), r.select("istat", "label")


@query(f"SELECT * FROM ({_REVENUE}) ORDER BY value DESC, istat LIMIT 10")
def top_k(spark, d):
    return cube_queries.top_index(*_as_index(spark, d))


@query(f"SELECT * FROM ({_REVENUE}) ORDER BY value, istat LIMIT 10")
def bottom_k(spark, d):
    return cube_queries.top_index(*_as_index(spark, d), lowest=True)


@query("SELECT c_custkey, c_acctbal, row_number() OVER (ORDER BY c_acctbal DESC, c_custkey) AS rank FROM customer")
def rank_all(spark, d):
    return ranked(t(spark, d, "customer").select("c_custkey", "c_acctbal"), "c_acctbal", "c_custkey")


@query(
    "WITH q AS (SELECT quantile_cont(c_acctbal, [0.2, 0.4, 0.6, 0.8]) AS q FROM customer) SELECT c_custkey, CAST(CASE WHEN c_acctbal <= q[1] THEN 0 WHEN c_acctbal <= q[2] THEN 1 WHEN c_acctbal <= q[3] THEN 2 WHEN c_acctbal <= q[4] THEN 3 ELSE 4 END AS INTEGER) AS bucket, CASE WHEN c_acctbal <= q[1] THEN 'a' WHEN c_acctbal <= q[2] THEN 'b' WHEN c_acctbal <= q[3] THEN 'c' WHEN c_acctbal <= q[4] THEN 'd' ELSE 'e' END AS colour FROM customer, q"
)
def quintile_bucket(spark, d):
    return quintile_colours(t(spark, d, "customer").select("c_custkey", "c_acctbal"), "c_acctbal", list("abcde")).drop("c_acctbal")


@query("SELECT CAST(floor(p_size / 10) * 10 AS BIGINT) AS decade, round(sum(p_retailprice * p_size) / sum(p_size), 4) AS mean_age, CAST(sum(p_size) AS BIGINT) AS pensions FROM part GROUP BY 1")
def decade_weighted_mean(spark, d):
    return cube_queries.age_by_decade(t(spark, d, "part").select(F.col("p_size").alias("year"), F.col("p_retailprice").alias("age"), F.col("p_size").cast("bigint").alias("count")))


@query("SELECT c_custkey AS istat, round(c_acctbal + 65 - (SELECT sum(p_retailprice * p_size) / sum(p_size) FROM part), 4) AS years FROM customer")
def scalar_subquery_delta(spark, d):
    life = t(spark, d, "customer").select(F.col("c_custkey").alias("istat"), F.col("c_acctbal").alias("expectancy"))
    return cube_queries.expected_duration(life, t(spark, d, "part").select(F.col("p_retailprice").alias("age"), F.col("p_size").cast("bigint").alias("count")))


_SERIES = "SELECT c_mktsegment AS office, year(o_orderdate) AS y, count(*) AS n, avg(o_totalprice) AS mean FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL"


def _series(spark, d):
    o = t(spark, d, "orders").join(t(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    return o.groupBy(F.col("c_mktsegment").alias("office"), F.year("o_orderdate").alias("year")).agg(F.count(F.lit(1)).alias("count"), F.avg("o_totalprice").alias("mean"))


@query(f"WITH s AS ({_SERIES}) SELECT a.office, a.n AS before, b.n AS after, round((b.n - a.n) * 100.0 / a.n, 4) AS growth_pct FROM s a JOIN s b ON a.office = b.office AND a.y = 1995 AND b.y = 2000 WHERE a.office IN ('BUILDING', 'MACHINERY')")
def self_join_growth(spark, d):
    return cube_queries.growth(_series(spark, d), ["BUILDING", "MACHINERY"], 1995, 2000)


@query(f"WITH s AS ({_SERIES}) SELECT CAST(y AS INTEGER) AS year, CAST(sum(n) AS BIGINT) AS total, round(sum(n * mean) / sum(n), 1) AS mean FROM s GROUP BY y")
def national_series(spark, d):
    return cube_queries.national_series(_series(spark, d))


@query(
    "WITH b AS (SELECT l_suppkey AS office, CASE WHEN l_returnflag = 'R' THEN 'retributivo' ELSE 'other' END AS regime, count(*) AS n FROM lineitem GROUP BY ALL) SELECT r_name AS region, CAST(sum(CASE WHEN regime = 'retributivo' THEN n END) AS BIGINT) AS retributive, CAST(sum(n) AS BIGINT) AS total, round(sum(CASE WHEN regime = 'retributivo' THEN n END) / sum(n), 4) AS share FROM b JOIN supplier ON office = s_suppkey JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey WHERE s_suppkey % 10 <> 0 GROUP BY r_name"
)
def share_by_region(spark, d):
    regimes = t(spark, d, "lineitem").groupBy(F.col("l_suppkey").alias("office"), F.when(F.col("l_returnflag") == "R", "retributivo").otherwise("other").alias("regime")).agg(F.count(F.lit(1)).alias("count"))
    s = t(spark, d, "supplier").select(F.col("s_suppkey").alias("office"), F.col("s_nationkey").alias("istat"))
    bridge = s.unionByName(s.where(F.col("office") % 10 == 0).withColumn("istat", F.lit(0)))
    dim = t(spark, d, "nation").join(t(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("n_nationkey").alias("istat"), F.col("r_name").alias("region"))
    return cube_queries.retributive_share_by_region(regimes, bridge, dim)


@query(
    "WITH p AS (SELECT s_nationkey AS k, sum(s_acctbal) AS m FROM supplier GROUP BY 1), i AS (SELECT c_nationkey AS k, CAST(sum(c_acctbal) AS DOUBLE) AS income FROM customer GROUP BY 1) SELECT CAST(k AS VARCHAR) AS istat, round(m, 4) AS annual_millions, round(income, 4) AS income, round(m * 1e8 / income, 4) AS pct FROM p JOIN i USING (k) WHERE k IN (1, 2, 3, 5, 8)"
)
def cross_source_ratio(spark, d):
    p = t(spark, d, "supplier").groupBy(F.col("s_nationkey").cast("string").alias("istat")).agg(F.sum("s_acctbal").alias("annual_millions")).withColumn("management", F.lit("TOT"))
    i = t(spark, d, "customer").select(F.col("c_nationkey").cast("string").alias("istat"), F.col("c_acctbal").alias("amount"))
    got = cube_queries.pensions_by_income(p, i, ["1", "2", "3", "5", "8"])
    return got.withColumns({"annual_millions": F.round("annual_millions", 4), "income": F.round("income", 4)})


@query("SELECT o_orderstatus AS dataset, count(*) AS n FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY 1")
def estimated_by_cube(spark, d):
    o = t(spark, d, "orders").select(F.col("o_orderstatus").alias("dataset"), F.when(F.col("o_orderpriority") == "1-URGENT", "E").otherwise("A").alias("status"))
    return cube_queries.estimated_by_cube(o)


@query(
    "WITH m AS (SELECT s_suppkey AS office, array_sort(list_distinct(['IT' || chr(CAST(65 + s_nationkey % 12 AS INTEGER)) || '1'])) AS nuts FROM supplier) SELECT CAST(office AS VARCHAR) AS office, CASE WHEN office = 3 THEN 'Isole' ELSE CASE substr(nuts[1], 3, 1) WHEN 'C' THEN 'Nord-Ovest' WHEN 'D' THEN 'Nord-Est' WHEN 'H' THEN 'Nord-Est' WHEN 'E' THEN 'Centro' WHEN 'I' THEN 'Centro' WHEN 'F' THEN 'Sud' WHEN 'G' THEN 'Isole' ELSE 'Altro' END END AS macro FROM m"
)
def macro_areas(spark, d):
    from .vocabulary import MACRO_AREAS

    code = F.concat(F.lit("IT"), F.char(65 + nth("s_nationkey", 12)), F.lit("1"))
    rows = t(spark, d, "supplier").select(F.col("s_suppkey").cast("string").alias("office"), F.array(code).alias("nuts"))
    return cube_queries.macro_area(rows, MACRO_AREAS, {"3": "Isole"})


# triples ------------------------------------------------------------------------------------

_QB = "http://purl.org/linked-data/cube#"
_XSD = "http://www.w3.org/2001/XMLSchema#"
_TYPE = "http://www.w3.org/1999/02/22-rdf-syntax-ns#type"
_STATUS = "http://purl.org/linked-data/sdmx/2009/attribute#obsStatus"
_CODE = "http://purl.org/linked-data/sdmx/2009/code#obsStatus-"


def _emitter():
    return EmitObservations("ex:cube", "ex:dsd", "ex:obs-{o_orderkey}", {"o_orderkey": ("ex:key", _XSD + "integer"), "who": "ex:who"}, measures={"n": "ex:n", "price": "ex:price"}, metadata={"issued": "2026-01-01", "title": "Orders"})


def _orders_for_emit(spark, d):
    return t(spark, d, "orders").select("o_orderkey", F.when(nth("o_orderkey", 6) != 0, F.concat(F.lit("http://ex/"), F.col("o_custkey").cast("string"))).alias("who"), (F.col("o_custkey") - 50).alias("n"), F.when(nth("o_orderkey", 4) != 0, F.round("o_totalprice")).alias("price"))


_EMIT = f"""
WITH o AS (SELECT 'ex:obs-' || o_orderkey AS s, CAST(o_orderkey AS VARCHAR) AS k, 'http://ex/' || o_custkey AS who, o_custkey - 50 AS n, CASE WHEN o_orderkey % 4 <> 0 THEN CAST(round(o_totalprice) AS BIGINT) END AS price FROM orders WHERE o_orderkey % 6 <> 0)
SELECT s, '{_TYPE}' AS p, '{_QB}Observation' AS o, 'iri' AS o_kind, NULL AS datatype, NULL AS lang FROM o
UNION ALL SELECT s, '{_QB}dataSet', 'ex:cube', 'iri', NULL, NULL FROM o
UNION ALL SELECT s, 'ex:key', k, 'literal', '{_XSD}integer', NULL FROM o
UNION ALL SELECT s, 'ex:who', who, 'iri', NULL, NULL FROM o
UNION ALL SELECT s, 'ex:n', CAST(n AS VARCHAR), 'literal', CASE WHEN n >= 0 THEN '{_XSD}nonNegativeInteger' ELSE '{_XSD}integer' END, NULL FROM o
UNION ALL SELECT s, 'ex:price', CAST(price AS VARCHAR), 'literal', '{_XSD}nonNegativeInteger', NULL FROM o WHERE price IS NOT NULL
UNION ALL SELECT s, '{_STATUS}', '{_CODE}A', 'iri', NULL, NULL FROM o
UNION ALL SELECT 'ex:cube', '{_TYPE}', '{_QB}DataSet', 'iri', NULL, NULL
UNION ALL SELECT 'ex:cube', '{_QB}structure', 'ex:dsd', 'iri', NULL, NULL
UNION ALL SELECT 'ex:cube', 'http://purl.org/dc/terms/issued', '2026-01-01', 'literal', '{_XSD}date', NULL
UNION ALL SELECT 'ex:cube', 'http://purl.org/dc/terms/title', 'Orders', 'literal', NULL, 'it'"""


@query(_EMIT)
def observation_triples(spark, d):
    step = _emitter()
    step.apply(Dataset(_orders_for_emit(spark, d)))
    return step.triples


@query(f"SELECT count(*) AS triples, count(DISTINCT s) AS subjects FROM ({_EMIT})")
def triples_distinct_count(spark, d):
    return observation_triples(spark, d).agg(F.count(F.lit(1)).alias("triples"), F.count_distinct("s").alias("subjects"))


def nation_triples(spark, d) -> DataFrame:
    """Nations and regions as a graph: types, labels, keys, and which lies in which."""
    none = F.lit(None).cast("string")
    item = lambda p, o, kind, dt=None, lang=None: F.struct(F.lit(p).alias("p"), o.alias("o"), F.lit(kind).alias("o_kind"), (F.lit(dt) if dt else none).alias("datatype"), (F.lit(lang) if lang else none).alias("lang"))
    n = t(spark, d, "nation").select(F.concat(F.lit("http://ex/n"), F.col("n_nationkey").cast("string")).alias("s"), F.array(item(_TYPE, F.lit("http://ex/Nation"), "iri"), item("http://ex/label", F.col("n_name"), "literal", None, "en"), item("http://ex/key", F.col("n_nationkey").cast("string"), "literal", _XSD + "integer"), item("http://ex/in", F.concat(F.lit("http://ex/r"), F.col("n_regionkey").cast("string")), "iri")).alias("x"))
    r = t(spark, d, "region").select(F.concat(F.lit("http://ex/r"), F.col("r_regionkey").cast("string")).alias("s"), F.array(item(_TYPE, F.lit("http://ex/Region"), "iri"), item("http://ex/label", F.col("r_name"), "literal", None, "en"), item("http://ex/in", F.lit("http://ex/world"), "iri")).alias("x"))
    return n.unionByName(r).select("s", F.explode("x").alias("x")).select("s", "x.*")


@query("SELECT r_name AS region, CAST(count(*) AS VARCHAR) AS n, string_agg(n_name, '|' ORDER BY n_name) AS names FROM nation JOIN region ON n_regionkey = r_regionkey WHERE n_nationkey >= 3 GROUP BY r_name HAVING count(*) > 2")
def graph_query_group(spark, d):
    return Engine(nation_triples(spark, d)).query(
        """PREFIX ex: <http://ex/>
        SELECT ?region (COUNT(?n) AS ?n) (GROUP_CONCAT(DISTINCT ?name; SEPARATOR="|") AS ?names)
        WHERE { ?n a ex:Nation ; ex:label ?name ; ex:key ?k ; ex:in [ a ex:Region ; ex:label ?region ] . FILTER(?k >= 3) }
        GROUP BY ?region HAVING (COUNT(?n) > 2)"""
    )


@query("SELECT n_name AS name, CASE WHEN r_name LIKE 'A%' THEN r_name END AS region FROM nation JOIN region ON n_regionkey = r_regionkey WHERE n_nationkey NOT IN (2, 4) AND contains(lower(n_name), 'a')")
def graph_query_optional(spark, d):
    return Engine(nation_triples(spark, d)).query(
        """PREFIX ex: <http://ex/>
        SELECT ?name ?region WHERE {
          ?n a ex:Nation ; ex:label ?name .
          OPTIONAL { ?n ex:in ?r . ?r ex:label ?region . FILTER(STRSTARTS(STR(?region), "A")) }
          FILTER NOT EXISTS { VALUES ?k { 2 4 } ?n ex:key ?k }
          FILTER(LANG(?name) = "en" && CONTAINS(LCASE(?name), "a"))
        }"""
    )


@query("SELECT 'http://ex/n' || n_nationkey AS a, 'http://ex/r' || n_regionkey AS b FROM nation UNION ALL SELECT 'http://ex/n' || n_nationkey, 'http://ex/world' FROM nation UNION ALL SELECT 'http://ex/r' || r_regionkey, 'http://ex/world' FROM region")
def graph_query_path(spark, d):
    return Engine(nation_triples(spark, d)).query("PREFIX ex: <http://ex/> SELECT ?a ?b WHERE { ?a ex:in+ ?b }")


@query(
    "SELECT n_name AS name, 'nation' AS kind FROM nation WHERE n_nationkey = (SELECT max(n_nationkey) FROM nation) UNION ALL SELECT r_name, 'region' FROM region"
)
def graph_query_union(spark, d):
    return Engine(nation_triples(spark, d)).query(
        """PREFIX ex: <http://ex/>
        SELECT ?name ?kind WHERE {
          { { SELECT (MAX(?k) AS ?top) WHERE { ?x ex:key ?k } } ?n ex:key ?top ; ex:label ?name . BIND("nation" AS ?kind) }
          UNION { ?r a ex:Region ; ex:label ?name . BIND("region" AS ?kind) }
        }"""
    )


@query(
    "SELECT max(abs(parts - whole)) AS gap, max(abs(parts - whole)) <= 1 AS ok FROM (SELECT CAST(sum(CASE WHEN c_mktsegment <> 'BUILDING' OR c_nationkey = 3 THEN 1 ELSE 0 END) AS DOUBLE) AS parts, CAST(count(*) AS DOUBLE) AS whole FROM customer GROUP BY c_nationkey) UNION ALL SELECT 0.0, true"
)
def conservation_check(spark, d):
    """Parts that lack a segment in all nations but one, and parts that are whole."""
    c = t(spark, d, "customer")
    whole = c.groupBy("c_nationkey").agg(F.count(F.lit(1)).cast("double").alias("total"))
    cells = c.groupBy("c_nationkey", "c_mktsegment").agg(F.count(F.lit(1)).cast("double").alias("n"))
    lacking = cells.where((F.col("c_mktsegment") != "BUILDING") | (F.col("c_nationkey") == 3))
    got = [conservation(parts, whole, ["c_nationkey"], "n", "total") for parts in (lacking, cells)]
    return spark.createDataFrame([(float(x.actual), x.ok) for x in got], "gap double, ok boolean")


def flagship(spark: SparkSession, d: str) -> DataFrame:
    """Revenue by balance of each nation, normalized over all nations; the ten highest."""
    r = _revenue(spark, d)
    c = t(spark, d, "customer").groupBy("c_nationkey").agg(F.sum("c_acctbal").alias("balance"))
    ratio = r.join(c, F.col("istat") == F.col("c_nationkey")).select("istat", "label", F.try_divide("value", "balance").alias("ratio"))
    norm = normalized(ratio, ["ratio"])
    return norm.select("istat", "label", F.round("ratio", 4).alias("ratio"), F.round("ratio_norm", 6).alias("value")).orderBy(F.desc("value"), "istat").limit(10)


@query(
    f"WITH r AS (SELECT istat, label, value / balance AS ratio FROM ({_REVENUE}) JOIN (SELECT c_nationkey, sum(c_acctbal) AS balance FROM customer GROUP BY 1) ON istat = c_nationkey) SELECT istat, label, round(ratio, 4) AS ratio, round((ratio - (SELECT min(ratio) FROM r)) / (SELECT max(ratio) - min(ratio) FROM r), 6) AS value FROM r ORDER BY value DESC, istat LIMIT 10"
)
def revenue_ratio_index(spark, d):
    return flagship(spark, d)


from . import registry_cubes, registry_graphs, registry_joins, registry_lattice, registry_sources  # noqa: E402, F401  (they register their queries here)
