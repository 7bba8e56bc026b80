"""Registered queries: triples as text, by predicate, and table functions in SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import tables
from ..scratch import shared_dir
from ..sources import ntriples, turtle_sink
from ..sources.predicates import PredicateStore
from ..sources.turtle import n_triples, read_turtle
from .registry import nth, query, t

_NS = "http://example.org/"
_XSD = "http://www.w3.org/2001/XMLSchema#"


def customer_triples(spark, d):
    """A name with odd characters and a language, a nation, a balance, and for two of three a segment."""
    c = t(spark, d, "customer")
    own = F.concat(F.lit(f"{_NS}customer/"), F.col("c_custkey").cast("string"))
    none = F.lit(None).cast("string")

    def triple(p, o, kind, datatype=none, lang=none):
        return F.struct(own.alias("s"), F.lit(_NS + p).alias("p"), o.alias("o"), F.lit(kind).alias("o_kind"), datatype.alias("datatype"), lang.alias("lang"))

    name = F.concat(F.col("c_name"), F.lit(' "è" \\ \t\n😀 \r'))
    rows = [
        triple("name", name, "literal", lang=F.lit("it")),
        triple("nation", F.concat(F.lit(f"{_NS}nation/"), F.col("c_nationkey").cast("string")), "iri"),
        triple("balance", F.col("c_acctbal").cast("string"), "literal", datatype=F.lit(_XSD + "decimal")),
        F.when(nth("c_custkey", 3) != 0, triple("segment", F.col("c_mktsegment"), "literal", datatype=F.lit(_XSD + "string"))),
    ]
    return c.select(F.explode(F.array_compact(F.array(*rows))).alias("t")).select("t.*")


_NAME = "c_name || ' \"è\" \\ ' || chr(9) || chr(10) || '😀 ' || chr(13)"
_CUSTOMERS = (
    f"SELECT '{_NS}customer/' || c_custkey AS s, '{_NS}name' AS p, {_NAME} AS o, 'literal' AS o_kind, NULL AS datatype, 'it' AS lang FROM customer"
    f" UNION ALL SELECT '{_NS}customer/' || c_custkey, '{_NS}nation', '{_NS}nation/' || c_nationkey, 'iri', NULL, NULL FROM customer"
    f" UNION ALL SELECT '{_NS}customer/' || c_custkey, '{_NS}balance', CAST(c_acctbal AS VARCHAR), 'literal', '{_XSD}decimal', NULL FROM customer"
    f" UNION ALL SELECT '{_NS}customer/' || c_custkey, '{_NS}segment', c_mktsegment, 'literal', '{_XSD}string', NULL FROM customer WHERE c_custkey % 3 <> 0"
)


@query(_CUSTOMERS)
def ntriples_source(spark, d):
    """Written as N-Triples and read back line by line, whatever is in the literals."""
    place = f"{shared_dir(spark, 'io')}/customers.nt"
    n_triples(customer_triples(spark, d)).write.text(place)
    return ntriples.read_ntriples(spark, place)


@query(f"SELECT *, CASE WHEN p = '{_NS}nation' THEN NULL ELSE p || '/graph' END AS graph FROM ({_CUSTOMERS})")
def quads_source(spark, d):
    place = f"{shared_dir(spark, 'io')}/customers.nq"
    quads = customer_triples(spark, d).withColumn("graph", F.when(F.col("p") != _NS + "nation", F.concat("p", F.lit("/graph"))))
    ntriples.write_quads(quads.unionByName(quads), place)
    return ntriples.read_quads(spark, place)


@query(_CUSTOMERS)
def turtle_sink_round_trip(spark, d):
    """Written as Turtle, one document a range of subjects, and parsed again."""
    place = f"{shared_dir(spark, 'io')}/customers"
    turtle_sink.write_turtle(customer_triples(spark, d), place, {"c": f"{_NS}customer/", "ex": _NS})
    return read_turtle(spark, place, one_document=True)


@query(f"SELECT '{_NS}customer/' || c_custkey AS subject, {_NAME} AS name, '{_NS}nation/' || c_nationkey AS nation, CAST(c_acctbal AS VARCHAR) AS balance, CASE WHEN c_custkey % 3 <> 0 THEN c_mktsegment END AS segment FROM customer")
def predicate_star(spark, d):
    """Four patterns about one subject, the last optional, joined bucket by bucket."""
    store = PredicateStore.build(customer_triples(spark, d), f"{shared_dir(spark, 'store')}/customers", buckets=8)
    patterns = {n: _NS + n for n in ("name", "nation", "balance", "segment")}
    return store.decoded(store.star(patterns, optional=["segment"]), "subject", *patterns)


@query(_CUSTOMERS)
def predicate_store_round_trip(spark, d):
    built = PredicateStore.build(customer_triples(spark, d), f"{shared_dir(spark, 'store')}/all", buckets=4)
    return PredicateStore.open(spark, built.path).triples()


_WIDE = "SELECT l_orderkey, sum(CASE WHEN l_returnflag = '{0}' THEN l_quantity END) AS n, max(CASE WHEN l_returnflag = '{0}' THEN l_extendedprice END) AS m, '{0}' AS flag FROM lineitem GROUP BY l_orderkey"


@query(" UNION ALL ".join(f"SELECT l_orderkey, flag, n, m FROM ({_WIDE.format(f)})" for f in "ANR"))
def sql_paired_unpivot(spark, d):
    """The unpivot as a table function; its schema follows from its arguments."""
    tables.register(spark)
    cells = [c for f in "ANR" for c in (F.sum(F.when(F.col("l_returnflag") == f, F.col("l_quantity"))).alias(f"n_{f}"), F.max(F.when(F.col("l_returnflag") == f, F.col("l_extendedprice"))).alias(f"m_{f}"))]
    wide = t(spark, d, "lineitem").groupBy("l_orderkey").agg(*cells)
    return spark.sql("""SELECT * FROM paired_unpivot(TABLE({wide}), 'l_orderkey', 'flag', '{{"A": {{"n": "n_A", "m": "m_A"}}, "N": {{"n": "n_N", "m": "m_N"}}, "R": {{"n": "n_R", "m": "m_R"}}}}')""", wide=wide)


@query(_CUSTOMERS)
def sql_turtle_triples(spark, d):
    """Each customer's triples as a small Turtle document, parsed by a table function."""
    tables.register(spark)
    triples = customer_triples(spark, d)
    documents = n_triples(triples, "s").groupBy("s").agg(F.array_join(F.collect_list("value"), "\n").alias("text"))  # four lines at most
    return spark.sql("SELECT s, p, o, o_kind, datatype, lang FROM turtle_triples(TABLE({documents}), 's', 'text')", documents=documents)


@query(
    "SELECT user_id, event_type, min(ts) AS first, max(ts) AS last, count(*) AS n FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_type) - row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts) AS island FROM events)"
    " GROUP BY user_id, event_type, island"
)
def sql_value_runs(spark, d):
    """A table function that asks for its input by key and in order."""
    tables.register(spark)
    return spark.sql("SELECT * FROM value_runs(TABLE({events}), 'user_id', 'ts', 'event_type')", events=t(spark, d, "events"))
