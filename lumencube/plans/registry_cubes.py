"""Registered queries: linking, recipes, demonstration queries and checks through the library's own steps."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..core import Dataset, Pipeline
from ..functions.text import last_segment
from ..operators import columns as C
from ..operators import link
from ..operators.index import index_components
from ..operators.observations import PROV, QB, EmitObservations
from ..operators.reshape import INCOME_COLUMNS
from ..operators.rows import FilterRows
from ..scratch import shared_dir
from ..sources import sinks
from ..sources.turtle import read_turtle
from . import cube_queries, quality
from .examples import CustomersRecipe, EnrichmentRecipe, MunicipalitiesRecipe, ProvincesRecipe
from .profile import profile
from .recipes import IN_FORCE_COLUMNS, REGIME_COLUMNS, YEARS_COLUMNS, CompositeIndex, Demography, Employment, Incomes, PensionsByResidence, ProjectedPublicRegimes, PublicStartYears, RegimeByOffice, SeriesByOffice, public_counts
from .registry import _CODE, _STATUS, _TYPE, _XSD, Engine, nation_triples, nth, query, run, t

_EX = "https://example.org/cubes/"
_ISTAT = "lpad(CAST(n_nationkey AS VARCHAR), 3, '0')"
_ACRONYM = "chr(CAST(65 + n_nationkey // 5 AS INTEGER)) || chr(CAST(65 + n_nationkey % 5 AS INTEGER))"


def _istat(c: str = "n_nationkey") -> Column:
    return F.lpad(F.col(c).cast("string"), 3, "0")


def _acronym(c: str = "n_nationkey") -> Column:
    return F.concat(F.char(65 + F.floor(F.col(c) / 5)), F.char(65 + nth(c, 5)))


def _dimension(spark, d) -> DataFrame:
    """Nations as provinces."""
    n = t(spark, d, "nation")
    return n.select(F.concat(F.lit(link.PROVINCES), _istat()).alias("uri"), _istat().alias("istat"), _acronym().alias("acronym"), F.col("n_name").alias("label"), F.col("n_regionkey").cast("string").alias("region"))


def _territory(spark, d) -> DataFrame:
    """The vocabulary's triples of the same provinces: types, labels in two languages, codes, NUTS; the first has two."""
    n = t(spark, d, "nation")
    none = F.lit(None).cast("string")

    def item(p: str, o: Column, kind: str = "literal", lang: Column = none) -> Column:
        return F.struct(F.lit(p).alias("p"), o.alias("o"), F.lit(kind).alias("o_kind"), none.alias("datatype"), lang.alias("lang"))

    items = [
        item(link.RDF_TYPE, F.lit(link.CLV + "Province"), "iri"),
        item(link.SKOS + "prefLabel", F.col("n_name"), lang=F.lit("it")),
        item(link.SKOS + "prefLabel", F.concat(F.lit("A "), "n_name"), lang=F.lit("en")),
        item(link.SKOS + "notation", _istat()),
        item(link.CLV + "acronym", _acronym()),
        item(link.CLV + "situatedWithin", F.col("n_regionkey").cast("string"), "iri"),
        item(link.OWL + "sameAs", F.concat(F.lit(link.NUTS + "IT"), F.col("n_nationkey").cast("string")), "iri"),
        F.when(F.col("n_nationkey") == 0, item(link.OWL + "sameAs", F.lit(link.NUTS + "ITX"), "iri")),
    ]
    rows = n.select(F.concat(F.lit(link.PROVINCES), _istat()).alias("s"), F.explode(F.filter(F.array(*items), lambda x: x.isNotNull())).alias("x"))
    return rows.select("s", "x.*")


_PROV = f"'{link.PROVINCES}' || {_ISTAT}"


@query(f"SELECT {_PROV} AS uri, {_ISTAT} AS istat, {_ACRONYM} AS acronym, n_name AS label, CAST(n_regionkey AS VARCHAR) AS region, CASE WHEN n_nationkey = 0 THEN 'IT0,ITX' ELSE 'IT' || n_nationkey END AS nuts FROM nation")
def territory_dimension(spark, d):
    return link.dimension_from_triples(_territory(spark, d)).withColumn("nuts", F.array_join("nuts", ","))


_LINKED = f"CASE WHEN n_nationkey IS NOT NULL THEN {_PROV} END AS uri_agid, n_name AS label_agid, CASE WHEN n_nationkey IS NOT NULL THEN {_ISTAT} END AS codice_istat, CASE WHEN n_nationkey IS NOT NULL THEN {_ACRONYM} END AS sigla"


@query(f"SELECT c_custkey, {_LINKED} FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey AND c_custkey % 9 <> 0")
def link_by_nuts(spark, d):
    dim = link.dimension_from_triples(_territory(spark, d))
    code = F.when(nth("c_custkey", 9) != 0, F.concat(F.lit("IT"), F.col("c_nationkey").cast("string"))).otherwise("none")
    return run(t(spark, d, "customer").select("c_custkey", code.alias("area")), link.LinkProvinceByNUTS("area", dim, _territory(spark, d)), C.DropColumns(["area"]))


@query(f"SELECT s_suppkey, {_LINKED} FROM supplier LEFT JOIN nation ON n_nationkey = s_nationkey AND s_suppkey % 4 <> 1")
def link_by_acronym(spark, d):
    said = F.when(nth("s_suppkey", 4) == 0, F.lower(_acronym("s_nationkey"))).when(nth("s_suppkey", 4) != 1, _acronym("s_nationkey"))
    return run(t(spark, d, "supplier").select("s_suppkey", said.alias("code")), link.LinkProvinceByAcronym("code", _dimension(spark, d)), C.DropColumns(["code"]))


@query(f"SELECT s_suppkey, {_LINKED} FROM supplier LEFT JOIN nation ON n_nationkey = CASE WHEN s_suppkey % 6 = 5 THEN NULL WHEN s_suppkey % 6 = 4 THEN 2 ELSE s_nationkey END")
def link_by_name(spark, d):
    rows = t(spark, d, "supplier").join(t(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    said = F.when(nth("s_suppkey", 6) == 5, F.concat(F.lit("unheard of "), "n_name")).when(nth("s_suppkey", 6) == 4, F.lit("The Second")).otherwise(F.concat(F.lit(" "), F.upper("n_name")))
    step = link.LinkProvinceByName("place", _dimension(spark, d), {"the second": "002"}, 95)
    return run(rows.select("s_suppkey", said.alias("place")), step, C.DropColumns(["place"]))


@query(
    f"SELECT n_name AS sede, 'https://ex/sede-' || lower(replace(n_name, '_', '')) AS uri_sede, lower(replace(n_name, '_', '')) AS slug_sede, CASE WHEN n_nationkey <> 7 AND n_nationkey % 5 <> 4 THEN {_ISTAT} END AS correspondsto_codice_istat, CASE WHEN n_nationkey = 7 THEN '007,011' END AS aggregates_codici_istat, CASE WHEN n_nationkey % 5 <> 4 THEN {_PROV} END AS uri_provincia_principale FROM nation"
)
def link_offices(spark, d):
    n = t(spark, d, "nation")
    step = link.LinkOffice("sede", _dimension(spark, d).where(F.col("istat").cast("int") % 5 != 4), "https://ex/", {"nation_7": ["007", "011"]}, min_fuzzy_score=100)
    return step.apply(Dataset(n.select(F.col("n_name").alias("sede")))).data


_OFFICES = f"SELECT 'https://ex/sede-' || lower(replace(n_name, '_', '')) AS s, n_name, upper(lower(replace(n_name, '_', ''))) AS slug, CASE WHEN n_nationkey = 7 THEN ['007', '011'] ELSE [{_ISTAT}] END AS codes FROM nation WHERE n_nationkey % 5 <> 4"


@query(
    f"WITH o AS ({_OFFICES}) SELECT s, '{_TYPE}' AS p, 'https://v/Office' AS o, 'iri' AS o_kind, NULL AS lang FROM o UNION ALL SELECT s, '{link.SKOS}prefLabel', n_name, 'literal', 'it' FROM o UNION ALL SELECT s, '{link.SKOS}notation', CASE WHEN len(codes) > 1 THEN 'INPS-CA-SU' ELSE 'INPS-' || substr(slug, 1, 8) END, 'literal', NULL FROM o UNION ALL SELECT s, 'https://v/' || CASE WHEN len(codes) > 1 THEN 'aggregatesProvince' ELSE 'correspondsToProvince' END, '{link.PROVINCES}' || unnest(codes), 'iri', NULL FROM o"
)
def office_sidecar(spark, d):
    n = t(spark, d, "nation")
    step = link.LinkOffice("sede", _dimension(spark, d).where(F.col("istat").cast("int") % 5 != 4), "https://ex/", {"nation_7": ["007", "011"]}, min_fuzzy_score=100)
    return step.sidecar(step.apply(Dataset(n.select(F.col("n_name").alias("sede")))).data, "https://v/").drop("datatype")


@query(f"SELECT {_PROV} AS s, '{link.OWL}sameAs' AS p, CASE WHEN n_nationkey = 6 THEN 'http://db/other' ELSE 'http://db/' || n_nationkey END AS o FROM nation WHERE n_nationkey % 4 <> 3")
def reconcile_sidecar(spark, d):
    """Labels with prefixes, and one that says 'and' for 'e'; an override comes first; a quarter has no resource."""
    n = t(spark, d, "nation")
    name = F.when(F.col("n_nationkey") == 5, F.lit("Alpha e Omega")).otherwise(F.col("n_name"))
    label = F.when(F.col("n_nationkey") == 5, F.lit("Province of Alpha and Omega")).when(nth("n_nationkey", 2) == 0, F.concat(F.lit("Provincia di "), "n_name")).otherwise(F.upper("n_name"))
    rows = n.where(nth("n_nationkey", 4) != 3).select(F.concat(F.lit("http://db/"), F.col("n_nationkey").cast("string")).alias("resource"), F.when(nth("n_nationkey", 2) == 0, label).alias("label_it"), F.when(nth("n_nationkey", 2) != 0, label).alias("label_en"))
    found, _ = link.reconcile_labels(rows, n.select(_istat().alias("istat"), name.alias("label")), {"006": "http://db/other"})
    return link.same_as_sidecar(found).select("s", "p", "o")


@query("SELECT 'http://ex/n' || n_nationkey AS uri, 'n' || n_nationkey AS last FROM nation")
def uri_last_segment(spark, d):
    return t(spark, d, "nation").select(F.concat(F.lit("http://ex/n"), F.col("n_nationkey").cast("string")).alias("uri")).withColumn("last", last_segment(F.col("uri")))


# recipes ------------------------------------------------------------------------------------


@query(
    f"SELECT REF_AREA, anno, occupati, {_LINKED}, CASE WHEN n_nationkey IS NOT NULL THEN '{_EX}obs-occupati-' || {_ISTAT} || '-2025' END AS _obs_uri FROM (SELECT 'IT' || c_nationkey AS REF_AREA, '2025' AS anno, c_nationkey, CASE WHEN c_nationkey % 6 = 0 THEN NULL ELSE round(sum(c_acctbal), 2) END AS occupati FROM customer GROUP BY c_nationkey UNION ALL SELECT 'ITF', '2025', NULL, 1.5) LEFT JOIN nation ON n_nationkey = c_nationkey"
)
def recipe_employment(spark, d):
    sums = t(spark, d, "customer").groupBy("c_nationkey").agg(F.round(F.sum("c_acctbal"), 2).cast("string").alias("x"))
    rows = sums.select(F.concat(F.lit("IT"), F.col("c_nationkey").cast("string")).alias("REF_AREA"), F.lit("2025").alias("TIME_PERIOD"), F.when(nth("c_nationkey", 6) == 0, "n/a").otherwise(F.col("x")).alias("Osservazione"))
    rows = rows.unionByName(spark.range(1).select(F.lit("ITF").alias("REF_AREA"), F.lit("2025").alias("TIME_PERIOD"), F.lit("1.5").alias("Osservazione")))
    dim = link.dimension_from_triples(_territory(spark, d))
    return Employment(dimension=dim, triples=_territory(spark, d)).apply(Dataset(rows)).data


@query(
    f"SELECT c_nationkey AS k, indicatore, '{_EX}' || concept AS indicatore_uri, unita, valore, '{_EX}obs-demo-' || {_ISTAT} || '-2026-' || indicatore AS _obs_uri FROM (SELECT c_nationkey, CASE WHEN c_nationkey % 2 = 0 THEN 'MEANAGEP' ELSE 'POP65OVER' END AS indicatore, CASE WHEN c_nationkey % 2 = 0 THEN 'ind-meanagep' ELSE 'ind-pop65over' END AS concept, CASE WHEN c_nationkey % 2 = 0 THEN 'anni' ELSE '%' END AS unita, CAST(count(*) AS DOUBLE) AS valore FROM customer GROUP BY c_nationkey) JOIN nation ON n_nationkey = c_nationkey"
)
def recipe_demography(spark, d):
    sums = t(spark, d, "customer").groupBy("c_nationkey").agg(F.count(F.lit(1)).cast("string").alias("Osservazione"))
    rows = sums.select(F.col("c_nationkey").alias("k"), F.concat(F.lit("IT"), F.col("c_nationkey").cast("string")).alias("REF_AREA"), F.lit("2026").alias("TIME_PERIOD"), F.when(nth("c_nationkey", 2) == 0, "MEANAGEP").otherwise("POP65OVER").alias("DATA_TYPE"), "Osservazione")
    dim = link.dimension_from_triples(_territory(spark, d))
    got = Demography(dimension=dim, triples=_territory(spark, d)).apply(Dataset(rows)).data
    return got.select("k", "indicatore", "indicatore_uri", "unita", "valore", "_obs_uri")


_INCOMES = "SELECT k, kind, CAST(sum(freq) AS BIGINT) AS freq, CAST(sum(amount) AS BIGINT) AS amount FROM (SELECT c_nationkey AS k, CAST(floor(c_acctbal) AS BIGINT) AS amount, CASE WHEN c_custkey % 7 = 0 THEN 0 ELSE 1 END AS freq, unnest(['v2', 'v4', 'v5', 'v6', 'v7']) AS kind FROM customer) GROUP BY ALL"


@query(f"SELECT {_ACRONYM} AS code, kind, freq, amount, {_ISTAT} AS codice_istat, '{_EX}obs-redditi-' || {_ISTAT} || '-2024-' || kind AS _obs_uri FROM ({_INCOMES}) JOIN nation ON n_nationkey = k")
def recipe_incomes(spark, d):
    c = t(spark, d, "customer")
    freq = F.when(nth("c_custkey", 7) == 0, "n/a").otherwise("1")
    cells = [x for f, a in INCOME_COLUMNS.values() for x in (freq.alias(f), F.floor("c_acctbal").cast("string").alias(a))]
    rows = c.select(_acronym("c_nationkey").alias("Sigla Provincia"), *cells)
    rows = rows.unionByName(rows.limit(1).withColumn("Sigla Provincia", F.lit("0")))
    got = Incomes(dimension=_dimension(spark, d)).apply(Dataset(rows)).data
    return got.select("code", "kind", "freq", "amount", "codice_istat", "_obs_uri")


@query(
    f"SELECT {_ISTAT} AS codice_istat, gestione, CAST(n AS BIGINT) AS numero, round(m, 2) AS medio, '{_EX}obs-vigenti-' || {_ISTAT} || '-2026-' || gestione AS _obs_uri FROM (SELECT c_nationkey, ['PRIV', 'PUB', 'AUTO', 'ASS', 'TOT'][g] AS gestione, count(*) * g AS n, CAST(count(*) AS DOUBLE) / 4 AS m FROM customer, range(1, 6) r(g) GROUP BY c_nationkey, g) JOIN nation ON n_nationkey = c_nationkey"
)
def recipe_pensions(spark, d):
    n = t(spark, d, "customer").groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("n"))
    rows = n.join(t(spark, d, "nation"), F.col("n_nationkey") == F.col("c_nationkey"))
    numbers = [F.replace(v.cast("string"), F.lit("."), F.lit(",")) for g in range(1, 6) for v in (F.col("n") * g, F.col("n") / 4, F.col("n") / 8)]
    table = rows.select(F.col("n_name").alias("provincia"), F.lit("").alias("blank"), *[x.alias(c) for x, c in zip(numbers, IN_FORCE_COLUMNS[2:], strict=True)])
    got = PensionsByResidence(dimension=_dimension(spark, d)).apply(Dataset(table)).data
    return got.select("codice_istat", "gestione", "numero", F.round("medio", 2).alias("medio"), "_obs_uri")


@query(
    f"WITH b AS (SELECT c_nationkey AS k, count(*) AS n, CAST(count(*) AS DOUBLE) / 4 AS m FROM customer GROUP BY 1), r AS (SELECT k, unnest(['RETR', 'DINI', 'FORNERO', 'CONTR']) AS regime, n, m FROM b), v AS (SELECT k, regime, 'numeroPensioni' AS misura, CAST(n AS DOUBLE) AS value, 'A' AS st, 0 AS derived FROM r UNION ALL SELECT k, regime, 'importoMedioMensile', m, 'A', 0 FROM r UNION ALL SELECT k, regime, 'importoAnnuoComplessivo', n * m * 13, 'E', 2 FROM r) SELECT {_ISTAT} AS istat, regime, misura, round(value, 2) AS value, '{_CODE}' || st AS status, CAST(derived AS INTEGER) AS derived, '{_EX}obs-regime-' || lower(replace(n_name, '_', '')) || '-2026-' || regime || '-' || misura AS _obs_uri FROM v JOIN nation ON n_nationkey = k"
)
def recipe_regimes(spark, d):
    n = t(spark, d, "customer").groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("n"))
    rows = n.join(t(spark, d, "nation"), F.col("n_nationkey") == F.col("c_nationkey"))
    numbers = [F.replace(v.cast("string"), F.lit("."), F.lit(",")) for _ in range(5) for v in (F.col("n"), F.col("n") / 4)]
    table = rows.select(F.col("n_name").alias("sede"), F.lit("").alias("blank"), *[x.alias(c) for x, c in zip(numbers, REGIME_COLUMNS[2:], strict=True)])
    got = RegimeByOffice(dimension=_dimension(spark, d)).apply(Dataset(table)).data
    return got.select(F.col("correspondsto_codice_istat").alias("istat"), "regime", "misura", F.round("value", 2).alias("value"), "status", F.size("derived").alias("derived"), "_obs_uri")


@query(
    f"SELECT CAST(1980 + p_size AS INTEGER) AS anno_decorrenza, count(*) AS numero_pensioni, '{_CODE}' || CASE WHEN p_size = 0 THEN 'E' ELSE 'A' END AS status, '{_EX}obs-decorrenza-' || (1980 + p_size) AS _obs_uri FROM (SELECT p_size % 40 AS p_size FROM part) GROUP BY p_size"
)
def recipe_start_years(spark, d):
    rows = t(spark, d, "part").groupBy((1980 + nth("p_size", 40)).cast("int").alias("anno_decorrenza")).agg(F.count(F.lit(1)).alias("numero_pensioni"), F.avg("p_retailprice").alias("importo_medio"), F.avg("p_size").alias("eta_decorrenza"))
    return PublicStartYears().apply(Dataset(rows)).data.select("anno_decorrenza", "numero_pensioni", "status", "_obs_uri")


_COMPONENTS = "WITH p AS (SELECT c_nationkey AS k, count(*) AS n, sum(c_acctbal) AS m FROM customer GROUP BY 1), s AS (SELECT s_nationkey AS k, count(*) AS o, sum(s_acctbal) AS b FROM supplier GROUP BY 1) SELECT {i} AS istat, n / (o * 1000.0) AS d1, m * 1e6 / b AS d2, (o + n) / (n * 3.0) AS d3, o FROM p JOIN s USING (k) JOIN nation ON n_nationkey = k".format(i=_ISTAT)


def _components(spark, d):
    c = t(spark, d, "customer").groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("n"), F.sum("c_acctbal").alias("m"))
    p = c.select(_istat("c_nationkey").alias("istat"), F.col("n").alias("total_count"), F.col("m").alias("total_millions"), *[F.col("n").alias(x) for x in ("private", "public", "self_employed")])
    s = t(spark, d, "supplier").select(_istat("s_nationkey").alias("istat"), F.col("s_suppkey").cast("string").alias("slug"), F.col("s_acctbal").alias("amount"), F.lit(1).alias("count"))
    work = s.groupBy("istat").agg(F.count(F.lit(1)).cast("double").alias("thousands"))
    plan = p.select("istat", F.col("total_count").alias("count"))
    return index_components(p, work, s, s, plan)


@query(f"SELECT istat, round(d1, 6) AS d1, round(d2, 2) AS d2, round(d3, 6) AS d3, CAST(o AS INTEGER) AS offices FROM ({_COMPONENTS})")
def index_components_joined(spark, d):
    return _components(spark, d).select("istat", F.round("d1", 6).alias("d1"), F.round("d2", 2).alias("d2"), F.round("d3", 6).alias("d3"), F.size("office_slugs").alias("offices"))


@query(
    f"SELECT istat, component, '{_EX}obs-index-' || istat || '-2026-' || component AS _obs_uri, CAST(CASE component WHEN 'd1' THEN 2 WHEN 'd2' THEN 6 WHEN 'd3' THEN 4 + o ELSE 3 END AS INTEGER) AS n_sources, CASE component WHEN 'aggregate' THEN '{_EX}obs-index-' || istat || '-2026-d1' ELSE '{_EX}obs-vigenti-' || istat || CASE component WHEN 'd3' THEN '-2026-PRIV' ELSE '-2026-TOT' END END AS first FROM (SELECT *, unnest(['d1', 'd2', 'd3', 'aggregate']) AS component FROM ({_COMPONENTS}))"
)
def recipe_index(spark, d):
    """The composite index with the observations that each value was made from."""
    got = CompositeIndex(components=_components(spark, d)).make().data
    return got.select("istat", "component", "_obs_uri", F.size("sources").alias("n_sources"), F.get("sources", F.lit(0)).alias("first"))


@query("SELECT c_custkey AS c_cust_key, c_name, age FROM (SELECT c_custkey, trim(c_name) AS c_name, CASE WHEN c_custkey % 3 = 0 THEN (SELECT median(c_nationkey) FILTER (WHERE c_custkey % 3 <> 0) FROM customer) ELSE CAST(c_nationkey AS DOUBLE) END AS age FROM customer)")
def recipe_customers(spark, d):
    rows = t(spark, d, "customer").select(F.col("c_custkey").alias("C CustKey"), F.concat(F.lit(" "), "c_name", F.lit("  ")).alias("c-name"), F.when(nth("c_custkey", 3) != 0, F.col("c_nationkey").cast("double")).alias("Age"), F.lit(None).cast("string").alias("nothing"))
    return CustomersRecipe().apply(Dataset(rows.unionByName(rows))).data


def _towns(spark, d) -> Dataset:
    c = t(spark, d, "customer")
    end = F.when(nth("c_custkey", 5) == 0, "1999-12-31").when(nth("c_custkey", 5) == 1, "9999-12-31")
    rows = c.select(F.col("c_custkey").alias("municipality_id"), F.concat(F.lit("Town "), (F.floor(F.col("c_custkey") / 2)).cast("string")).alias("name"), F.col("c_nationkey").cast("string").alias("province"), end.alias("end_date"))
    return MunicipalitiesRecipe().apply(Dataset(rows.unionByName(rows)))


_TOWNS = "SELECT DISTINCT 'town ' || c_custkey // 2 AS name_key, CAST(c_nationkey AS VARCHAR) AS province FROM customer WHERE c_custkey % 5 <> 0"


@query(f"SELECT name_key, province FROM ({_TOWNS})")
def recipe_municipalities(spark, d):
    return _towns(spark, d).data.select("name_key", "province")


@query("SELECT n_nationkey AS nation_key, n_name AS province_name, lower(n_name) AS province_key FROM nation")
def recipe_provinces(spark, d):
    rows = t(spark, d, "nation").select(F.col("n_nationkey").alias("Nation Key"), F.col("n_name").alias("Den Prov"))
    return ProvincesRecipe({"den_prov": "province_name"}).apply(Dataset(rows)).data


@query(f"SELECT o_orderkey, CAST(floor(o_totalprice) AS DOUBLE) AS waste, CASE WHEN w.name_key IS NOT NULL THEN true ELSE false END AS found FROM orders JOIN customer ON o_custkey = c_custkey LEFT JOIN ({_TOWNS}) w ON w.name_key = 'town ' || c_custkey // 2 AND w.province = CAST(c_nationkey AS VARCHAR)")
def recipe_enrichment(spark, d):
    o = t(spark, d, "orders").join(t(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    o = o.join(t(spark, d, "nation"), F.col("n_nationkey") == F.col("c_nationkey"))
    rows = o.select("o_orderkey", F.concat(F.floor("o_totalprice").cast("string"), F.lit(",0")).alias("waste"), F.concat(F.lit("TOWN  "), (F.floor(F.col("c_custkey") / 2)).cast("string")).alias("comune"), F.col("n_name").alias("provincia"))
    provinces = t(spark, d, "nation").select(F.lower("n_name").alias("province_key"), F.col("n_nationkey").cast("string").alias("acronym"))
    got = EnrichmentRecipe(Dataset(provinces), _towns(spark, d)).apply(Dataset(rows)).data
    return got.select("o_orderkey", "waste", F.col("municipality_id").isNotNull().alias("found"))


# demonstration queries ----------------------------------------------------------------------


@query(f"WITH n AS (SELECT istat, unnest([{{'c': 'd1', 'v': d1}}, {{'c': 'd2', 'v': d2}}, {{'c': 'd3', 'v': d3}}]) AS x FROM ({_COMPONENTS})), s AS (SELECT istat, x.c AS component, (x.v - min(x.v) OVER (PARTITION BY x.c)) / (max(x.v) OVER (PARTITION BY x.c) - min(x.v) OVER (PARTITION BY x.c)) AS value, x.v AS raw FROM n) SELECT component, round(value, 5) AS value, round(raw, 2) AS raw FROM s WHERE istat = '004' UNION ALL SELECT 'aggregate', round(avg(value), 5), NULL FROM s WHERE istat = '004'")
def index_breakdown(spark, d):
    got = cube_queries.breakdown(CompositeIndex(components=_components(spark, d)).long(), "004")
    return got.select("component", F.round("value", 5).alias("value"), F.round("raw", 2).alias("raw"))


@query("SELECT n_name AS label, c_mktsegment AS management, count(*) AS count, round(avg(c_acctbal), 4) AS mean FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE n_regionkey = 2 AND c_mktsegment <> 'BUILDING' GROUP BY ALL")
def managements_by_region(spark, d):
    seg = F.when(F.col("c_mktsegment") == "BUILDING", "TOT").otherwise(F.col("c_mktsegment"))
    p = t(spark, d, "customer").groupBy(_istat("c_nationkey").alias("istat"), seg.alias("management")).agg(F.count(F.lit(1)).alias("count"), F.round(F.avg("c_acctbal"), 4).alias("mean"))
    return cube_queries.managements_by_region(p, _dimension(spark, d), "2")


@query(
    f"WITH n AS (SELECT istat, unnest([{{'c': 'd1', 'v': d1}}, {{'c': 'd2', 'v': d2}}, {{'c': 'd3', 'v': d3}}]) AS x FROM ({_COMPONENTS})), s AS (SELECT istat, x.c AS component, (x.v - min(x.v) OVER (PARTITION BY x.c)) / (max(x.v) OVER (PARTITION BY x.c) - min(x.v) OVER (PARTITION BY x.c)) AS value, x.v AS raw FROM n) SELECT component AS kind, round(raw, 2) AS value FROM s WHERE istat = '004' UNION ALL SELECT 'index', round(avg(value), 2) FROM s WHERE istat = '004' UNION ALL SELECT 'pensions', CAST(count(*) AS DOUBLE) FROM customer WHERE c_nationkey = 4 UNION ALL SELECT 'employed', CAST(count(*) AS DOUBLE) FROM supplier WHERE s_nationkey = 4 UNION ALL SELECT 'income', round(sum(s_acctbal), 2) FROM supplier WHERE s_nationkey = 4"
)
def identity_card(spark, d):
    index = CompositeIndex(components=_components(spark, d)).long()
    p = t(spark, d, "customer").groupBy(_istat("c_nationkey").alias("istat")).agg(F.count(F.lit(1)).alias("count")).withColumn("management", F.lit("TOT"))
    s = t(spark, d, "supplier").select(_istat("s_nationkey").alias("istat"), F.col("s_acctbal").alias("amount"))
    work = s.groupBy("istat").agg(F.count(F.lit(1)).cast("double").alias("thousands"))
    return cube_queries.identity_card("004", index, p, work, s).withColumn("value", F.round("value", 2))


@query("SELECT r_name AS region, n_name AS name FROM nation JOIN region ON n_regionkey = r_regionkey ORDER BY r_name DESC, n_name LIMIT 7 OFFSET 3")
def graph_query_order(spark, d):
    """Two sort keys, seen through the limit and offset."""
    return Engine(nation_triples(spark, d)).query(
        """PREFIX ex: <http://ex/>
        SELECT ?region ?name WHERE { ?n a ex:Nation ; ex:label ?name ; ex:in ?r . ?r ex:label ?region }
        ORDER BY DESC(?region) ?name LIMIT 7 OFFSET 3"""
    )


# observations and checks --------------------------------------------------------------------

_STYLE_B = f"""
WITH o AS (SELECT 'ex:obs-' || s_suppkey || '-' || m AS s, s_suppkey AS k, m, CASE m WHEN 'n' THEN CAST(s_nationkey AS VARCHAR) ELSE CAST(s_acctbal AS VARCHAR) END AS v, m = 'x' AS made FROM supplier, (SELECT unnest(['n', 'x']) AS m))
SELECT s, '{QB}measureType' AS p, 'http://ex/' || m AS o FROM o UNION ALL SELECT s, 'http://ex/' || m, CASE WHEN regexp_matches(v, '^[0-9]+\\.0$') THEN replace(v, '.0', '') ELSE v END FROM o
UNION ALL SELECT s, '{_STATUS}', '{_CODE}' || CASE WHEN made THEN 'E' ELSE 'A' END FROM o
UNION ALL SELECT s, '{PROV}wasDerivedFrom', unnest(['ex:obs-' || k || '-n', 'ex:src']) FROM o WHERE made
UNION ALL SELECT s, 'http://ex/unit', 'EUR' FROM o WHERE made
UNION ALL SELECT s, 'http://ex/key', CAST(k AS VARCHAR) FROM o"""


@query(_STYLE_B)
def observations_by_measure(spark, d):
    """One measure a row, with status, provenance and an attribute."""
    s = t(spark, d, "supplier")
    key = F.col("s_suppkey").cast("string")
    n = s.select("s_suppkey", F.lit("n").alias("m"), F.col("s_nationkey").cast("double").alias("v"), F.lit(None).cast("string").alias("st"), F.array().cast("array<string>").alias("src"), F.lit(None).cast("string").alias("unit"))
    x = s.select("s_suppkey", F.lit("x").alias("m"), F.col("s_acctbal").alias("v"), F.lit(_CODE + "E").alias("st"), F.array(F.concat(F.lit("ex:obs-"), key, F.lit("-n")), F.lit("ex:src")).alias("src"), F.lit("EUR").alias("unit"))
    rows = n.unionByName(x).withColumn("kind", F.concat(F.lit("http://ex/"), "m"))
    step = EmitObservations("ex:cube", "ex:dsd", "ex:obs-{s_suppkey}-{m}", {"s_suppkey": ("http://ex/key", _XSD + "integer")}, measure_type_column="kind", value_column="v", status_column="st", provenance_column="src", attributes={"unit": "http://ex/unit"})
    got = step.apply(Dataset(rows)).data
    return step.observations(got).where(~F.col("p").isin(_TYPE, QB + "dataSet")).select("s", "p", "o")


def _outcomes(spark, checks) -> DataFrame:
    return spark.createDataFrame([(c.name, None if c.actual is None else str(c.actual), c.ok) for c in checks], "name string, actual string, ok boolean")


@query(
    f"SELECT 'orders: dataset and structure' AS name, '1' AS actual, true AS ok UNION ALL SELECT 'orders: observations', CAST(count(*) AS VARCHAR), false FROM orders WHERE o_orderkey % 6 <> 0 UNION ALL SELECT 'orders: observations without ex:key', '0', true UNION ALL SELECT 'orders: observations without ex:none', CAST(count(*) AS VARCHAR), false FROM orders WHERE o_orderkey % 6 <> 0 UNION ALL SELECT 'orders: observations without status', '0', true UNION ALL SELECT 'orders: observations with under 2 measures', CAST(count(*) AS VARCHAR), false FROM orders WHERE o_orderkey % 6 <> 0 AND o_orderkey % 4 = 0 UNION ALL SELECT 'absent: present', NULL, NULL"
)
def check_cube(spark, d):
    from .registry import observation_triples

    triples = observation_triples(spark, d)
    spec = quality.CubeSpec("orders", "ex:cube", "ex:dsd", 1, ("ex:key", "ex:none"), ("ex:n", "ex:price"), 2, lambda: triples)
    return _outcomes(spark, [*quality.check_cube(spec), *quality.check_cube(quality.CubeSpec("absent", "ex:a", "ex:b", 1, (), ("ex:n",)))])


@query("SELECT 'provinces' AS name, '25' AS actual, true AS ok UNION ALL SELECT 'acronyms not of 2 letters', '0', true UNION ALL SELECT 'NUTS links', '26', true UNION ALL SELECT 'provinces with several NUTS', '1', false")
def check_territory(spark, d):
    return _outcomes(spark, quality.check_territory(link.dimension_from_triples(_territory(spark, d)), 25, 26, 2))


@query(
    "SELECT 'http://ex/Nation count' AS name, CAST(count(*) AS VARCHAR) AS actual, true AS ok FROM nation UNION ALL SELECT 'http://ex/Region count', CAST(count(*) AS VARCHAR), true FROM region UNION ALL SELECT 'http://ex/None count', '0', false UNION ALL SELECT * FROM (VALUES ('structures without http://purl.org/linked-data/cube#dimension', '0', true), ('structures without http://purl.org/linked-data/cube#measure', '1', false), ('coded dimensions without a code list', '1', false), ('measures without a concept', '1', false))"
)
def check_vocabularies(spark, d):
    rows = [("d1", _TYPE, QB + "DataStructureDefinition"), ("d1", QB + "component", "c1"), ("d1", QB + "component", "c2"), ("c1", QB + "dimension", "x"), ("c2", QB + "measure", "y"), ("d2", _TYPE, QB + "DataStructureDefinition"), ("d2", QB + "component", "c3"), ("c3", QB + "dimension", "x")]
    for name, coded in (("x", True), ("z", False)):
        rows += [(name, _TYPE, QB + "DimensionProperty"), (name, quality.RDFS + "range", quality.SKOS + "Concept")] + ([(name, QB + "codeList", "l")] if coded else [])
    rows += [("y", _TYPE, QB + "MeasureProperty"), ("y", QB + "concept", "k"), ("w", _TYPE, QB + "MeasureProperty")]
    own = spark.createDataFrame([(*r, "iri", None, None) for r in rows], "s string, p string, o string, o_kind string, datatype string, lang string")
    return _outcomes(spark, quality.check_vocabularies(nation_triples(spark, d).unionByName(own), {"http://ex/Nation": 25}, {"http://ex/Region": 1, "http://ex/None": 1}))


@query("SELECT 'package: http://ex/label' AS name, '1' AS actual, true AS ok UNION ALL SELECT 'package: http://ex/in', '1', false UNION ALL SELECT 'package: http://ex/none', '0', true")
def check_package(spark, d):
    return _outcomes(spark, quality.check_package(nation_triples(spark, d), "http://ex/n3", {"http://ex/label": 1, "http://ex/in": 2, "http://ex/none": 0}))


@query("SELECT (SELECT 2 * count(*) FROM customer) AS rows, 5 AS columns, 'Odd Name' AS odd, 'void' AS empty, round((SELECT avg(CASE WHEN c_custkey % 4 <> 0 THEN 1.0 ELSE 0.0 END) FROM customer), 6) AS share, (SELECT count(*) FROM customer) AS again")
def profile_report(spark, d):
    """Names, empty and sparse columns and repeated rows of a table that is there twice."""
    c = t(spark, d, "customer")
    rows = c.select("c_custkey", "c_acctbal", F.col("c_name").alias("Odd Name"), F.lit(None).cast("int").alias("void"), F.when(nth("c_custkey", 4) == 0, F.lit(1.0)).when(nth("c_custkey", 4) == 1, F.lit(float("nan"))).alias("sparse"))
    r = profile(Dataset(rows.unionByName(rows)))
    return spark.createDataFrame([(r.rows, r.columns, ",".join(r.non_snake_case), ",".join(r.empty_columns), round(r.high_null_columns["sparse"], 6), r.duplicate_rows)], "rows long, columns int, odd string, empty string, share double, again long")


_SERIES = (
    "WITH b AS (SELECT c_nationkey AS k, y, CASE WHEN y % 10 <> 0 THEN count(*) + y - 1998 END AS n, CASE WHEN y % 10 <> 0 AND y % 7 <> 0 THEN count(*) / 4.0 END AS m FROM customer, range(1998, 2027) r(y) GROUP BY c_nationkey, y),"
    " v AS (SELECT k, y, 'numeroPensioni' AS misura, CAST(n AS DOUBLE) AS value, 'A' AS st, 0 AS derived FROM b WHERE n IS NOT NULL OR m IS NOT NULL UNION ALL SELECT k, y, 'importoMedioMensile', m, 'A', 0 FROM b WHERE n IS NOT NULL OR m IS NOT NULL"
    " UNION ALL SELECT k, y, 'importoAnnuoComplessivo', n * m * 13, 'E', 2 FROM b WHERE n IS NOT NULL OR m IS NOT NULL)"
)


@query(
    f"{_SERIES} SELECT {_ISTAT} AS istat, CAST(y AS INTEGER) AS anno, misura, round(value, 2) AS value, '{_CODE}' || st AS status, CAST(derived AS INTEGER) AS derived, '{_EX}obs-serie-' || lower(replace(n_name, '_', '')) || '-' || y || '-' || misura AS _obs_uri FROM v JOIN nation ON n_nationkey = k"
)
def recipe_series(spark, d):
    """Cube 3: years with neither number nor mean are left out; a missing mean leaves the annual amount missing."""
    n = t(spark, d, "customer").groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("n"))
    rows = n.join(t(spark, d, "nation"), F.col("n_nationkey") == F.col("c_nationkey"))
    said = lambda c, missing: F.lit("- ") if missing else F.replace(c.cast("string"), F.lit("."), F.lit(","))
    cells = [x for y in range(1998, 2027) for x in (said(F.col("n") + (y - 1998), y % 10 == 0), said(F.col("n") / 4, y % 10 == 0 or y % 7 == 0))]
    table = rows.select(F.col("n_name").alias("sede"), F.lit("").alias("blank"), *[x.alias(c) for x, c in zip(cells, YEARS_COLUMNS[2:], strict=True)])
    got = SeriesByOffice(dimension=_dimension(spark, d)).apply(Dataset(table)).data
    return got.select(F.col("correspondsto_codice_istat").alias("istat"), "anno", "misura", F.round("value", 2).alias("value"), "status", F.size("derived").alias("derived"), "_obs_uri")


_SHARES = "SELECT count(*) FILTER (WHERE y <= 1995) / CAST(count(*) AS DOUBLE) AS retributivo, count(*) FILTER (WHERE y BETWEEN 1996 AND 2011) / CAST(count(*) AS DOUBLE) AS dini, count(*) FILTER (WHERE y BETWEEN 2012 AND 2025) / CAST(count(*) AS DOUBLE) AS fornero FROM (SELECT 1980 + p_partkey % 46 AS y FROM part)"


@query(
    f"SELECT {_ISTAT} AS codice_istat, r[1] AS regime_notation, round(n * CAST(r[2] AS DOUBLE), 4) AS projected, '{_CODE}E' AS status, '{_EX}obs-planb-' || {_ISTAT} || '-2026-' || r[1] AS _obs_uri, '{_EX}obs-vigenti-' || {_ISTAT} || '-2026-PUB' AS derived"
    f" FROM (SELECT c_nationkey AS k, count(*) AS n FROM customer GROUP BY 1), (SELECT unnest([['retributivo', CAST(retributivo AS VARCHAR)], ['misto-dini', CAST(dini AS VARCHAR)], ['misto-fornero', CAST(fornero AS VARCHAR)], ['contributivo-puro', '0']]) AS r FROM ({_SHARES})) JOIN nation ON n_nationkey = k"
)
def recipe_projected(spark, d):
    """Cube 9, from the public pensions of cube 1 read back and the composition of a start-years export."""
    n = t(spark, d, "part").groupBy((1980 + nth("p_partkey", 46)).alias("y")).agg(F.count(F.lit(1)).cast("string").alias("n"))
    place = f"{shared_dir(spark, 'io')}/years"
    n.select(F.concat(F.lit('"'), F.col("y").cast("string"), F.lit('";"";"'), "n", F.lit(' ";"40,5 ";"1,0 ";"1,0 ";"80,0 "')).alias("value")).write.text(place)
    one = t(spark, d, "customer").groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("numero"))
    rows = one.join(t(spark, d, "nation"), F.col("n_nationkey") == F.col("c_nationkey"))
    cube1 = rows.select(F.concat(F.lit(link.PROVINCES), _istat()).alias("uri_agid"), F.lit("PUB").alias("gestione"), "numero")
    cube1 = cube1.unionByName(cube1.withColumn("gestione", F.lit("TOT"))).unionByName(cube1.withColumn("uri_agid", F.lit(None).cast("string")))
    done = ProjectedPublicRegimes(spark=spark, start_years_path=place).apply(Dataset(public_counts(cube1))).data
    return done.select("codice_istat", "regime_notation", F.round("projected", 4).alias("projected"), "status", "_obs_uri", F.get("derived", F.lit(0)).alias("derived"))


@query(
    f"SELECT '{link.PROVINCES}' || {_ISTAT} AS s, '{link.SKOS}altLabel' AS p, n_name || ' (res.)' AS o, 'literal' AS o_kind, NULL AS datatype, 'it-x-inps' AS lang FROM nation WHERE n_nationkey % 5 <> 4"
    f" UNION ALL SELECT 'https://v/offices-to-provinces', '{_TYPE}', 'http://purl.org/dc/terms/Standard', 'iri', NULL, NULL UNION ALL SELECT 'https://v/offices-to-provinces', 'http://purl.org/dc/terms/title', 'Offices and provinces', 'literal', NULL, 'en'"
    f" UNION ALL SELECT 'https://v/offices-to-provinces', 'http://purl.org/dc/terms/source', '{link.OFFICE_SOURCE}', 'iri', NULL, NULL UNION ALL SELECT 'https://v/offices-to-provinces', 'http://purl.org/dc/terms/license', '{link.CC_BY}', 'iri', NULL, NULL"
)
def office_sidecar_header(spark, d):
    """What the sidecar of offices says of provinces' names and of itself, written as Turtle and read back."""
    n = t(spark, d, "nation")
    labels = n.where(nth("n_nationkey", 5) != 4).select(_istat().alias("istat"), F.concat("n_name", F.lit(" (res.)")).alias("label"))
    place = f"{shared_dir(spark, 'io')}/sidecar"
    step = link.LinkOffice("sede", _dimension(spark, d), "https://v/", min_fuzzy_score=100, sidecar_to=place, labels=labels)
    step.apply(Dataset(n.select(F.col("n_name").alias("sede"))))
    got = read_turtle(spark, place, one_document=True)
    return got.where((F.col("p") == link.SKOS + "altLabel") | ((F.col("s") == "https://v/offices-to-provinces") & ~F.col("p").endswith("description")))


@query(
    "SELECT p, CASE WHEN p = 'http://purl.org/dc/terms/description' THEN '(' || (SELECT count(*) FROM nation WHERE n_nationkey % 4 <> 3) || ' links)' ELSE o END AS o, lang FROM (VALUES"
    f" ('{_TYPE}', 'http://purl.org/dc/terms/Standard', NULL), ('http://purl.org/dc/terms/title', 'Provinces and external resources', 'en'), ('http://purl.org/dc/terms/description', '', 'en'),"
    f" ('http://purl.org/dc/terms/source', '{link.LABEL_SOURCE}', NULL), ('http://purl.org/dc/terms/license', '{link.CC_BY}', NULL), ('http://purl.org/dc/terms/created', '2026-01-31', NULL)) x(p, o, lang)"
)
def reconcile_sidecar_header(spark, d):
    n = t(spark, d, "nation")
    rows = n.where(nth("n_nationkey", 4) != 3).select(F.concat(F.lit("http://db/"), F.col("n_nationkey").cast("string")).alias("resource"), F.col("n_name").alias("label_it"), F.lit(None).cast("string").alias("label_en"))
    found, _ = link.reconcile_labels(rows, n.select(_istat().alias("istat"), F.col("n_name").alias("label")), {})
    got = link.same_as_sidecar(found, header_uri="http://ex/sidecar", created="2026-01-31").where("s = 'http://ex/sidecar'")
    many = F.concat(F.lit("("), F.regexp_extract("o", "^([0-9]+ links)", 1), F.lit(")"))
    return got.select("p", F.when(F.col("p").endswith("description"), many).otherwise(F.col("o")).alias("o"), "lang")


@query("SELECT n_regionkey AS region, count(*) AS n FROM nation GROUP BY 1")
def graph_query_json(spark, d):
    """The JSON result of a graph query, as rows again."""
    engine = Engine.stored(nation_triples(spark, d))
    told = engine.to_json_result("SELECT ?r (COUNT(?n) AS ?c) WHERE { ?n a <http://ex/Nation> ; <http://ex/in> ?r } GROUP BY ?r")
    rows = spark.createDataFrame([(json.dumps(r),) for r in told["rows"]], "row string")  # a row for each region
    parsed = rows.select(F.from_json("row", "r string, c string").alias("x"))
    return parsed.select(F.regexp_extract("x.r", "([0-9]+)$", 1).cast(t(spark, d, "nation").schema["n_regionkey"].dataType).alias("region"), F.col("x.c").cast("bigint").alias("n"))


@query("SELECT step, metric, CAST(value AS BIGINT) AS value FROM (SELECT 'FilterRows' AS step, unnest(['rows_before', 'rows_after', 'rows_removed']) AS metric, unnest([(SELECT count(*) FROM orders), (SELECT count(*) FROM orders WHERE o_orderkey % 3 = 0), (SELECT count(*) FROM orders WHERE o_orderkey % 3 <> 0)]) AS value) UNION ALL SELECT 'file', 'rows', count(*) FROM orders WHERE o_orderkey % 3 = 0")
def history_sidecar(spark, d):
    """The history beside a saved dataset, whose metrics come from the job that writes it."""
    place = f"{shared_dir(spark, 'io')}/orders.parquet"
    done = Pipeline([FilterRows(lambda x: nth("o_orderkey", 3) == 0)], on_error="raise", observed=True).run(Dataset(t(spark, d, "orders")))
    sinks.save_dataset(done, place, save_history=True)
    schema = "rows bigint, steps array<struct<name: string, metrics: map<string, bigint>>>"
    told = spark.read.text(place.replace(".parquet", ".history.json"), wholetext=True).select(F.from_json("value", schema).alias("x"))
    steps = told.select(F.explode("x.steps").alias("s")).select(F.col("s.name").alias("step"), F.explode("s.metrics").alias("metric", "value"))
    return steps.unionByName(told.select(F.lit("file").alias("step"), F.lit("rows").alias("metric"), F.col("x.rows").alias("value")))
