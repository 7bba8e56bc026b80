"""Linking names and codes to the territory dimension.

The dimension is a DataFrame: uri, istat, acronym, label, region, and nuts array<string>.
``dimension_from_triples`` makes it from the territory vocabulary.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..core import Dataset, Measured, PipelineStep, need
from ..functions.fuzzy import best_matches
from ..functions.text import last_segment, province_key, slugify
from ..sources.turtle import XSD
from .closure import reachable
from .columns import LISTED

CLV = "https://w3id.org/italia/onto/CLV/"
SKOS = "http://www.w3.org/2004/02/skos/core#"
OWL = "http://www.w3.org/2002/07/owl#"
RDF_TYPE = "http://www.w3.org/1999/02/22-rdf-syntax-ns#type"
NUTS = "http://nuts.geovocab.org/id/"
PROVINCES = "https://w3id.org/italia/controlled-vocabulary/territorial-classifications/provinces/"

DCT = "http://purl.org/dc/terms/"
CC_BY = "https://creativecommons.org/licenses/by/4.0/"
# Where the names of offices and the external labels come from.
OFFICE_SOURCE = "https://www.inps.it/osservatorio"
LABEL_SOURCE = "https://dbpedia.org/sparql"
OUTPUTS = {"uri": "uri_agid", "label": "label_agid", "istat": "codice_istat", "acronym": "sigla"}

# Spellings of province names (normalized) and the codes they mean.
ALIASES = {
    "aosta": "007",
    "barletta-andria-trani": "110",
    "forli'-cesena": "040",
    "forli-cesena": "040",
    "massa-carrara": "045",
    "provincia autonoma di bolzano/bozen": "021",
    "bolzano/bozen": "021",
    "bolzano": "021",
    "provincia autonoma di trento": "022",
    "trento": "022",
    "reggio calabria": "080",
    "reggio emilia": "035",
    "verbano-cusio-ossola": "103",
    "verbania": "103",
    "forli": "040",
    "pesaro-urbino": "041",
}
# Offices that serve several provinces.
OFFICES = {"cagliari e sud sardegna": ["092", "111"]}
# What external labels put in front of a province's name.
PREFIXES = (
    "provincia di ",
    "province of ",
    "metropolitan city of ",
    "citta metropolitana di ",
    "free municipal consortium of ",
    "consorzio comunale libero di ",
    "libero consorzio comunale di ",
    "regional decentralization entity of ",
)


def dimension_from_triples(triples: DataFrame) -> DataFrame:
    """One row for each province of the vocabulary, from one aggregation over its triples."""
    want = {SKOS + "prefLabel": "label", SKOS + "notation": "istat", CLV + "acronym": "acronym", CLV + "situatedWithin": "region"}
    is_label = (F.col("p") != SKOS + "prefLabel") | (F.col("lang") == "it")
    picks = [F.min(F.when((F.col("p") == p) & is_label, F.col("o"))).alias(n) for p, n in want.items()]
    nuts = F.array_sort(F.collect_set(F.when((F.col("p") == OWL + "sameAs") & F.col("o").startswith(NUTS), F.col("o"))))
    kind = F.max((F.col("p") == RDF_TYPE) & (F.col("o") == CLV + "Province")).alias("__is")
    rows = triples.groupBy(F.col("s").alias("uri")).agg(kind, *picks, F.transform(nuts, last_segment).alias("nuts"))
    return rows.where(F.col("__is") & F.col("istat").isNotNull() & F.col("acronym").isNotNull() & F.col("label").isNotNull()).drop("__is")


def nuts_index(triples: DataFrame, dimension: DataFrame) -> DataFrame:
    """(code, uri): each NUTS code and the province it stands for.

    Candidates come over sameAs paths and inverse exactMatch; "" and "-" are no codes. A code of
    several provinces goes to the one with the fewest codes, then the lowest istat code, then uri.
    """
    same = triples.where((F.col("p") == OWL + "sameAs") & (F.col("o_kind") == "iri")).select(F.col("s").alias("a"), F.col("o").alias("b"))
    ours = dimension.select("uri", "istat")
    reached = reachable(same, ours.select(F.col("uri").alias("start"))).where(F.col("node").startswith(NUTS))  # from the provinces alone
    over = reached.join(ours, F.col("start") == F.col("uri")).select("uri", "istat", last_segment(F.col("node")).alias("code"))
    match = triples.where(F.col("p") == SKOS + "exactMatch").join(ours, F.col("o") == F.col("uri")).select("uri", "istat", last_segment(F.col("s")).alias("code"))
    found = over.unionByName(match).where(~F.col("code").isin("", "-")).distinct()
    found = found.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("uri")))
    best = F.row_number().over(Window.partitionBy("code").orderBy("n", "istat", "uri"))
    return found.withColumn("k", best).where(F.col("k") == 1).select("code", "uri")


class _Lookup(PipelineStep):
    """Adds the dimension's columns for a key; rows without a match get nulls."""

    def __init__(self, source: str, dimension: DataFrame, output_columns: Mapping[str, str] | None = None):
        super().__init__()
        self.source, self.dimension = source, dimension
        self.outputs = {**OUTPUTS, **(output_columns or {})}

    def attach(self, dataset: Dataset, key: Column, index: DataFrame) -> Dataset:
        """``index`` has __key and the dimension's columns."""
        d = dataset.data
        need(d, [self.source])
        kept = [d[c] for c in d.columns if c not in self.outputs.values()]
        out = d.join(index, key == index["__key"], "left").select(*kept, *[index[c].alias(n) for c, n in self.outputs.items()])
        lost = out.where(F.col(self.outputs["uri"]).isNull())
        counted = Measured(dataset)
        out = counted.on(out, n=F.count(F.lit(1)), hit=F.count(out[self.outputs["uri"]]))

        def say(m):
            codes = lost.select(F.col(self.source).cast("string").alias("c")).distinct()
            listed = [str(x.c) for x in codes.orderBy("c").limit(LISTED + 1).collect()] if m["hit"] < m["n"] else []
            return {"matched": m["hit"], "unmatched": m["n"] - m["hit"], "unmatched_codes": listed[:LISTED], "n_unmatched_codes": len(listed) if len(listed) <= LISTED else codes.count()}

        return self.done(dataset, out, {"source": self.source}, counted.metrics(out, say))


class LinkProvinceByNUTS(_Lookup):
    def __init__(self, nuts_column: str, dimension: DataFrame, triples: DataFrame, output_columns: Mapping[str, str] | None = None):
        super().__init__(nuts_column, dimension, output_columns)
        self.triples = triples

    def apply(self, dataset: Dataset) -> Dataset:
        index = nuts_index(self.triples, self.dimension).withColumnRenamed("code", "__key").join(self.dimension, "uri")
        return self.attach(dataset, dataset.data[self.source], index)


class LinkProvinceByAcronym(_Lookup):
    def __init__(self, acronym_column: str, dimension: DataFrame, output_columns: Mapping[str, str] | None = None, case_insensitive: bool = True):
        super().__init__(acronym_column, dimension, output_columns)
        self.fold = F.upper if case_insensitive else (lambda c: c)

    def apply(self, dataset: Dataset) -> Dataset:
        need(dataset.data, [self.source])
        return self.attach(dataset, self.fold(dataset.data[self.source]), self.dimension.withColumn("__key", self.fold(F.col("acronym"))))


def cascade(keys: DataFrame, dimension: DataFrame, aliases: Mapping[str, str], min_score: float) -> DataFrame:
    """(key, uri, how) for distinct normalized keys: direct, then alias, then fuzzy.

    An alias whose code the dimension lacks goes on to fuzzy. Only the keys left over are compared
    with the names, where they share a part; the best score wins, then the lowest istat code.
    """
    names = dimension.select(province_key(F.col("label")).alias("name"), "istat", "uri")
    one = Window.partitionBy("name").orderBy("istat")
    direct = names.withColumn("k", F.row_number().over(one)).where(F.col("k") == 1).select(F.col("name").alias("key"), F.col("uri").alias("d_uri"))
    table = keys.sparkSession.createDataFrame(sorted(aliases.items()) or [("", "")], "key string, code string")
    alias = table.join(names, table.code == names.istat).select("key", F.col("uri").alias("a_uri"))
    found = keys.join(direct, "key", "left").join(alias, "key", "left")
    found = found.select("key", F.coalesce("d_uri", "a_uri").alias("uri"), F.when(F.col("d_uri").isNotNull(), "direct").when(F.col("a_uri").isNotNull(), "alias").alias("how"))
    left = found.where(F.col("uri").isNull()).select("key")
    best = best_matches(left, names, min_score, "istat").select("key", F.col("uri").alias("f_uri"))
    return found.join(best, "key", "left").select("key", F.coalesce("uri", "f_uri").alias("uri"), F.coalesce("how", F.when(F.col("f_uri").isNotNull(), "fuzzy")).alias("how"))


class LinkProvinceByName(_Lookup):
    """Names by a cascade: normalized equality, alias, fuzzy ratio of ``min_fuzzy_score`` or more."""

    def __init__(self, name_column: str, dimension: DataFrame, manual_aliases: Mapping[str, str] | None = None, min_fuzzy_score: float = 90, raise_on_unmatched: bool = False, output_columns: Mapping[str, str] | None = None):
        super().__init__(name_column, dimension, output_columns)
        if not 0 <= min_fuzzy_score <= 100:
            raise ValueError("min_fuzzy_score must be within 0 and 100")
        self.aliases = ALIASES if manual_aliases is None else dict(manual_aliases)
        self.score, self.strict = min_fuzzy_score, raise_on_unmatched

    def apply(self, dataset: Dataset) -> Dataset:
        d = dataset.data
        need(d, [self.source])
        key = province_key(d[self.source].cast("string"))
        keys = d.select(key.alias("key")).where(F.col("key").isNotNull()).distinct()
        found = cascade(keys, self.dimension, self.aliases, self.score)
        if self.strict and (lost := [r.key for r in found.where(F.col("uri").isNull()).orderBy("key").limit(10).collect()]):
            raise ValueError(f"names without a province: {lost}")
        index = found.where(F.col("uri").isNotNull()).withColumnRenamed("key", "__key").join(self.dimension, "uri")
        return self.attach(dataset, key, index)


def office_notation(slug: Column, n_provinces: Column) -> Column:
    return F.when(n_provinces > 1, F.lit("INPS-CA-SU")).otherwise(F.concat(F.lit("INPS-"), F.substring(F.upper(slug), 1, 8)))


class LinkOffice(PipelineStep):
    """Offices to provinces; an office of several provinces has them all in ``aggregates`` (joined by commas).

    Adds office uri, slug, the code it corresponds to (one province), the codes it aggregates
    (several) and the uri of the first province. ``bridge`` gives one row for each office and province. With ``sidecar_to`` the
    triples of ``sidecar`` are written there as Turtle, with a header and the names in ``labels``.
    """

    COLUMNS = ("uri_sede", "slug_sede", "correspondsto_codice_istat", "aggregates_codici_istat", "uri_provincia_principale")

    def __init__(self, office_column: str, dimension: DataFrame, namespace: str, offices: Mapping[str, list[str]] | None = None, min_fuzzy_score: float = 90, sidecar_to: str | None = None, labels: DataFrame | None = None):
        super().__init__()
        self.sidecar_to, self.labels = sidecar_to, labels
        self.source, self.dimension, self.namespace, self.score = office_column, dimension, namespace, min_fuzzy_score
        self.offices = OFFICES if offices is None else dict(offices)

    def _index(self, keys: DataFrame) -> DataFrame:
        several = keys.sparkSession.createDataFrame([(k, ",".join(v), v[0]) for k, v in self.offices.items()] or [("", "", "")], "key string, many string, first string")
        found = cascade(keys.join(several, "key", "left_anti"), self.dimension, ALIASES, self.score).join(self.dimension.select("uri", "istat"), "uri", "left")
        one = found.select("key", F.col("istat").alias("one"), F.lit(None).cast("string").alias("many"), "uri")
        first = self.dimension.select(F.col("istat").alias("first"), "uri")
        return one.unionByName(keys.join(several, "key").join(first, "first", "left").select("key", F.lit(None).cast("string").alias("one"), "many", "uri"))

    def apply(self, dataset: Dataset) -> Dataset:
        d = dataset.data
        need(d, [self.source])
        key = province_key(d[self.source].cast("string"))
        index = self._index(d.select(key.alias("key")).where(F.col("key").isNotNull()).distinct())
        slug = slugify(d[self.source].cast("string"))
        values = (F.concat(F.lit(self.namespace + "sede-"), slug), slug, index.one, index.many, index.uri)
        out = d.join(index, key == index.key, "left").select(*[d[c] for c in d.columns if c not in self.COLUMNS], *[v.alias(n) for n, v in zip(self.COLUMNS, values, strict=True)])
        if self.sidecar_to:
            from ..sources.turtle_sink import write_turtle

            write_turtle(self.sidecar(out, self.namespace, labels=self.labels, header=True), self.sidecar_to)
        return self.done(dataset, out, {"source": self.source})

    def bridge(self, linked: DataFrame) -> DataFrame:
        """(uri_sede, codice_istat), an office of several provinces on a row for each."""
        codes = F.split(F.coalesce("correspondsto_codice_istat", "aggregates_codici_istat"), ",")
        return linked.select("uri_sede", F.explode(codes).alias("codice_istat")).distinct()

    def sidecar(self, linked: DataFrame, vocabulary: str, province_base: str = PROVINCES, labels: DataFrame | None = None, header: bool = False) -> DataFrame:
        """Triples of each office: type, label, notation and its provinces.

        ``labels`` (istat, label) are the provinces' names in the source of residences, each of which becomes an altLabel in the language
        it-x-inps. ``header`` adds the sidecar's own node.
        """
        codes = F.split(F.coalesce("correspondsto_codice_istat", "aggregates_codici_istat"), ",")
        rows = linked.select("uri_sede", "slug_sede", F.col(self.source).alias("label"), codes.alias("codes")).where(F.col("codes").isNotNull()).distinct()
        item = lambda p, o, kind, lang=None: F.struct(F.lit(p).alias("p"), o.alias("o"), F.lit(kind).alias("o_kind"), F.lit(lang).cast("string").alias("lang"))
        verb = F.when(F.size("codes") > 1, F.lit(vocabulary + "aggregatesProvince")).otherwise(F.lit(vocabulary + "correspondsToProvince"))
        to = F.transform("codes", lambda c: F.struct(verb.alias("p"), F.concat(F.lit(province_base), c).alias("o"), F.lit("iri").alias("o_kind"), F.lit(None).cast("string").alias("lang")))
        fixed = F.array(item(RDF_TYPE, F.lit(vocabulary + "Office"), "iri"), item(SKOS + "prefLabel", F.col("label"), "literal", "it"), item(SKOS + "notation", office_notation(F.col("slug_sede"), F.size("codes")), "literal"))
        out = rows.select(F.col("uri_sede").alias("s"), F.explode(F.concat(fixed, to)).alias("x")).select("s", "x.p", "x.o", "x.o_kind", F.lit(None).cast("string").alias("datatype"), "x.lang").distinct()
        if labels is not None:
            none = F.lit(None).cast("string")
            named = labels.where(F.col("istat").isNotNull() & F.col("label").isNotNull())
            out = out.unionByName(named.select(F.concat(F.lit(province_base), "istat").alias("s"), F.lit(SKOS + "altLabel").alias("p"), F.col("label").alias("o"), F.lit("literal").alias("o_kind"), none.alias("datatype"), F.lit("it-x-inps").alias("lang")).distinct())
        if header:
            about = "Names of offices and provinces in the pension sources, and the provinces of the official vocabulary that they stand for"
            out = out.unionByName(sidecar_header(linked.sparkSession, vocabulary + "offices-to-provinces", "Offices and provinces", about, OFFICE_SOURCE))
        return out


def reconcile_labels(rows: DataFrame, provinces: DataFrame, overrides: Mapping[str, str]) -> tuple[DataFrame, DataFrame]:
    """External resources to provinces: (istat, resource) and the provinces left over.

    ``rows``: resource, label_it, label_en; ``provinces``: istat, label. An override (istat to
    resource) comes first; else a label, without its prefix and with "e" or "and", equals the name; the first
    resource in order wins.
    """
    label = F.explode(F.filter(F.array("label_it", "label_en"), lambda x: x.isNotNull())).alias("label")
    bare = F.regexp_replace(province_key(F.col("label")), "^(" + "|".join(PREFIXES) + ")", "")
    forms = rows.select("resource", label).select("resource", F.trim(bare).alias("b"))
    forms = forms.select("resource", F.explode(F.array_distinct(F.array("b", F.replace("b", F.lit(" and "), F.lit(" e ")), F.replace("b", F.lit(" e "), F.lit(" and "))))).alias("form"))
    first = forms.groupBy("form").agg(F.min("resource").alias("m_resource"))
    table = rows.sparkSession.createDataFrame(sorted(overrides.items()) or [("", "")], "istat string, o_resource string")
    named = provinces.select("istat", province_key(F.col("label")).alias("form")).join(first, "form", "left").join(table, "istat", "left")
    found = named.select("istat", F.coalesce("o_resource", "m_resource").alias("resource"))
    return found.where(F.col("resource").isNotNull()), found.where(F.col("resource").isNull()).select("istat")


def sidecar_header(spark: SparkSession, uri: str, title: str, description: str, source: str, created: str | None = None, language: str = "en") -> DataFrame:
    """What a sidecar says of itself: type, title, description, source, licence and, if given, the day it was made."""
    rows = [(RDF_TYPE, DCT + "Standard", "iri", None, None), (DCT + "title", title, "literal", None, language), (DCT + "description", description, "literal", None, language), (DCT + "source", source, "iri", None, None), (DCT + "license", CC_BY, "iri", None, None)]
    if created:
        rows.append((DCT + "created", created, "literal", XSD + "date", None))
    return spark.createDataFrame([(uri, *r) for r in rows], "s string, p string, o string, o_kind string, datatype string, lang string")


def same_as_sidecar(found: DataFrame, province_base: str = PROVINCES, header_uri: str | None = None, source: str = LABEL_SOURCE, created: str | None = None) -> DataFrame:
    """sameAs triples of reconciled provinces; with ``header_uri`` also the sidecar's own node, which says how many there are."""
    none = F.lit(None).cast("string")
    if header_uri:
        about = f"{found.count()} links of provinces to resources of {source}, by their labels and by hand where names differ"
        return same_as_sidecar(found, province_base).unionByName(sidecar_header(found.sparkSession, header_uri, "Provinces and external resources", about, source, created))
    return found.select(F.concat(F.lit(province_base), "istat").alias("s"), F.lit(OWL + "sameAs").alias("p"), F.col("resource").alias("o"), F.lit("iri").alias("o_kind"), none.alias("datatype"), none.alias("lang"))
