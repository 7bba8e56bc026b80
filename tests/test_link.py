import pytest
from pyspark.sql import functions as F

from lumencube.core import Dataset
from lumencube.operators.closure import reachable, transitive_closure
from lumencube.operators.link import LinkOffice, LinkProvinceByAcronym, LinkProvinceByName, LinkProvinceByNUTS, dimension_from_triples, nuts_index, reconcile_labels, same_as_sidecar
from lumencube.sources.turtle import parse

BASE = "https://w3id.org/italia/controlled-vocabulary/territorial-classifications/provinces/"
PROVINCES = [
    ("001", "TO", "Torino", ["ITC11"]),
    ("007", "AO", "Valle d'Aosta/Vallée d'Aoste", ["ITC20"]),
    ("021", "BZ", "Bolzano/Bozen", ["ITD10"]),
    ("040", "FC", "Forlì-Cesena", ["ITD58"]),
    ("045", "MS", "Massa-Carrara", ["ITE11"]),
    ("092", "CA", "Cagliari", ["ITG27"]),
    ("111", "SU", "Sud Sardegna", ["ITG27", "ITG2B", "ITG2C", "-"]),
    ("108", "MB", "Monza e della Brianza", ["-"]),
]


@pytest.fixture(scope="module")
def triples(spark):
    text = "@prefix clv: <https://w3id.org/italia/onto/CLV/> . @prefix skos: <http://www.w3.org/2004/02/skos/core#> . @prefix owl: <http://www.w3.org/2002/07/owl#> . @prefix nuts: <http://nuts.geovocab.org/id/> .\n"
    for code, acronym, label, nuts in PROVINCES:
        same = " , ".join(f"<http://nuts.geovocab.org/id/{n}>" for n in nuts)
        text += f'<{BASE}{code}> a clv:Province ; skos:prefLabel "{label}"@it , "X{code}"@en ; skos:notation "{code}" ; clv:acronym "{acronym}" ; clv:situatedWithin <http://r/1> ; owl:sameAs {same} .\n'
    text += f"nuts:ITD1 owl:sameAs nuts:ITD10 . nuts:ITD10 owl:sameAs nuts:ITD1 . nuts:IT108 skos:exactMatch <{BASE}108> .\n"
    return spark.createDataFrame(list(parse(text)), "s string, p string, o string, o_kind string, datatype string, lang string").cache()


@pytest.fixture(scope="module")
def dim(triples):
    return dimension_from_triples(triples).cache()


def linked(step, spark, values, name="x"):
    d = Dataset(spark.createDataFrame([(v,) for v in values], f"{name} string"))
    got = step.apply(d)
    return {r[name]: r.codice_istat for r in got.data.collect()}, got


def test_dimension(dim):
    rows = {r.istat: r for r in dim.collect()}
    assert len(rows) == 8 and rows["111"].nuts == ["-", "ITG27", "ITG2B", "ITG2C"] and rows["001"].label == "Torino"


def test_nuts(spark, triples, dim):
    index = {r.code: r.uri[-3:] for r in nuts_index(triples, dim).collect()}
    assert index == {"ITC11": "001", "ITC20": "007", "ITD10": "021", "ITD1": "021", "ITD58": "040", "ITE11": "045", "ITG27": "092", "ITG2B": "111", "ITG2C": "111", "IT108": "108"}
    got, done = linked(LinkProvinceByNUTS("x", dim, triples), spark, ["ITC11", "ITD1", "IT108", "BOGUS", None, "-"])
    assert got == {"ITC11": "001", "ITD1": "021", "IT108": "108", "BOGUS": None, None: None, "-": None}
    assert done.history[0].metrics["matched"] == 3 and "BOGUS" in done.history[0].metrics["unmatched_codes"]


def test_acronym(spark, dim):
    assert linked(LinkProvinceByAcronym("x", dim), spark, ["TO", "bz", "ZZ"])[0] == {"TO": "001", "bz": "021", "ZZ": None}
    assert linked(LinkProvinceByAcronym("x", dim, case_insensitive=False), spark, ["bz"])[0] == {"bz": None}


def test_names(spark, dim):
    want = {"TORINO": "001", "Torin": "001", "Aosta": "007", "BOLZANO": "021", "Provincia Autonoma di Bolzano/Bozen": "021", "FORLI": "040", "MASSA CARRARA": "045", "Atlantide": None, None: None, "verbania": None}
    assert linked(LinkProvinceByName("x", dim), spark, list(want))[0] == want
    with pytest.raises(ValueError, match="atlantide"):
        linked(LinkProvinceByName("x", dim, raise_on_unmatched=True), spark, ["Atlantide"])
    with pytest.raises(ValueError):
        LinkProvinceByName("x", dim, min_fuzzy_score=101)
    other = linked(LinkProvinceByName("x", dim, manual_aliases={"capital": "001"}, output_columns={"uri": "u"}), spark, ["Capital"])
    assert other[0] == {"Capital": "001"} and "u" in other[1].columns


def test_offices(spark, dim):
    step = LinkOffice("x", dim, "http://ns/")
    got = step.apply(Dataset(spark.createDataFrame([("TORINO",), ("CAGLIARI E SUD SARDEGNA",), ("NOWHERE",)], "x string")))
    rows = {r.x: r for r in got.data.collect()}
    assert (rows["TORINO"].correspondsto_codice_istat, rows["TORINO"].slug_sede, rows["TORINO"].uri_sede) == ("001", "torino", "http://ns/sede-torino")
    both = rows["CAGLIARI E SUD SARDEGNA"]
    assert both.aggregates_codici_istat == "092,111" and both.correspondsto_codice_istat is None and both.uri_provincia_principale.endswith("092")
    assert rows["NOWHERE"].correspondsto_codice_istat is None
    assert {tuple(r) for r in step.bridge(got.data).collect()} == {("http://ns/sede-torino", "001"), ("http://ns/sede-cagliari-e-sud-sardegna", "092"), ("http://ns/sede-cagliari-e-sud-sardegna", "111")}
    side = {(r.s.rsplit("-", 1)[-1], r.p.rsplit("/", 1)[-1].rsplit("#", 1)[-1], r.o.rsplit("/", 1)[-1]) for r in step.sidecar(got.data, "http://ns/").collect()}
    assert ("torino", "notation", "INPS-TORINO") in side and ("sardegna", "notation", "INPS-CA-SU") in side and ("sardegna", "aggregatesProvince", "111") in side and len(side) == 9


def test_reconcile(spark, dim):
    rows = spark.createDataFrame([("d:Turin", "Provincia di Torino", "Metropolitan City of Turin"), ("d:FC", None, "Province of Forlì-Cesena"), ("d:MB", None, "Province of Monza and della Brianza"), ("d:X", "Nulla", None)], "resource string, label_it string, label_en string")
    found, lost = reconcile_labels(rows, dim, {"001": "d:Override"})
    assert {tuple(r) for r in found.collect()} == {("001", "d:Override"), ("040", "d:FC"), ("108", "d:MB")} and lost.count() == 5
    assert same_as_sidecar(found).where(F.col("p").endswith("sameAs")).count() == 3


def test_closure(spark):
    edges = spark.createDataFrame([(1, 2), (2, 3), (3, 1), (4, 1), (5, 5), (None, 1), (1, 2)], "a int, b int")
    ring = {(x, y) for x in (1, 2, 3, 4) for y in (1, 2, 3)} | {(5, 5)}
    assert {tuple(r) for r in transitive_closure(edges).collect()} == ring
    assert {tuple(r) for r in reachable(edges, spark.createDataFrame([(4,), (9,)], "start int")).collect()} == {(4, 1), (4, 2), (4, 3)}
    assert transitive_closure(edges.limit(0)).count() == 0


def test_closure_deals_out_each_pair_once_for_an_edge(spark, monkeypatch):
    """A grid has many paths between two nodes; rounds deal out what edges before the newest pairs make and nothing else."""
    n, dealt = 8, []
    edges = spark.createDataFrame([(x * n + y, (x + i) * n + y + j) for x in range(n) for y in range(n) for i, j in ((1, 0), (0, 1)) if x + i < n and y + j < n], "a int, b int")
    real = type(edges).repartition
    monkeypatch.setattr(type(edges), "repartition", lambda self, *by: dealt.append(self.count()) or real(self, *by))
    got = [tuple(r) for r in transitive_closure(edges).collect()]
    want = {(x * n + y, u * n + v) for x in range(n) for y in range(n) for u in range(x, n) for v in range(y, n)} - {(k, k) for k in range(n * n)}
    assert len(got) == len(want) and set(got) == want
    assert len(dealt) > 2 and sum(dealt) <= 2 * edges.count() + 2 * len(want)


def test_closure_of_a_path_longer_than_its_single_rounds(spark, monkeypatch):
    from lumencube.operators import closure

    monkeypatch.setattr(closure, "SINGLE_ROUNDS", 3)
    before = spark.conf.get("spark.sql.requireAllClusterKeysForCoPartition")
    edges = spark.createDataFrame([(k, k + 1) for k in range(40)] + [(40, 30)], "a int, b int")
    got = [tuple(r) for r in closure.transitive_closure(edges).collect()]
    want = {(i, j) for i in range(41) for j in range(41) if i < j} | {(i, j) for i in range(30, 41) for j in range(30, 41)}
    assert len(got) == len(set(got)) and set(got) == want
    assert spark.conf.get("spark.sql.requireAllClusterKeysForCoPartition") == before
    assert spark.sql("SHOW TABLES").where("tableName LIKE 'closure_%' OR tableName LIKE 'links_%'").count() == 0


@pytest.mark.parametrize("single", [24, 1])
def test_closures_send_no_table_through_the_driver(spark, monkeypatch, single):
    """Files of pairs look small, so Spark would broadcast them; here that is an error."""
    from lumencube.operators import closure

    monkeypatch.setattr(closure, "SINGLE_ROUNDS", single)
    monkeypatch.setattr(closure, "PART_ROWS", 0, raising=False)
    rows = [(k, k // n) for k in range(1, 600) for n in (3, 5)]
    edges = spark.createDataFrame(rows, "a int, b int")
    after = {}
    for a, b in sorted(rows):
        after.setdefault(a, set()).update({b} | after.get(b, set()))
    want = {(a, b) for a, found in after.items() for b in found}
    spark.conf.set("spark.sql.maxBroadcastTableSize", "1k")
    try:
        got = [tuple(r) for r in closure.transitive_closure(edges).collect()]
        assert len(got) == len(want) and set(got) == want
        got = [tuple(r) for r in closure.reachable(edges, edges.select(F.col("a").alias("start"))).collect()]
        assert len(got) == len(want) and set(got) == want
    finally:
        spark.conf.unset("spark.sql.maxBroadcastTableSize")
