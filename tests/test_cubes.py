import pytest
from pyspark.sql import functions as F

from lumencube.core import Dataset
from lumencube.operators import reshape as P
from lumencube.operators.index import composite_long, index_components, normalized, quintile_colours, ranked
from lumencube.operators.observations import QB, STATUS, EmitObservations
from lumencube.plans import quality
from lumencube.plans.recipes import CompositeIndex, ProjectedPublicRegimes, PublicStartYears, SeriesByOffice
from lumencube.plans.vocabulary import REGIMES
from lumencube.sources.turtle import XSD

from .test_link import dim, triples  # noqa: F401


def test_regroup(spark):
    rows = [("Cagliari", 5, 100.0, 1.0), ("Carbonia-Iglesias", 10, 800.0, 0.1), ("Medio Campidano", 8, 900.0, None), ("Nuoro", 1, None, 0.5), ("Ogliastra", None, 7.0, 0.5), ("Sassari", 2, 1.0, 1.0), ("Oristano", 3, 2.0, 1.0), ("Torino", 100, 5.0, 9.0), (None, 7, 7.0, 7.0)]
    d = Dataset(spark.createDataFrame(rows, "provincia string, n bigint, m double, t double"))
    got = P.AggregateSardiniaProvinces("provincia", ["n"], {"m": "n"}, ["t"]).apply(d)
    out = {r.provincia: (r.n, r.m, r.t) for r in got.data.collect()}
    assert len(out) == 7 and out["Sud Sardegna"] == (18, pytest.approx((800 * 10 + 900 * 8) / 18), 0.1) and out["Nuoro"] == (1, None, 1.0) and out["Torino"] == (100, 5.0, 9.0) and out[None] == (7, 7.0, 7.0)
    assert got.data.agg(F.sum("n")).first()[0] == d.data.agg(F.sum("n")).first()[0] and got.history[0].metrics == {"rows_in": 9, "rows_out": 7}
    with pytest.raises(ValueError):
        P.AggregateSardiniaProvinces("provincia", [], {}, mode="series")
    with pytest.raises(KeyError):
        P.AggregateSardiniaProvinces("provincia", ["zz"], {}).apply(d)


def test_incomes(spark):
    names = [c for pair in P.INCOME_COLUMNS.values() for c in pair]
    rows = [("TO", "100", *["1"] * 9), ("TO", "50", *[""] * 9), ("LT", "200", *[None] * 9), ("0", "999", *["9"] * 9), (None, "5", *["5"] * 9)]
    d = spark.createDataFrame(rows, ", ".join(["`Sigla Provincia` string", *(f"`{c}` string" for c in names)]))
    got = P.AggregateIncomesByProvince({k: f"u:{k}" for k in P.INCOME_COLUMNS}).apply(Dataset(d))
    out = {(r.code, r.kind): (r.uri, r.freq, r.amount) for r in got.data.collect()}
    assert len(out) == 10 and out["TO", "v2"] == ("u:v2", 150, 1) and out["LT", "v2"] == ("u:v2", 200, 0) and out["TO", "v7"] == ("u:v7", 1, 1)


def test_unpivots(spark):
    wide = Dataset(spark.createDataFrame([("A", 2.0, 10.0, None, None), ("B", None, 3.0, 1.0, None)], "sede string, n_1998 double, media_1998 double, n_1999 double, media_1999 double"))
    uris = {"count": "u:c", "mean": "u:m", "annual": "u:a"}
    got = P.UnpivotYears(uris, years=[1998, 1999]).apply(wide)
    assert {(r.sede, r.anno, r.measure_type, r.value) for r in got.data.collect()} == {("A", 1998, "u:c", 2.0), ("A", 1998, "u:m", 10.0), ("A", 1998, "u:a", 260.0), ("B", 1998, "u:c", None), ("B", 1998, "u:m", 3.0), ("B", 1998, "u:a", None), ("B", 1999, "u:c", 1.0), ("B", 1999, "u:m", None), ("B", 1999, "u:a", None)}
    assert got.history[0].metrics == {"rows": 9, "rows_skipped_all_nan": 3}
    assert P.UnpivotYears(uris, years=[]).groups == {}
    paired = P.PairedUnpivot({"x": {"n": "n_1998"}, "y": {"n": "n_1999"}}, ["sede"], "k", skip_missing=True).apply(wide)
    assert {tuple(r) for r in paired.data.collect()} == {("A", "x", 2.0), ("B", "y", 1.0)}


def test_shares(spark, tmp_path):
    years = spark.createDataFrame([(1995, 100), (1996, 150), (2011, 50), (2012, 400), (1800, 7), (None, 3)], "y int, n bigint")
    got = {r.bucket: (r.total, r.share) for r in P.bucket_share(years, "y", "n").collect()}
    assert got == {"retributivo": (100.0, pytest.approx(1 / 7)), "misto-dini": (200.0, pytest.approx(2 / 7)), "misto-fornero": (400.0, pytest.approx(4 / 7)), "contributivo-puro": (0.0, 0.0)}
    assert {r.share for r in P.bucket_share(years.limit(0), "y", "n").collect()} == {0.0}
    d = Dataset(spark.createDataFrame([("a", 1000, 1)], "provincia string, n bigint, extra int"))
    long = P.ProjectShares("n", P.bucket_share(years, "y", "n"), key_columns=["provincia"], keep_extra_columns=False).apply(d)
    assert long.columns == ["provincia", "n", "regime_notation", "projected", "_status"] and long.data.agg(F.sum("projected")).first()[0] == pytest.approx(1000)
    with pytest.raises(ValueError):
        P.ProjectShares("n", years, shape="tall")
    with pytest.raises(FileNotFoundError):
        P.ProjectRegimes("n", spark, str(tmp_path / "none.csv"))


def test_index(spark):
    d = spark.createDataFrame([("a", 1.0, 5.0), ("b", 3.0, 5.0), ("c", None, 5.0), ("d", 2.0, 5.0)], "k string, x double, y double")
    norm = {r.k: (r.x_norm, r.y_norm) for r in normalized(d, ["x", "y"]).collect()}
    assert norm == {"a": (0.0, 0.5), "b": (1.0, 0.5), "c": (None, 0.5), "d": (0.5, 0.5)}
    long = {(r.k, r.component): (r.value, r.raw) for r in composite_long(d, ["k"], ["x", "y"]).collect()}
    assert long["b", "aggregate"] == (0.75, None) and long["b", "x"] == (1.0, 3.0) and long["c", "aggregate"] == (None, None)
    order = {r.k: r["rank"] for r in ranked(d, "x", "k").collect()}
    assert order == {"b": 1, "d": 2, "a": 3, "c": 4}
    colours = {r.k: r.colour for r in quintile_colours(d, "x", ["lo", "hi"]).collect()}
    assert colours == {"a": "lo", "b": "hi", "c": None, "d": "lo"}
    assert quintile_colours(d.limit(0), "x", ["lo"]).count() == 0 and ranked(d.limit(0), "x", "k").count() == 0


def test_components_and_index_cube(spark):
    pensions = spark.createDataFrame([("001", 300, 2.0, 100, 50, 50), ("002", 100, 1.0, 40, 30, 30)], "istat string, total_count bigint, total_millions double, private bigint, public bigint, self_employed bigint")
    employed = spark.createDataFrame([("001", 0.2), ("002", 0.1)], "istat string, thousands double")
    incomes = spark.createDataFrame([("001", 1000000), ("001", 3000000), ("002", 4000000)], "istat string, amount bigint")
    offices = spark.createDataFrame([("001", 80.0), ("002", 10.0)], "istat string, count double")
    plan = spark.createDataFrame([("001", 20.0), ("002", 15.0)], "istat string, count double")
    rows = {r.istat: (r.d1, r.d2, r.d3) for r in index_components(pensions, employed, incomes, offices, plan).collect()}
    assert rows == {"001": (pytest.approx(1.5), 0.5, 0.5), "002": (pytest.approx(1.0), 0.25, 0.25)}
    cube = CompositeIndex.from_tables(pensions, employed, incomes, offices, plan).make()
    assert cube.data.count() == 8 and cube.history[-1].metrics["observations_emitted"] == 8
    assert cube.data.where("component = 'aggregate' and istat = '001'").first().sources == [f"https://example.org/cubes/obs-index-001-2026-{d}" for d in ("d1", "d2", "d3")]
    assert cube.data.where("component = 'd1' and istat = '001'").first().sources == ["https://example.org/cubes/obs-vigenti-001-2026-TOT", "https://example.org/cubes/obs-occupati-001-2025"]


def emitter(**options):
    base = {"dimensions": {"uri": "ex:dim", "anno": ("ex:year", XSD + "gYear")}, "measures": {"v": "ex:v"}}
    return EmitObservations("ex:cube", "ex:dsd", "ex:obs-{code}", **(base | options))


def test_emit(spark, tmp_path):
    rows = [("http://p/1", "2025", "001", 3.5, ["s1", "s2"], 7), ("http://p/2", "2025", "002", 4.0, [], -7), (None, "2025", "003", 1.0, None, 0), ("http://p/4", "2025", "004", None, None, None), ("http://p/1", "2025", "001", 3.5, ["s1"], 7)]
    d = Dataset(spark.createDataFrame(rows, "uri string, anno string, code string, v double, src array<string>, whole int"))
    step = emitter(provenance_column="src", constants={"ex:sex": '"T"^^xsd:string', "ex:note": '"ciao"@it', "ex:area": "http://a"}, attributes={"whole": "ex:whole"}, metadata={"title": "T", "issued": "2026-01-01", "license": "http://l", "ex:own": "z"}, dataset_attributes={"ex:unit": '"EUR"@en'}, output=str(tmp_path / "out"))
    got = step.apply(d)
    assert [r._obs_uri for r in got.data.orderBy(F.asc_nulls_last("code")).collect()].count(None) == 1
    t = {(r.s, r.p, r.o, r.datatype, r.lang) for r in step.triples.collect()}
    assert ("ex:obs-001", "ex:v", "3.5", XSD + "decimal", None) in t and ("ex:obs-002", "ex:v", "4", XSD + "nonNegativeInteger", None) in t
    assert ("ex:obs-001", "ex:year", "2025", XSD + "gYear", None) in t and ("ex:obs-002", "ex:whole", "-7", XSD + "integer", None) in t
    assert ("ex:cube", "http://purl.org/dc/terms/title", "T", None, "it") in t and ("ex:cube", "ex:own", "z", None, "it") in t and ("ex:cube", "ex:unit", "EUR", None, "en") in t
    assert sum(p == "ex:v" for _, p, *_ in t) == 2 and sum(p.endswith("wasDerivedFrom") for _, p, *_ in t) == 2
    assert got.history[0].metrics == {"input_rows": 5, "observations_emitted": 4, "rows_skipped_missing_dimension": 1, "triples_written": len(t)}
    assert spark.read.text(str(tmp_path / "out")).count() == len(t)
    with pytest.raises(KeyError):
        emitter(measures={"nope": "x"}).apply(d)
    with pytest.raises(ValueError):
        emitter(value_column="v")
    with pytest.raises(KeyError):
        EmitObservations("a", "b", "x-{nope}", {"uri": "p"}, {"v": "q"}).apply(d)


def test_emit_measure_types(spark):
    rows = [("http://p/1", "001", "http://m/count", 2.0, "E"), ("http://p/1", "002", "http://m/mean", None, None)]
    step = EmitObservations("ex:c", "ex:d", "ex:o-{code}", {"uri": "ex:dim"}, measure_type_column="mt", value_column="v", status_column="st")
    step.apply(Dataset(spark.createDataFrame(rows, "uri string, code string, mt string, v double, st string")))
    t = {(r.s, r.p, r.o) for r in step.triples.collect()}
    assert ("ex:o-001", "http://m/count", "2") in t and ("ex:o-001", QB + "measureType", "http://m/count") in t and ("ex:o-001", STATUS, "E") in t
    assert not any(s == "ex:o-002" and p == QB + "measureType" for s, p, _ in t) and any(s == "ex:o-002" and p == STATUS for s, p, _ in t)


def test_series_recipe(spark, dim):  # noqa: F811
    names = ["sede", *[f"{v}_{y}" for y in range(1998, 2027) for v in ("n", "media")]]
    rows = [["TORINO", *["1.000", "10,5"], *["-"] * 56], ["CAGLIARI", *["10", "1"], *["-"] * 54, "7", "2"]]
    d = Dataset(spark.createDataFrame([tuple(r) for r in rows], ", ".join(f"`{n}` string" for n in names)))
    got = SeriesByOffice(dimension=dim).apply(d).data
    out = {(r.slug_sede, r.anno, r.misura): (r.value, r.status[-1], len(r.derived)) for r in got.collect()}
    assert len(out) == 9 and out["torino", 1998, "numeroPensioni"] == (1000.0, "A", 0) and out["torino", 1998, "importoAnnuoComplessivo"] == (136500.0, "E", 2)
    assert out["cagliari", 1998, "numeroPensioni"][1] == "E" and out["cagliari", 2026, "numeroPensioni"][1] == "A"


def test_start_and_projection_recipes(spark, tmp_path):
    place = tmp_path / "y.csv"
    place.write_text('t\n"A";"";"n";"e";"m";"d";"x"\n"fino al 31/12/1980";"";"10";"43,5";"1,5";"2";"80"\n"2000";"";"30";"50";"1";"2";"70"\n"Totale";"";"40";"1";"1";"1";"1"\n')
    from lumencube.sources.olap import read_start_years

    cube = PublicStartYears().apply(Dataset(read_start_years(spark, str(place))))
    assert {(r.anno_decorrenza, r.status[-1]) for r in cube.data.collect()} == {(1980, "E"), (2000, "A")}
    counts = Dataset(spark.createDataFrame([("http://p/001", "001", 400)], "uri_agid string, codice_istat string, n_pubblici bigint"))
    plan = ProjectedPublicRegimes(spark=spark, start_years_path=str(place)).apply(counts)
    assert {r.regime_notation: r.projected for r in plan.data.collect()} == {"retributivo": 100.0, "misto-dini": 300.0, "misto-fornero": 0.0, "contributivo-puro": 0.0}
    assert plan.history[-1].metrics["observations_emitted"] == len(REGIMES)
    check = quality.conservation(plan.data, counts.data, ["codice_istat"], "projected", "n_pubblici")
    assert check.ok


def test_quality(spark):
    step = emitter()
    step.apply(Dataset(spark.createDataFrame([("http://p/1", "2025", "001", 3.5), ("http://p/2", "2025", "002", None)], "uri string, anno string, code string, v double")))
    spec = quality.CubeSpec("c", "ex:cube", "ex:dsd", 2, ("ex:dim", "ex:year"), ("ex:v",), read=lambda: step.triples)
    checks = quality.check_cube(spec)
    assert [c.ok for c in checks] == [True, True, True, True, True, False] and checks[-1].actual == 1
    absent = quality.check_cube(quality.CubeSpec("d", "x", "y", 1, (), ()))
    passed, failed, skipped, text = quality.report(checks + absent)
    assert (passed, failed, skipped) == (5, 1, 1) and "SKIP d: present" in text
    from lumencube.sources.turtle import parse

    words = """@prefix qb: <http://purl.org/linked-data/cube#> . @prefix rdfs: <http://www.w3.org/2000/01/rdf-schema#> . @prefix skos: <http://www.w3.org/2004/02/skos/core#> . @prefix ex: <http://ex/> .
    ex:d1 a qb:DataStructureDefinition ; qb:component [ qb:dimension ex:p ] , [ qb:measure ex:m ] . ex:d2 a qb:DataStructureDefinition ; qb:component [ qb:dimension ex:p ] .
    ex:p a qb:DimensionProperty ; rdfs:range skos:Concept . ex:m a qb:MeasureProperty ; qb:concept ex:c ."""
    t = spark.createDataFrame(list(parse(words)), "s string, p string, o string, o_kind string, datatype string, lang string")
    got = {c.name: c.ok for c in quality.check_vocabularies(t, {QB + "DataStructureDefinition": 2}, {QB + "DimensionProperty": 1})}
    assert list(got.values()) == [True, True, True, False, False, True]
    package = quality.check_package(t, "http://ex/d1", {QB + "component": 2, "http://ex/none": 0})
    assert all(c.ok for c in package)


def test_territory(dim):  # noqa: F811
    assert [c.ok for c in quality.check_territory(dim, 8, 11, 1)] == [True] * 4
