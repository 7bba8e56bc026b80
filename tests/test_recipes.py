import datetime

import pytest
from pyspark.sql import functions as F

from lumencube.core import Dataset
from lumencube.operators.index import composite_long
from lumencube.plans import cube_queries, graph_queries
from lumencube.plans.examples import CustomersRecipe, EnrichmentRecipe, MunicipalitiesRecipe, ProvincesRecipe
from lumencube.plans.recipes import IN_FORCE_COLUMNS, REGIME_COLUMNS, CompositeIndex, Demography, Employment, Incomes, PensionsByResidence, PublicStartYears, RegimeByOffice, public_counts, without_areas
from lumencube.plans.sparql import Engine
from lumencube.operators.link import LinkOffice
from lumencube.operators.reshape import INCOME_COLUMNS

from .test_link import BASE, dim, triples  # noqa: F401


@pytest.fixture(scope="module")
def cubes(spark, dim, triples):  # noqa: F811
    """Small versions of six cubes and the graph of all of them."""
    made, graph = {}, [triples]

    def make(name, recipe, data):
        pipeline = recipe.build()
        made[name] = pipeline.run(data if isinstance(data, Dataset) else Dataset(data))
        graph.append(pipeline.steps[-1].triples)

    def text(names):
        return ", ".join(f"`{n}` string" for n in names)

    rows = [("Torino", "", *["1.000", "500,5", "6,5"] * 5), ("Cagliari", "", *["100", "400", "0,5"] * 5), ("Medio Campidano", "", *["10", "300", "-"] * 5), ("Europa", "", *["9", "9", "9"] * 5)]
    in_force = spark.createDataFrame(rows, text(IN_FORCE_COLUMNS))
    make("pensions", PensionsByResidence(dimension=dim), without_areas(in_force, "provincia", ("Europa",)))
    make("regimes", RegimeByOffice(dimension=dim), spark.createDataFrame([("TORINO", "", *["10", "5"] * 5), ("CAGLIARI E SUD SARDEGNA", "", *["20", "-"] * 5)], text(REGIME_COLUMNS)))
    make("employment", Employment(dimension=dim, triples=triples), spark.createDataFrame([("ITC11", "2025", "0.5"), ("ITG27", "2025", "0.1"), ("ITG2B", "2025", "0.2"), ("XX", "2025", "1")], "REF_AREA string, TIME_PERIOD string, Osservazione string"))
    make("demography", Demography(dimension=dim, triples=triples, indicators={"LE65": ("indicatore-speranza-vita-65", "anni")}), spark.createDataFrame([("ITC11", "2025", "20.5", "LE65"), ("ITG27", "2025", "21", "LE65")], "REF_AREA string, TIME_PERIOD string, Osservazione string, DATA_TYPE string"))
    columns = [c for pair in INCOME_COLUMNS.values() for c in pair]
    make("incomes", Incomes(dimension=dim), spark.createDataFrame([("TO", *["2", "1000"] * 5), ("TO", *["1", ""] * 5), ("CA", *["1", "500"] * 5), ("0", *["9", "9"] * 5)], text(["Sigla Provincia", *columns])))
    make("starts", PublicStartYears(), spark.createDataFrame([(1980, 10, 50.0, 40.0), (1985, 30, 60.0, 44.0), (2001, 20, 1.0, None)], "anno_decorrenza int, numero_pensioni bigint, importo_medio double, eta_decorrenza double"))
    components = spark.createDataFrame([("001", 1.0, 0.5, 0.3), ("092", 2.0, 0.4, 0.6), ("111", 1.5, 0.6, 0.9)], "istat string, d1 double, d2 double, d3 double")
    make("index", CompositeIndex(components=components), CompositeIndex(components=components).long())
    office = LinkOffice("sede", dim, "https://example.org/cubes/")
    graph.append(office.sidecar(office.apply(Dataset(made["regimes"].data.select("sede").distinct())).data, "https://example.org/cubes/"))
    whole = graph[0]
    for more in graph[1:]:
        whole = whole.unionByName(more)
    return made, Engine.stored(whole.dropDuplicates())


def test_cubes(cubes):
    made, _ = cubes
    p = {(r.codice_istat, r.gestione): (r.numero, r.medio, r.annuo) for r in made["pensions"].data.collect()}
    assert len(p) == 15 and p["001", "PUB"] == (1000, 500.5, 6.5) and p["111", "TOT"] == (10, 300.0, 0.0)
    assert {(r.codice_istat, r.n_pubblici) for r in public_counts(made["pensions"].data).collect()} == {("001", 1000), ("092", 100), ("111", 10)}
    assert made["regimes"].history[-1].metrics["observations_emitted"] == 24
    assert made["employment"].history[-1].metrics == {"input_rows": 4, "observations_emitted": 3, "rows_skipped_missing_dimension": 1, "triples_written": 3 * 6 + 2 + 5}
    assert {(r.code, r.kind, r.freq, r.amount) for r in made["incomes"].data.where("kind = 'v2'").collect()} == {("TO", "v2", 3, 1000), ("CA", "v2", 1, 500)}
    assert {r.unita for r in made["demography"].data.collect()} == {"anni"}


def number(rows):
    return [tuple(round(float(x), 4) if x is not None and x.replace(".", "", 1).replace("-", "", 1).isdigit() else x for x in r) for r in rows]


def test_graph_queries_say_what_the_plans_say(spark, cubes, dim):  # noqa: F811
    made, engine = cubes
    texts = graph_queries.texts(region="http://r/1", province="001", offices=("torino",))
    run = {name: engine.query(text) for name, text in texts.items() if name != "growth"}
    rows = {name: number(map(tuple, frame.collect())) for name, frame in run.items()}
    long = composite_long(made["index"].data.where("component <> 'aggregate'").groupBy("istat").pivot("component", ["d1", "d2", "d3"]).agg(F.first("raw")), ["istat"], ["d1", "d2", "d3"])
    names = dim.select("istat", "label", "region")
    top = [(r.istat, r.label, r.value) for r in cube_queries.top_index(long, names).collect()]
    assert [(f"{int(c):03d}", n, v) for c, n, v in rows["top10"]] == [(c, n, round(v, 4)) for c, n, v in top] and len(top) == 3
    assert len(rows["bottom10"]) == 3 and rows["bottom10"][0][1] == top[-1][1]
    assert len(rows["breakdown"]) == 4 and sum(r[2] is None for r in rows["breakdown"]) == 1
    assert len(rows["managements_of_region"]) == 12
    assert [(d.rsplit("/", 1)[-1], n) for d, n in rows["estimated"]] == [("composite-index", 12.0), ("public-start-years", 1.0), ("regime-by-office", 8.0)]
    assert sorted((p[-3:], a, i, x) for p, a, i, x in rows["pensions_by_income"]) == [("001", 6.5, 5000.0, 130000.0), ("092", 0.5, 2500.0, 20000.0)]
    flat = made["pensions"].data.select(F.col("codice_istat").alias("istat"), F.col("gestione").alias("management"), F.col("numero").alias("count"), F.col("annuo").alias("annual_millions"))
    money = made["incomes"].data.select(F.col("codice_istat").alias("istat"), "amount")
    assert {(r.istat, r.pct) for r in cube_queries.pensions_by_income(flat, money, ["001", "092"]).collect()} == {("001", 130000.0), ("092", 20000.0)}
    employed = made["employment"].data.select(F.col("codice_istat").alias("istat"), F.col("occupati").alias("thousands"))
    card = {r.kind: round(r.value, 4) for r in cube_queries.identity_card("001", long, flat, employed, money).collect()}
    assert dict(rows["identity"]) == card and len(card) == 7
    assert rows["retributive_by_region"] == [("http://r/1", 10.0, 40.0, 0.25)]
    assert rows["age_by_decade"] == [(1980.0, 43.0, 40.0)]
    assert [r[1] for r in rows["expected_duration"]] == [43.0, 42.5]
    # estimates: two sources each; an index's components: 2, 6 and 4; its mean: the three, and their 11 sources
    assert len(rows["derived_from"]) == 2 * 8 + 3 * (2 + 6 + 4) + 3 * (3 + 11)
    assert "predicates:" in engine.schema_description() and f"{BASE}" not in engine.schema_description()


def test_growth_text(spark):
    rows = [("o1", "torino", "1998", "100"), ("o2", "torino", "2026", "150"), ("o3", "milano", "1998", "1")]
    base = "https://example.org/cubes/"
    t = [(f"x:{o}", base + p, v, kind, dt, None) for o, s, y, n in rows for p, v, kind, dt in (("sede", f"{base}sede-{s}", "iri", None), ("annoRiferimento", y, "literal", "http://www.w3.org/2001/XMLSchema#gYear"), ("numeroPensioni", n, "literal", "http://www.w3.org/2001/XMLSchema#nonNegativeInteger"))]
    engine = Engine(spark.createDataFrame(t, "s string, p string, o string, o_kind string, datatype string, lang string"))
    assert number(map(tuple, engine.query(graph_queries.texts()["growth"]).collect())) == [(base + "sede-torino", 100.0, 150.0, 50.0)]


def test_example_recipes(spark):
    people = Dataset(spark.createDataFrame([(" Ada ", 30.0, None), (" Ada ", 30.0, None), ("Bob", None, None)], "`Full Name` string, Age double, Empty string"))
    assert sorted(map(tuple, CustomersRecipe().apply(people).data.collect())) == [("Ada", 30.0), ("Bob", 30.0)]
    assert CustomersRecipe(drop_duplicates=False).apply(people).data.count() == 3
    towns = Dataset(spark.createDataFrame([("Forlì", "FC", "9999-12-31", 1), ("Vecchia", "FC", "1950-01-01", 2), ("FORLI", "FC", None, 3), ("Roma", "RM", "bad", 4)], "name string, province string, end_date string, municipality_id int"))
    alive = MunicipalitiesRecipe().apply(towns)
    assert {r.municipality_id for r in alive.data.collect()} == {3, 4} and alive.data.where("year(end_date) = 9999").count() == 0
    provinces = ProvincesRecipe({"denominazione": "province_name", "sigla": "acronym"}).apply(Dataset(spark.createDataFrame([("Forlì-Cesena", "FC"), ("Roma", "RM")], "Denominazione string, Sigla string")))
    waste = Dataset(spark.createDataFrame([("Forli", "forlì-cesena", "1.000,5", "12 %"), ("Roma", "Roma", "-", "7%"), ("Nulla", "Roma", "3", "1%")], "comune string, provincia string, kg string, pct string"))
    got = EnrichmentRecipe(provinces, alive).apply(waste)
    assert got.columns == ["comune", "provincia", "kg", "pct", "acronym", "municipality_id"]
    assert {tuple(r) for r in got.data.collect()} == {("Forli", "forlì-cesena", 1000.5, 12, "FC", 3), ("Roma", "Roma", None, 7, "RM", 4), ("Nulla", "Roma", 3.0, 1, "RM", None)}


def test_far_dates_stay(spark):
    towns = Dataset(spark.createDataFrame([("A", "X", "9999-12-31", 1)], "name string, province string, end_date string, municipality_id int"))
    assert MunicipalitiesRecipe().apply(towns).data.first().end_date == datetime.datetime(9999, 12, 31)
