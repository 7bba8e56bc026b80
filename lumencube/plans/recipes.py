"""The nine cubes as recipes: pipelines of steps from a table that was read to observations.

Columns before emission are typed tables (SURVEY §1.4), which the queries and the index use
directly; ``EmitObservations`` adds the triple view.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..core import Dataset, Pipeline, Recipe
from ..functions.text import last_segment
from ..operators.columns import CastTypes, EnrichWithStaticMapping, ParseItalianNumbers, RenameColumns, WithColumn
from ..operators.index import composite_long, index_components
from ..operators.link import CC_BY, LinkOffice, LinkProvinceByAcronym, LinkProvinceByName, LinkProvinceByNUTS
from ..operators.observations import SDMX, EmitObservations
from ..operators.reshape import AggregateIncomesByProvince, AggregateSardiniaProvinces, ProjectRegimes, UnpivotPensionsInForce, UnpivotRegimes, UnpivotYears
from ..operators.rows import FilterRows
from .vocabulary import MANAGEMENTS, REGIMES, SARDINIAN_OFFICES, Vocabulary

STATUS_CODE = SDMX + "code#obsStatus-"
GYEAR = "http://www.w3.org/2001/XMLSchema#gYear"
MEASURES = {"count": "numeroPensioni", "mean": "importoMedioMensile", "annual": "importoAnnuoComplessivo"}

# The columns of the exports, in order.
IN_FORCE_COLUMNS = ["provincia", "blank", *[f"{v}_{m}" for m in MANAGEMENTS for v in ("n", "media", "annuo")]]
REGIME_COLUMNS = ["sede", "blank", *[f"{v}_{r}" for r in [*REGIMES, "TOT"] for v in ("n", "media")]]
YEARS_COLUMNS = ["sede", "blank", *[f"{v}_{y}" for y in range(1998, 2027) for v in ("n", "media")]]


# Codes of demographic indicators, the local names of their concepts and their units.
INDICATORS = {
    "POP014": ("ind-pop014", "%"),
    "POP1564": ("ind-pop1564", "%"),
    "POP65OVER": ("ind-pop65over", "%"),
    "OLDAGEDEPR": ("ind-oldagedepr", "%"),
    "AGEINDEX": ("ind-ageindex", "%"),
    "MEANAGEP": ("ind-meanagep", "anni"),
    "BIRTHRATE": ("ind-birthrate", "per mille"),
    "LIFEEXP65T": ("ind-lifeexp65t", "anni"),
}
#: What each cube says of itself: title, description, source. The texts are in English.
ABOUT = {
    "pensions-by-residence": ("Pensions in force by province of residence and management", "Numbers of pensions, mean monthly and total annual amounts by province of residence, year and management. The provinces of Sardinia are regrouped to those of today; means are weighted by numbers.", "https://www.inps.it/osservatorio"),
    "regime-by-office": ("Pensions by office and settlement regime", "Numbers of pensions and mean monthly amounts by local office and settlement regime, one measure an observation. Annual amounts are estimated as number x mean x 13, and name the observations they were made from. Public pensions are not included.", "https://www.inps.it/osservatorio"),
    "series-by-office": ("Pensions by office and year", "Numbers of pensions and mean monthly amounts by local office and year, one measure an observation. Annual amounts are estimated as number x mean x 13; Sardinian offices before their reform are estimates too.", "https://www.inps.it/osservatorio"),
    "public-start-years": ("Public pensions by start year", "Numbers of public pensions, mean amounts and mean ages by the year they started. The oldest class has all that started by 1980.", "https://www.inps.it/osservatorio"),
    "employment": ("Employed persons by province", "Thousands of employed persons by province and year.", "https://www.istat.it"),
    "demography": ("Demographic indicators by province", "Shares of ages, dependency and ageing indices, mean age, birth rate and life expectancy at 65 by province and year.", "https://www.istat.it"),
    "incomes": ("Declared incomes by province", "Numbers of taxpayers and declared amounts by province, year and kind of income, summed from municipalities.", "https://www.finanze.gov.it"),
    "composite-index": ("Composite index of territorial dependence on pensions", "Three components by province, normalized between their least and greatest values, and their mean. Raw values are attributes; each observation names those it was made from.", "https://www.w3.org/TR/vocab-data-cube/"),
    "projected-regimes": ("Public pensions by province and regime, projected", "Public pensions of each province shared out by the national composition of regimes by start year. All values are estimates.", "https://www.inps.it/osservatorio"),
}
INCOME_KINDS = ("v2", "v4", "v5", "v6", "v7")


def _coded(prefix: str, names: dict[str, str], v: Vocabulary) -> dict[str, str]:
    return {k: v(prefix + name) for k, name in names.items()}


@dataclass
class _CubeRecipe(Recipe):
    """What all cubes share: the territory dimension, names, an optional output of triples.

    ``metadata`` (title, description, issued, source, license, rights) adds to the dataset's node or
    replaces what the cube says of itself; its texts are in ``language``.
    """

    dimension: DataFrame | None = None
    vocabulary: Vocabulary = Vocabulary()
    output: str | None = None
    metadata: dict[str, str] = field(default_factory=dict)
    language: str = "en"

    def emit(self, cube: str, template: str, dimensions: dict, **options) -> EmitObservations:
        v = self.vocabulary
        title, description, source = ABOUT[cube]
        own = {"title": title, "description": description, "license": CC_BY, "source": source, "rights": "Derived from open data of the source, under the same licence"}
        return EmitObservations(v(cube), v(f"dsd-{cube}"), v.base + template, dimensions, output=self.output, metadata=own | self.metadata, language=self.language, **options)


@dataclass
class PensionsByResidence(_CubeRecipe):
    """Cube 1: province x year x management."""

    year: int = 2026

    def build(self) -> Pipeline:
        v = self.vocabulary
        numbers = [c for c in IN_FORCE_COLUMNS if c not in ("provincia", "blank")]
        managements = list(MANAGEMENTS)
        return Pipeline(
            [
                ParseItalianNumbers(numbers),
                AggregateSardiniaProvinces("provincia", [f"n_{m}" for m in managements], {f"media_{m}": f"n_{m}" for m in managements}, [f"annuo_{m}" for m in managements]),
                UnpivotPensionsInForce(managements),
                LinkProvinceByName("provincia", self.dimension),
                WithColumn("anno", str(self.year)),
                EnrichWithStaticMapping("gestione", {"gestione_uri": _coded("", MANAGEMENTS, v)}),
                CastTypes({"numero": "Int64"}, errors="coerce"),
                self.emit("pensions-by-residence", "obs-vigenti-{codice_istat}-{anno}-{gestione}", {"uri_agid": v("provincia"), "anno": (v("annoRiferimento"), GYEAR), "gestione_uri": v("tipoGestione")}, measures={"numero": v(MEASURES["count"]), "medio": v(MEASURES["mean"]), "annuo": v(MEASURES["annual"])}),
            ],
            on_error="raise",
        )


@dataclass
class RegimeByOffice(_CubeRecipe):
    """Cube 2: office x year x regime x measure, one value a row; the annual amount is an estimate. ``sidecar`` is where the offices and provinces go as Turtle, with the names in ``residences``."""

    year: int = 2026
    sidecar: str | None = None
    residences: DataFrame | None = None

    def build(self) -> Pipeline:
        v = self.vocabulary
        link = LinkOffice("sede", self.dimension, v.base, sidecar_to=self.sidecar, labels=self.residences)
        return Pipeline(
            [
                ParseItalianNumbers([c for c in REGIME_COLUMNS if c not in ("sede", "blank")]),
                UnpivotRegimes(list(REGIMES), {k: v(n) for k, n in MEASURES.items()}),
                link,
                WithColumn("anno", str(self.year)),
                EnrichWithStaticMapping("regime", {"regime_uri": _coded("regime-", REGIMES, v), "regime_nome": REGIMES}),
                WithColumn("misura", lambda d: last_segment(d["measure_type"])),
                WithColumn("status", lambda d: F.when(d["is_estimated"], STATUS_CODE + "E").otherwise(STATUS_CODE + "A")),
                WithColumn("derived", lambda d: estimated_sources(d, v, ["slug_sede", "anno", "regime"], "regime")),
                self.emit("regime-by-office", "obs-regime-{slug_sede}-{anno}-{regime}-{misura}", {"uri_sede": v("sede"), "anno": (v("annoRiferimento"), GYEAR), "regime_uri": v("regimeLiquidazione")}, measure_type_column="measure_type", value_column="value", status_column="status", provenance_column="derived"),
            ],
            on_error="raise",
        )


def estimated_sources(data: DataFrame, v: Vocabulary, keys: list[str], kind: str) -> Column:
    """The observations an estimate was made from: count and mean; none for published values."""
    stem = F.concat_ws("-", F.lit(f"{v.base}obs-{kind}"), *[data[k].cast("string") for k in keys])
    pair = F.array(F.concat(stem, F.lit("-" + MEASURES["count"])), F.concat(stem, F.lit("-" + MEASURES["mean"])))
    return F.when(data["is_estimated"], pair).otherwise(F.array().cast("array<string>"))


@dataclass
class SeriesByOffice(_CubeRecipe):
    """Cube 3: office x year x management x measure; Sardinian offices before 2012 are estimates too. ``sidecar`` and ``residences`` as for cube 2."""

    sidecar: str | None = None
    residences: DataFrame | None = None

    def build(self) -> Pipeline:
        v = self.vocabulary
        broken = lambda d: d["slug_sede"].isin(*SARDINIAN_OFFICES) & d["anno"].between(1998, 2011)
        return Pipeline(
            [
                ParseItalianNumbers([c for c in YEARS_COLUMNS if c not in ("sede", "blank")]),
                UnpivotYears({k: v(n) for k, n in MEASURES.items()}),
                LinkOffice("sede", self.dimension, v.base, sidecar_to=self.sidecar, labels=self.residences),
                WithColumn("gestione_uri", v(MANAGEMENTS["TOT"])),
                WithColumn("misura", lambda d: last_segment(d["measure_type"])),
                WithColumn("status", lambda d: F.when(d["is_estimated"] | broken(d), STATUS_CODE + "E").otherwise(STATUS_CODE + "A")),
                WithColumn("derived", lambda d: estimated_sources(d, v, ["slug_sede", "anno"], "serie")),
                self.emit("series-by-office", "obs-serie-{slug_sede}-{anno}-{misura}", {"uri_sede": v("sede"), "anno": (v("annoRiferimento"), GYEAR), "gestione_uri": v("tipoGestione")}, measure_type_column="measure_type", value_column="value", status_column="status", provenance_column="derived"),
            ],
            on_error="raise",
        )


@dataclass
class PublicStartYears(_CubeRecipe):
    """Cube 4: area x start year; the first bucket, all years up to 1980, is an estimate."""

    def build(self) -> Pipeline:
        v = self.vocabulary
        return Pipeline(
            [
                WithColumn("area", v("area-italia")),
                WithColumn("status", lambda d: F.when(d["anno_decorrenza"] == 1980, STATUS_CODE + "E").otherwise(STATUS_CODE + "A")),
                self.emit("public-start-years", "obs-decorrenza-{anno_decorrenza}", {"area": v("area"), "anno_decorrenza": (v("annoDecorrenza"), GYEAR)}, measures={"numero_pensioni": v("numeroPensioni"), "importo_medio": v("importoMedioMensile"), "eta_decorrenza": v("etaMediaDecorrenza")}, status_column="status"),
            ],
            on_error="raise",
        )


@dataclass
class Employment(_CubeRecipe):
    """Cube 5: province x year, thousands of employed persons."""

    triples: DataFrame | None = None

    def build(self) -> Pipeline:
        v = self.vocabulary
        return Pipeline(
            [
                RenameColumns({"TIME_PERIOD": "anno", "Osservazione": "occupati"}),
                CastTypes({"occupati": "float"}, errors="coerce"),
                LinkProvinceByNUTS("REF_AREA", self.dimension, self.triples),
                self.emit("employment", "obs-occupati-{codice_istat}-{anno}", {"uri_agid": v("provincia"), "anno": (v("annoRiferimento"), GYEAR)}, measures={"occupati": v("numeroOccupati")}),
            ],
            on_error="raise",
        )


@dataclass
class Demography(_CubeRecipe):
    """Cube 6: province x year x indicator; union the yearly tables before. ``indicators`` maps codes to (concept, unit), INDICATORS if not given."""

    triples: DataFrame | None = None
    indicators: dict[str, tuple[str, str]] | None = None

    def build(self) -> Pipeline:
        v = self.vocabulary
        table = INDICATORS if self.indicators is None else self.indicators
        return Pipeline(
            [
                RenameColumns({"TIME_PERIOD": "anno", "Osservazione": "valore", "DATA_TYPE": "indicatore"}),
                CastTypes({"valore": "float"}, errors="coerce"),
                EnrichWithStaticMapping("indicatore", {"indicatore_uri": {k: v(c) for k, (c, _) in table.items()}, "unita": {k: u for k, (_, u) in table.items()}}),
                LinkProvinceByNUTS("REF_AREA", self.dimension, self.triples),
                self.emit("demography", "obs-demo-{codice_istat}-{anno}-{indicatore}", {"uri_agid": v("provincia"), "anno": (v("annoRiferimento"), GYEAR), "indicatore_uri": v("indicatore")}, measures={"valore": v("valoreIndicatore")}, attributes={"unita": SDMX + "attribute#unitMeasure"}),
            ],
            on_error="raise",
        )


@dataclass
class Incomes(_CubeRecipe):
    """Cube 7: province x year x income kind, from municipal rows."""

    year: int = 2024

    def build(self) -> Pipeline:
        v = self.vocabulary
        kinds = {k: v(f"reddito-{k}") for k in INCOME_KINDS}
        return Pipeline(
            [
                AggregateIncomesByProvince(kinds),
                LinkProvinceByAcronym("code", self.dimension),
                WithColumn("anno", str(self.year)),
                self.emit("incomes", "obs-redditi-{codice_istat}-{anno}-{kind}", {"uri_agid": v("provincia"), "anno": (v("annoRiferimento"), GYEAR), "uri": v("tipoReddito")}, measures={"freq": v("numeroContribuenti"), "amount": v("ammontareReddito")}),
            ],
            on_error="raise",
        )


@dataclass
class CompositeIndex(_CubeRecipe):
    """Cube 8: province x year x component. ``components`` has istat, d1, d2, d3 (``index_components``)."""

    year: int = 2026
    work_year: int = 2025
    income_year: int = 2024
    components: DataFrame | None = None

    @classmethod
    def from_tables(cls, pensions, employed, incomes, offices, projected, **options) -> CompositeIndex:
        return cls(components=index_components(pensions, employed, incomes, offices, projected), **options)

    def sources(self) -> dict[str, Column]:
        """The observations that each component was made from, and for the mean the three components' own.

        Those of regimes by office are named where ``components`` has ``office_slugs``.
        """
        base, istat, year = self.vocabulary.base, F.col("istat"), self.year
        of = lambda stem, *rest: F.concat(F.lit(f"{base}{stem}-"), istat, F.lit("".join(f"-{x}" for x in rest)))
        total = of("obs-vigenti", year, "TOT")
        d3 = F.array(*[of("obs-vigenti", year, m) for m in ("PRIV", "PUB", "AUTO")], of("obs-planb", year, REGIMES["RETR"]))
        if "office_slugs" in self.components.columns:
            d3 = F.concat(d3, F.transform("office_slugs", lambda x: F.concat(F.lit(f"{base}obs-regime-"), x, F.lit(f"-{year}-RETR-{MEASURES['count']}"))))
        return {
            "d1": F.array(total, of("obs-occupati", self.work_year)),
            "d2": F.array(total, *[of("obs-redditi", self.income_year, k) for k in INCOME_KINDS]),
            "d3": d3,
            "aggregate": F.array(*[of("obs-index", year, d) for d in ("d1", "d2", "d3")]),
        }

    def long(self) -> DataFrame:
        return composite_long(self.components, ["istat"], ["d1", "d2", "d3"], self.sources())

    def build(self) -> Pipeline:
        v = self.vocabulary
        return Pipeline(
            [
                WithColumn("anno", str(self.year)),
                WithColumn("provincia", lambda d: F.concat(F.lit(v.province("")), d["istat"])),
                WithColumn("component_uri", lambda d: F.concat(F.lit(v("componente-")), d["component"])),
                WithColumn("status", STATUS_CODE + "E"),
                self.emit("composite-index", "obs-index-{istat}-{anno}-{component}", {"provincia": v("provincia"), "anno": (v("annoRiferimento"), GYEAR), "component_uri": v("componente")}, measures={"value": v("valoreIndice"), "raw": v("valoreGrezzo")}, status_column="status", provenance_column="sources"),
            ],
            on_error="raise",
        )

    def make(self) -> Dataset:
        return self.apply(Dataset(self.long()))


@dataclass
class ProjectedPublicRegimes(_CubeRecipe):
    """Cube 9: province x year x regime, counts of public pensions split by the national composition."""

    spark: SparkSession | None = None
    start_years_path: str = ""
    year: int = 2026

    def build(self) -> Pipeline:
        v = self.vocabulary
        names = {n: v(f"regime-{n}") for n in REGIMES.values()}
        return Pipeline(
            [
                ProjectRegimes("n_pubblici", self.spark, self.start_years_path),
                WithColumn("anno", str(self.year)),
                EnrichWithStaticMapping("regime_notation", {"regime_uri": names}),
                WithColumn("status", lambda d: F.concat(F.lit(STATUS_CODE), d["_status"])),
                WithColumn("derived", lambda d: F.array(F.concat(F.lit(f"{v.base}obs-vigenti-"), d["codice_istat"], F.lit(f"-{self.year}-PUB")))),
                self.emit("projected-regimes", "obs-planb-{codice_istat}-{anno}-{regime_notation}", {"uri_agid": v("provincia"), "anno": (v("annoRiferimento"), GYEAR), "regime_uri": v("regimeLiquidazione")}, measures={"projected": v("numeroPensioni")}, status_column="status", provenance_column="derived"),
            ],
            on_error="raise",
        )


def public_counts(cube1: DataFrame) -> DataFrame:
    """Public pensions of each province, read back from the table of cube 1."""
    rows = cube1.where((F.col("gestione") == "PUB") & F.col("uri_agid").isNotNull())
    return rows.select("uri_agid", last_segment(F.col("uri_agid")).alias("codice_istat"), F.col("numero").cast("bigint").alias("n_pubblici"))


def without_areas(data: DataFrame, column: str, names: tuple[str, ...]) -> Dataset:
    """Drop the rows of continents and totals."""
    return FilterRows(lambda d: ~d[column].isin(*names)).apply(Dataset(data))
