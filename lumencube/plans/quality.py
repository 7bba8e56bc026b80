"""Data-quality checks: each is a query with an expected value, and a report of outcomes."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.observations import QB, STATUS
from ..sources.turtle import RDF

SKOS = "http://www.w3.org/2004/02/skos/core#"
OWL = "http://www.w3.org/2002/07/owl#"
RDFS = "http://www.w3.org/2000/01/rdf-schema#"
TYPE = RDF + "type"


@dataclass(frozen=True)
class Check:
    """An outcome. ``ok`` is None for a check that had nothing to look at, which is reported apart."""

    name: str
    actual: Any
    expected: Any
    ok: bool | None


def equals(name: str, actual: int, expected: int) -> Check:
    return Check(name, actual, expected, actual == expected)


def at_least(name: str, actual: int, expected: int) -> Check:
    return Check(name, actual, f">= {expected}", actual >= expected)


def of_type(triples: DataFrame, kind: str) -> DataFrame:
    return triples.where((F.col("p") == TYPE) & (F.col("o") == kind)).select("s").distinct()


def type_counts(triples: DataFrame, kinds: Sequence[str]) -> dict[str, int]:
    """Distinct subjects of each class, from one aggregation."""
    rows = triples.where((F.col("p") == TYPE) & F.col("o").isin(*kinds)).groupBy("o").agg(F.count_distinct("s").alias("n")).collect()
    return {k: 0 for k in kinds} | {r.o: r.n for r in rows}


def structures_without(triples: DataFrame, part: str) -> DataFrame:
    """Structure definitions of which no component has the property ``part`` (through blank nodes)."""
    dsd = of_type(triples, QB + "DataStructureDefinition")
    has = triples.where(F.col("p") == QB + "component").select(F.col("s"), F.col("o").alias("c"))
    parts = triples.where(F.col("p") == part).select(F.col("s").alias("c"))
    return dsd.join(has.join(parts, "c", "left_semi").select("s"), "s", "left_anti")


def check_vocabularies(triples: DataFrame, expected: Mapping[str, int], least: Mapping[str, int]) -> list[Check]:
    """Counts of classes (``expected`` exact, ``least`` at least) and the form of structures and properties."""
    counts = type_counts(triples, [*expected, *least])
    out = [equals(f"{k} count", counts[k], n) for k, n in expected.items()]
    out += [at_least(f"{k} count", counts[k], n) for k, n in least.items()]
    for part in (QB + "dimension", QB + "measure"):
        out.append(equals(f"structures without {part}", structures_without(triples, part).count(), 0))
    concept = triples.where((F.col("p") == RDFS + "range") & (F.col("o") == SKOS + "Concept")).select("s")
    coded = triples.where(F.col("p") == QB + "codeList").select("s")
    named = triples.where(F.col("p") == QB + "concept").select("s")
    dimensions, measures = of_type(triples, QB + "DimensionProperty"), of_type(triples, QB + "MeasureProperty")
    out.append(equals("coded dimensions without a code list", dimensions.join(concept, "s", "left_semi").join(coded, "s", "left_anti").count(), 0))
    out.append(equals("measures without a concept", measures.join(named, "s", "left_anti").count(), 0))
    return out


@dataclass(frozen=True)
class CubeSpec:
    """What a cube must have. ``read`` gives its triples, or None if it is absent."""

    name: str
    dataset: str
    structure: str
    rows: int
    dimensions: tuple[str, ...]
    measures: tuple[str, ...]
    least_measures: int = 1
    read: Callable[[], DataFrame | None] = field(default=lambda: None, compare=False)


def check_cube(spec: CubeSpec) -> list[Check]:
    """Dataset and structure, cardinality, dimensions, status, measures: one pass over the cube's observations."""
    triples = spec.read()
    if triples is None:
        return [Check(f"{spec.name}: present", None, None, None)]
    linked = triples.where((F.col("s") == spec.dataset) & (F.col("p") == QB + "structure") & (F.col("o") == spec.structure)).limit(1).count()
    ours = triples.where((F.col("p") == QB + "dataSet") & (F.col("o") == spec.dataset)).select("s").distinct()
    wanted = [*spec.dimensions, STATUS, *spec.measures]
    facts = triples.where(F.col("p").isin(*wanted)).groupBy("s").agg(*[F.max(F.col("p") == p).alias(f"h{k}") for k, p in enumerate(wanted)], F.count_distinct(F.when(F.col("p").isin(*spec.measures), F.col("p"))).alias("m"))
    each = ours.join(facts, "s", "left")
    lacking = [F.count_if(~F.coalesce(f"h{k}", F.lit(False))).alias(f"h{k}") for k in range(len(spec.dimensions) + 1)]
    r = each.agg(F.count(F.lit(1)).alias("n"), *lacking, F.count_if(F.coalesce("m", F.lit(0)) < spec.least_measures).alias("few")).first()
    out = [equals(f"{spec.name}: dataset and structure", linked, 1), equals(f"{spec.name}: observations", r.n, spec.rows)]
    out += [equals(f"{spec.name}: observations without {p}", r[f"h{k}"], 0) for k, p in enumerate(spec.dimensions)]
    out.append(equals(f"{spec.name}: observations without status", r[f"h{len(spec.dimensions)}"], 0))
    out.append(equals(f"{spec.name}: observations with under {spec.least_measures} measures", r.few, 0))
    return out


def check_package(triples: DataFrame, dataset: str, counts: Mapping[str, int]) -> list[Check]:
    """How many values the package's node has for each property."""
    rows = triples.where((F.col("s") == dataset) & F.col("p").isin(*counts)).groupBy("p").agg(F.count_distinct("o").alias("n")).collect()
    got = {r.p: r.n for r in rows}
    return [equals(f"package: {p}", got.get(p, 0), n) for p, n in counts.items()]


def check_territory(dimension: DataFrame, provinces: int, links: int, several: int) -> list[Check]:
    r = dimension.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.char_length("acronym") != 2).alias("odd"), F.sum(F.size("nuts")).alias("links"), F.count_if(F.size("nuts") > 1).alias("several")).first()
    return [equals("provinces", r.n, provinces), equals("acronyms not of 2 letters", r.odd, 0), equals("NUTS links", r.links or 0, links), equals("provinces with several NUTS", r.several, several)]


def conservation(parts: DataFrame, whole: DataFrame, key: Sequence[str], part: str, total: str, tolerance: float = 1.0) -> Check:
    """Sums of parts equal the wholes within ``tolerance``."""
    sums = parts.groupBy(*key).agg(F.sum(part).alias("__sum"))
    gap = whole.join(sums, list(key), "left").agg(F.max(F.abs(F.coalesce("__sum", F.lit(0.0)) - F.col(total)))).first()[0] or 0.0
    return Check("conservation", gap, f"<= {tolerance}", gap <= tolerance)


def report(checks: Sequence[Check]) -> tuple[int, int, int, str]:
    """(passed, failed, skipped, text)."""
    mark = {True: "PASS", False: "FAIL", None: "SKIP"}
    lines = [f"{mark[c.ok]} {c.name}: {c.actual} (expected {c.expected})" for c in checks]
    return sum(c.ok is True for c in checks), sum(c.ok is False for c in checks), sum(c.ok is None for c in checks), "\n".join(lines)
