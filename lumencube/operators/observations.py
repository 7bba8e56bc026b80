"""Observations of a data cube as triples."""

from __future__ import annotations

import re
import string
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..core import Dataset, Measured, PipelineStep, need
from ..sources.turtle import COLUMNS, RDF, XSD

QB = "http://purl.org/linked-data/cube#"
DCT = "http://purl.org/dc/terms/"
SDMX = "http://purl.org/linked-data/sdmx/2009/"
PROV = "http://www.w3.org/ns/prov#"
STATUS = SDMX + "attribute#obsStatus"
STATUS_CODE = SDMX + "code#obsStatus-"
METADATA = {k: DCT + k for k in ("title", "description", "publisher", "license", "issued", "source", "rights")}


def _null() -> Column:
    return F.lit(None).cast("string")


def node(p: Column | str, o: Column, kind: Column | str, datatype: Column | None = None, lang: Column | None = None) -> Column:
    lit = lambda x: x if isinstance(x, Column) else F.lit(x)
    return F.struct(lit(p).alias("p"), o.alias("o"), lit(kind).alias("o_kind"), (datatype if datatype is not None else _null()).alias("datatype"), (lang if lang is not None else _null()).alias("lang"))


def value_node(p: str, c: Column, datatype: str | None = None) -> Column:
    """An IRI if the text is an http(s) address, else a literal of the type (text if none)."""
    iri = c.rlike("^https?://") & (F.lit(datatype is None))
    return node(p, c, F.when(iri, "iri").otherwise("literal"), F.when(~iri, F.lit(datatype or XSD + "string")))


def measure_node(p: Column | str, c: Column, kind: str) -> Column:
    """Literal by value: booleans; whole numbers from 0 are nonNegativeInteger; negative integers integer; other floats decimal."""
    if kind == "boolean":
        return node(p, c.cast("string"), "literal", F.lit(XSD + "boolean"))
    if kind in ("float", "double") or kind.startswith("decimal"):
        whole = (c == F.floor(c)) & (c >= 0) & (c < 1e18)
        text = F.when(whole, F.when(whole, c).cast("bigint").cast("string")).otherwise(c.cast("string"))
        return node(p, text, "literal", F.when(whole, XSD + "nonNegativeInteger").otherwise(XSD + "decimal"))
    if kind in ("tinyint", "smallint", "int", "bigint"):
        return node(p, c.cast("string"), "literal", F.when(c >= 0, XSD + "nonNegativeInteger").otherwise(XSD + "integer"))
    return value_node(p, c.cast("string"))


def constant_node(p: str, text: str) -> Column:
    """A constant written as ``"v"^^xsd:t``, ``"v"@lang``, an address or plain text."""
    if m := re.fullmatch(r'"(.*)"\^\^(?:xsd:(\w+)|<([^>]+)>)', text, re.DOTALL):
        return node(p, F.lit(m[1]), "literal", F.lit(XSD + m[2] if m[2] else m[3]))
    if m := re.fullmatch(r'"(.*)"@([A-Za-z-]+)', text, re.DOTALL):
        return node(p, F.lit(m[1]), "literal", None, F.lit(m[2]))
    return value_node(p, F.lit(text))


def template_column(template: str, columns: Sequence[str]) -> Column:
    """``"...{a}-{b}"`` as an expression; KeyError for unknown fields, found when the plan is built."""
    parts = []
    for text, name, _, _ in string.Formatter().parse(template):
        if text:
            parts.append(F.lit(text))
        if name is not None:
            if name not in columns:
                raise KeyError(f"unknown field {name!r} in {template!r}")
            parts.append(F.col(f"`{name}`").cast("string"))
    return F.concat(*parts)


class EmitObservations(PipelineStep):
    """Triples of the dataset's node and of an observation for each row.

    ``dimensions`` maps a column to a property or (property, type). Either ``measures`` maps columns to
    properties, or ``measure_type_column`` (a property's IRI) and ``value_column`` give one measure
    a row. Rows lacking a dimension are not emitted and keep a null ``_obs_uri``. The triples are in
    ``triples`` of the step after ``apply`` and are written to ``output`` if given; equal observation
    IRIs merge. Texts of ``metadata`` are in ``language``, unless they are written as ``"text"@lang``.
    """

    def __init__(
        self,
        dataset_uri: str,
        structure_uri: str,
        uri_template: str,
        dimensions: Mapping[str, str | tuple[str, str]],
        measures: Mapping[str, str] | None = None,
        measure_type_column: str | None = None,
        value_column: str | None = None,
        constants: Mapping[str, str] | None = None,
        status_column: str | None = None,
        status: str = "A",
        provenance_column: str | None = None,
        attributes: Mapping[str, str] | None = None,
        metadata: Mapping[str, str] | None = None,
        dataset_attributes: Mapping[str, str] | None = None,
        output: str | None = None,
        language: str = "it",
    ):
        super().__init__()
        self.language = language
        if (measure_type_column is None) != (value_column is None):
            raise ValueError("measure_type_column and value_column go together")
        if not measures and value_column is None:
            raise ValueError("no measures")
        self.dataset_uri, self.structure_uri, self.template = dataset_uri, structure_uri, uri_template
        self.dimensions = {c: d if isinstance(d, tuple) else (d, None) for c, d in dimensions.items()}
        self.measures, self.type_column, self.value_column = dict(measures or {}), measure_type_column, value_column
        self.constants, self.status_column, self.status = dict(constants or {}), status_column, status
        self.provenance_column, self.attributes = provenance_column, dict(attributes or {})
        self.metadata, self.dataset_attributes, self.output = dict(metadata or {}), dict(dataset_attributes or {}), output
        self.triples: DataFrame | None = None

    def _columns(self) -> list[str]:
        some = [self.type_column, self.value_column, self.status_column, self.provenance_column]
        return [*self.dimensions, *self.measures, *self.attributes, *[c for c in some if c]]

    def header(self, spark) -> DataFrame:
        items = [node(RDF + "type", F.lit(QB + "DataSet"), "iri"), node(QB + "structure", F.lit(self.structure_uri), "iri")]
        for key, value in self.metadata.items():
            p = METADATA.get(key, key)
            if value.startswith(("http://", "https://")):
                items.append(node(p, F.lit(value), "iri"))
            elif key == "issued":
                items.append(node(p, F.lit(value), "literal", F.lit(XSD + "date")))
            else:
                items.append(constant_node(p, value) if re.fullmatch(r'".*"@[A-Za-z-]+', value, re.DOTALL) else node(p, F.lit(value), "literal", None, F.lit(self.language)))
        items += [constant_node(p, v) for p, v in self.dataset_attributes.items()]
        one = spark.range(1).select(F.lit(self.dataset_uri).alias("s"), F.explode(F.array(*items)).alias("x"))
        return one.select("s", "x.*")

    def observations(self, data: DataFrame) -> DataFrame:
        """(s, p, o, o_kind, datatype, lang) of the rows with an ``_obs_uri``, in one pass."""
        kinds = dict(data.dtypes)
        items = [node(RDF + "type", F.lit(QB + "Observation"), "iri"), node(QB + "dataSet", F.lit(self.dataset_uri), "iri")]
        items += [value_node(p, data[c].cast("string"), kind) for c, (p, kind) in self.dimensions.items()]
        items += [constant_node(p, v) for p, v in self.constants.items()]
        if self.value_column:
            both = data[self.value_column].isNotNull() & data[self.type_column].isNotNull()
            made = measure_node(data[self.type_column], data[self.value_column], kinds[self.value_column])
            items += [F.when(both, made), F.when(both, node(QB + "measureType", data[self.type_column], "iri"))]
        items += [measure_node(p, data[c], kinds[c]) for c, p in self.measures.items()]
        default = F.lit(STATUS_CODE + self.status)
        items.append(node(STATUS, F.coalesce(data[self.status_column], default) if self.status_column else default, "iri"))
        items += [measure_node(p, data[c], kinds[c]) for c, p in self.attributes.items()]
        every = F.array(*items)
        if self.provenance_column:
            c = data[self.provenance_column]
            listed = c if kinds[self.provenance_column].startswith("array") else F.when(c.isNotNull(), F.array(c)).otherwise(F.array().cast("array<string>"))
            every = F.concat(every, F.transform(F.coalesce(listed, F.array().cast("array<string>")), lambda x: node(PROV + "wasDerivedFrom", x, "iri")))
        rows = data.where(data["_obs_uri"].isNotNull()).select(F.col("_obs_uri").alias("s"), F.explode(F.filter(every, lambda x: x.isNotNull() & x["o"].isNotNull())).alias("x"))
        return rows.select("s", "x.*")

    def apply(self, dataset: Dataset) -> Dataset:
        d = dataset.data
        need(d, self._columns())
        whole = F.lit(True)
        for c in self.dimensions:
            whole = whole & d[c].isNotNull()
        counted = Measured(dataset)
        out = counted.on(d.withColumn("_obs_uri", F.when(whole, template_column(self.template, d.columns))), n=F.count(F.lit(1)), hit=F.count("_obs_uri"))
        self.triples = self.header(d.sparkSession).unionByName(self.observations(out)).select(*COLUMNS).dropDuplicates(COLUMNS)
        triples = self.triples
        if self.output:
            from ..sources.sinks import write_triples

            write_triples(triples, self.output)

        def say(m: dict[str, Any]) -> dict[str, Any]:
            return {"input_rows": m["n"], "observations_emitted": m["hit"], "rows_skipped_missing_dimension": m["n"] - m["hit"], "triples_written": triples.count()}

        return self.done(dataset, out, {"dataset": self.dataset_uri}, counted.metrics(out, say))
