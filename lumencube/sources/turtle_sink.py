"""Triples as Turtle files.

Triples are range-partitioned and sorted, so each subject's triples come one after the other; a task streams its range and
writes a document of its own, holding no more than one line. A subject that reaches over two ranges, because it has very many triples, begins again in the
next file, which says the same.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..scratch import distinct, parts
from . import files
from .turtle import COLUMNS, RDF, XSD

#: Prefixes that every document may use.
PREFIXES = {"rdf": RDF, "xsd": XSD, "rdfs": "http://www.w3.org/2000/01/rdf-schema#", "owl": "http://www.w3.org/2002/07/owl#", "skos": "http://www.w3.org/2004/02/skos/core#", "qb": "http://purl.org/linked-data/cube#", "prov": "http://www.w3.org/ns/prov#", "dct": "http://purl.org/dc/terms/"}
_LOCAL = re.compile(r"[A-Za-z0-9_](?:[\w-]*[A-Za-z0-9_])?", re.ASCII)
_PREFIX = re.compile(r"[A-Za-z](?:[\w-]*\w)?", re.ASCII)
_ODD = re.compile(r'[\x00-\x20<>"{}|^`\\]')
_ESCAPES = str.maketrans({"\\": "\\\\", '"': '\\"', "\n": "\\n", "\r": "\\r", "\t": "\\t", "\b": "\\b", "\f": "\\f"})


class Terms:
    """Terms as Turtle says them: prefixed names where a namespace and a plain local name allow it."""

    def __init__(self, prefixes: Mapping[str, str]):
        self.names = {iri: name for name, iri in prefixes.items()}

    def iri(self, value: str) -> str:
        if value.startswith("_:"):
            return value
        cut = max(value.rfind("#"), value.rfind("/")) + 1
        name = self.names.get(value[:cut])
        if name is not None and _LOCAL.fullmatch(value, cut):
            return f"{name}:{value[cut:]}"
        return "<" + _ODD.sub(lambda m: f"\\u{ord(m[0]):04X}", value) + ">"

    def verb(self, value: str) -> str:
        return "a" if value == RDF + "type" else self.iri(value)

    def object(self, value: str, kind: str, datatype: str | None, lang: str | None) -> str:
        if kind != "literal":
            return self.iri(value)
        text = f'"{value.translate(_ESCAPES)}"'
        if lang:
            return f"{text}@{lang}"
        return text if datatype in (None, XSD + "string") else f"{text}^^{self.iri(datatype)}"


def turtle_lines(triples: DataFrame, prefixes: Mapping[str, str] | None = None) -> DataFrame:
    """Turtle in lines (column ``value``); each partition is a document. Rows with a null subject, predicate or object are left out; each triple comes once."""
    prefixes = PREFIXES | dict(prefixes or {})
    if odd := [p for p in prefixes if not _PREFIX.fullmatch(p)]:
        raise ValueError(f"not prefixes: {odd}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, subject, verb, open_line = Terms(prefixes), None, None, None
        for batch in batches:
            lines = []
            for s, p, *o in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if open_line is None:
                    lines += [f"@prefix {name}: <{iri}> ." for name, iri in sorted(prefixes.items())]
                said = terms.object(*o)
                if s == subject and p == verb:
                    end, new = " ,", f"        {said}"
                elif s == subject:
                    end, new = " ;", f"    {terms.verb(p)} {said}"
                else:
                    end, new = " .", f"{terms.iri(s)} {terms.verb(p)} {said}"
                if open_line is not None:
                    lines.append(open_line + end)
                subject, verb, open_line = s, p, new
            yield pa.RecordBatch.from_arrays([pa.array(lines, pa.string())], names=["value"])
        if open_line is not None:
            yield pa.RecordBatch.from_arrays([pa.array([open_line + " ."])], names=["value"])

    rows = triples.select(*COLUMNS).where(F.col("s").isNotNull() & F.col("p").isNotNull() & F.col("o").isNotNull())
    n = parts(rows)  # documents of so few triples that a reader can hold one
    ordered = distinct(rows, n).repartitionByRange(n, *COLUMNS).sortWithinPartitions(*COLUMNS)
    return ordered.mapInArrow(run, "value string")


def write_turtle(triples: DataFrame, path: str, prefixes: Mapping[str, str] | None = None) -> None:
    """A folder of Turtle files, whose union is the set of ``triples``; blank nodes keep their labels, which hold over all the files."""
    spark = triples.sparkSession
    turtle_lines(triples, prefixes).write.mode("overwrite").text(path)
    for name in files.names(spark, path):  # one for each range
        if name.endswith(".txt"):
            files.rename(spark, f"{path}/{name}", f"{path}/{name[:-4]}.ttl")
