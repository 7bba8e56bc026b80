"""Sinks: tables with a history sidecar, triples, and a store of named graphs."""

from __future__ import annotations

import json
import os
import shutil
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..core import Dataset
from . import files
from .turtle import COLUMNS, n_triples
from .versions import Conflict, Versions

FORMATS = ("csv", "parquet", "json")


def write_csv(data: DataFrame, path: str, header: bool = True, sep: str = ",", **options) -> None:
    """A folder of CSV parts with headers; arrays as JSON text."""
    flat = data.withColumns({c: F.to_json(c) for c, kind in data.dtypes if kind.startswith(("array", "struct", "map"))})
    flat.write.mode("overwrite").option("header", header).option("sep", sep).options(**options).csv(path)


def _format(path: str, format: str | None) -> str:
    found = (format or os.path.splitext(path)[1].lstrip(".")).lower()
    if not found:
        raise ValueError(f"no format given and none in {path!r}")
    if found not in FORMATS:
        raise ValueError(f"unsupported format {found!r}; one of {FORMATS}")
    return found


def save_dataset(dataset: Dataset, path: str, *, format: str | None = None, save_history: bool = False, single_file: bool = False, **options) -> str:
    """Write a dataset as csv, parquet or json (by ``format`` or the path's suffix) and return the path.

    The result is a folder of parts. ``single_file`` makes one local file instead, through one task:
    JSON is then an array of records with indent 2. ``save_history`` adds ``<stem>.history.json``.
    """
    kind = _format(path, format)
    if "://" not in path:
        os.makedirs(os.path.dirname(os.path.abspath(path)), exist_ok=True)
    if single_file:
        _single(dataset.data, path, kind, options)
    elif kind == "csv":
        write_csv(dataset.data, path, **options)
    else:
        dataset.data.write.mode("overwrite").options(**options).format(kind).save(path)
    if save_history:
        write_history(dataset, path)
    return path


def _single(data: DataFrame, path: str, kind: str, options: dict) -> None:
    if kind == "json":
        with open(path, "w", encoding="utf-8") as out:
            end = ""
            out.write("[")
            for line in data.coalesce(1).toJSON().toLocalIterator():  # row by row
                row = json.loads(line)
                text = json.dumps({c: row.get(c) for c in data.columns}, indent=2, ensure_ascii=False)
                out.write(("," if end else "") + "\n" + "\n".join("  " + x for x in text.split("\n")))
                end = "\n"
            out.write(end + "]")
        return
    parts = f"{path}.parts"
    if kind == "csv":
        write_csv(data.coalesce(1), parts, **options)
    else:
        data.coalesce(1).write.mode("overwrite").options(**options).parquet(parts)
    (part,) = [x for x in os.listdir(parts) if x.startswith("part-")]
    shutil.move(f"{parts}/{part}", path)
    shutil.rmtree(parts)


def write_history(dataset: Dataset, path: str) -> str:
    """The sidecar, wherever Spark can write: when, what file, its shape and columns, and each step with parameters and metrics."""
    rows, cols = dataset.shape
    body = {
        "saved_at": datetime.now(UTC).isoformat(),
        "data_file": os.path.basename(path),
        "rows": rows,
        "cols": cols,
        "columns": dataset.columns,
        "steps": [{"name": r.name, "params": dict(r.params), "metrics": r.metrics} for r in dataset.history],
    }
    place = f"{os.path.splitext(path)[0]}.history.json"
    files.write_text(dataset.data.sparkSession, place, json.dumps(body, indent=2, ensure_ascii=False, default=str))
    return place


def write_triples(triples: DataFrame, path: str) -> None:
    """N-Triples text, each triple once."""
    n_triples(triples.dropDuplicates(COLUMNS)).write.mode("overwrite").text(path)


class GraphStore:
    """Named graphs with a version for each change. Reading without a graph gives the union of all.

    A reader sees one version whole, also while a writer replaces a graph; older versions can be read until ``vacuum``. A writer
    whose graph another has changed meanwhile gets ``Conflict``; changes of other graphs are taken over.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self.versions = Versions(spark, path, lambda content: {f for folders in content.values() for f in folders})

    def put(self, graph: str, triples: DataFrame, base: int | None = None) -> int:
        """Replace one graph; the others stay. ``base`` is the version that the writer has seen, the newest by default. Returns the new version."""
        base = self.versions.latest() if base is None else base
        return self._publish(base, graph, [self.versions.write(triples.select(*COLUMNS).dropDuplicates())])

    def post(self, graph: str, triples: DataFrame, base: int | None = None) -> int:
        """Add to a graph what it doesn't have yet. Returns the new version."""
        base = self.versions.latest() if base is None else base
        own = self.versions.content(base).get(graph, [])
        new = triples.select(*COLUMNS).dropDuplicates()
        if own:
            new = _minus(new, self._rows(own))
        return self._publish(base, graph, [*own, self.versions.write(new)])

    def drop(self, graph: str, base: int | None = None) -> int:
        """Remove a graph. Returns the new version."""
        base = self.versions.latest() if base is None else base
        if graph not in self.versions.content(base):
            raise KeyError(f"no graph {graph!r}")
        return self._publish(base, graph, None)

    def _publish(self, base: int, graph: str, folders: list[str] | None) -> int:
        seen = self.versions.content(base)
        while True:
            now = self.versions.content(base)
            if now.get(graph) != seen.get(graph):
                raise Conflict(f"another writer has changed the graph {graph!r}")
            rest = {g: f for g, f in now.items() if g != graph}
            try:
                return self.versions.publish(base, rest if folders is None else rest | {graph: folders})
            except Conflict:
                base += 1  # someone was faster: look at what that version did

    def _rows(self, folders: list[str]) -> DataFrame:
        schema = ", ".join(f"{c} string" for c in COLUMNS)
        return self.spark.read.schema(schema).parquet(*[self.versions.place(f) for f in folders]) if folders else self.spark.createDataFrame([], schema)

    def read(self, graph: str | None = None, version: int | None = None) -> DataFrame:
        content = self.versions.content(version)
        if graph is not None:
            return self._rows(content.get(graph, []))
        return self._rows([f for folders in content.values() for f in folders]).dropDuplicates()

    def graphs(self, version: int | None = None) -> list[str]:
        return sorted(self.versions.content(version))


def _minus(new: DataFrame, old: DataFrame) -> DataFrame:
    """Rows of ``new`` that ``old`` lacks; nulls equal nulls."""
    old = old.select(*[F.col(c).alias(f"_{c}") for c in COLUMNS])
    same = [new[c].eqNullSafe(old[f"_{c}"]) for c in COLUMNS]
    return new.join(old, same, "left_anti")


def rewrite_namespace(triples: DataFrame, old: str, new: str, dry_run: bool = False) -> tuple[DataFrame, int]:
    """Replace a namespace (with its trailing slash) wherever it stands; the frame and the number of places."""
    old, new = old.rstrip("/") + "/", new.rstrip("/") + "/"
    places = ["s", "p", "o", "datatype"]
    hits = sum(((F.char_length(F.coalesce(c, F.lit(""))) - F.char_length(F.replace(F.coalesce(c, F.lit("")), F.lit(old), F.lit("")))) / len(old) for c in map(F.col, places)), F.lit(0))
    count = int(triples.agg(F.sum(hits)).first()[0] or 0)
    if dry_run:
        return triples, count
    return triples.withColumns({c: F.replace(F.col(c), F.lit(old), F.lit(new)) for c in places}), count
