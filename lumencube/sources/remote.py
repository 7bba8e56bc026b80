"""Sources over HTTP: a query endpoint as a Spark data source, and files fetched once."""

from __future__ import annotations

import http.client
import json
import os
import re
import time
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition, IsNotNull, IsNull

TIMEOUT, ATTEMPTS = 30, 4


def bindings(answer: dict, columns: list[str]) -> Iterator[tuple]:
    """Rows of a SPARQL JSON answer; unbound variables are null."""
    for row in answer["results"]["bindings"]:
        yield tuple(row[c]["value"] if c in row else None for c in columns)


def ask(endpoint: str, query: str, timeout: float = TIMEOUT, attempts: int = ATTEMPTS, wait: float = 0.5) -> dict:
    """The JSON answer to a query. Time-outs, lost connections and the answers 429 and 5xx are tried again, each time after twice the wait."""
    data = urllib.parse.urlencode({"query": query}).encode()
    for attempt in range(attempts):
        request = urllib.request.Request(endpoint, data, {"Accept": "application/sparql-results+json"})
        try:
            with urllib.request.urlopen(request, timeout=timeout) as reply:
                return json.load(reply)
        except urllib.error.HTTPError as error:
            if attempt == attempts - 1 or not (error.code == 429 or error.code >= 500):
                raise
        except (OSError, http.client.HTTPException, json.JSONDecodeError):
            if attempt == attempts - 1:
                raise
        time.sleep(wait * 2**attempt)
    raise ValueError("attempts must be positive")


_PROLOGUE = re.compile(r"\s*(?:(?:PREFIX\s+\S*\s*|BASE\s*)<[^>]*>\s*)*", re.IGNORECASE)


def _text(value: str) -> str:
    return json.dumps(value, ensure_ascii=False)  # the escapes of JSON are escapes there too


def filtered(query: str, conditions: list[str]) -> tuple[str, str]:
    """The query's prologue, and a pattern with its rows for which the conditions hold."""
    head = _PROLOGUE.match(query)[0]
    tests = "".join(f" FILTER({c})" for c in conditions)
    return head, f"{{ {{ {query[len(head):]} }}{tests} }}"


class _Page(InputPartition):
    def __init__(self, offset: int, rows: int):
        super().__init__(offset)
        self.offset, self.rows = offset, rows


class _Reader(DataSourceReader):
    """Without ``page`` one task reads one answer. With it the rows are counted once, and each task asks for a page of a fixed order."""

    def __init__(self, options: dict, columns: list[str]):
        self.options, self.columns, self.conditions = options, columns, []
        self.page = int(options.get("page", 0))

    def _ask(self, query: str) -> dict:
        o = self.options
        return ask(o["endpoint"], query, float(o.get("timeout", TIMEOUT)), int(o.get("attempts", ATTEMPTS)), float(o.get("wait", 0.5)))

    def _condition(self, f: Filter) -> str | None:
        name = f.attribute[0] if getattr(f, "attribute", None) and len(f.attribute) == 1 else None
        if name not in self.columns or not re.fullmatch(r"\w+", name):
            return None
        if isinstance(f, IsNotNull):
            return f"BOUND(?{name})"
        if isinstance(f, IsNull):
            return f"!BOUND(?{name})"
        if isinstance(f, EqualTo) and isinstance(f.value, str):
            return f"STR(?{name}) = {_text(f.value)}"
        if isinstance(f, In) and f.value and all(isinstance(v, str) for v in f.value):
            return f"STR(?{name}) IN ({', '.join(map(_text, f.value))})"
        return None

    def partitions(self) -> list[InputPartition]:
        if not self.page:
            return [_Page(0, -1)]
        head, where = filtered(self.options["query"], self.conditions)
        n = int(self._ask(f"{head}SELECT (COUNT(*) AS ?n) WHERE {where}")["results"]["bindings"][0]["n"]["value"])
        return [_Page(at, min(self.page, n - at)) for at in range(0, n, self.page)] or [_Page(0, 0)]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        if not self.page and not self.conditions:
            yield from bindings(self._ask(self.options["query"]), self.columns)
            return
        if partition.rows == 0:
            return
        head, where = filtered(self.options["query"], self.conditions)
        order = self.options.get("order") or " ".join(f"?{c}" for c in self.columns)
        limit = f" ORDER BY {order} LIMIT {partition.rows} OFFSET {partition.offset}" if self.page else ""
        rows = list(bindings(self._ask(f"{head}SELECT {' '.join(f'?{c}' for c in self.columns)} WHERE {where}{limit}"), self.columns))
        if self.page and len(rows) != partition.rows:
            raise OSError(f"the page at {partition.offset} has {len(rows)} rows, not {partition.rows}: the data changed, or the endpoint gives fewer at once")
        yield from rows


class _FilteringReader(_Reader):
    """A reader that takes filters, which Spark allows only where the session pushes them."""

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:  # noqa: N802
        """Equality, membership and (not) null of a column go into the query; the others are left to Spark."""
        for f in filters:
            said = self._condition(f)
            if said is None:
                yield f
            else:
                self.conditions.append(said)


class EndpointSource(DataSource):
    """``spark.read.format("endpoint").schema(...).options(endpoint=..., query=...)``: all columns are text.

    ``page`` is how many rows a task asks for at once; the query must then have no LIMIT of its own. ``order`` are the variables that fix the order
    (all columns by default), which should tell rows apart.
    """

    @classmethod
    def name(cls) -> str:
        return "endpoint"

    def schema(self) -> str:
        return self.options["columns"]

    def reader(self, schema) -> DataSourceReader:
        kind = _FilteringReader if self.options.get("push") == "true" else _Reader
        return kind(dict(self.options), schema.fieldNames())


def read_endpoint(spark: SparkSession, endpoint: str, query: str, columns: list[str], timeout: float = TIMEOUT, page: int | None = None, order: str | None = None, attempts: int = ATTEMPTS, wait: float = 0.5) -> DataFrame:
    """The rows of a query, in one task or, with ``page``, in a task for each page. Filters on columns go to the endpoint where the
    session has ``spark.sql.python.filterPushdown.enabled``."""
    spark.dataSource.register(EndpointSource)
    schema = ", ".join(f"`{c}` string" for c in columns)
    more = {k: str(v) for k, v in (("page", page), ("order", order), ("push", spark.conf.get("spark.sql.python.filterPushdown.enabled", "false"))) if v}
    return spark.read.format("endpoint").options(endpoint=endpoint, query=query, timeout=str(timeout), columns=schema, attempts=str(attempts), wait=str(wait), **more).load()


def fetch_if_absent(address: str, path: str) -> str:
    if not os.path.exists(path):
        os.makedirs(os.path.dirname(os.path.abspath(path)), exist_ok=True)
        with urllib.request.urlopen(address, timeout=TIMEOUT) as reply, open(path, "wb") as out:
            out.write(reply.read())
    return path
