"""Table functions for SQL: steps with more or fewer rows than their input, with a schema that follows from their arguments.

``register`` makes them known to a session::

    SELECT * FROM paired_unpivot(TABLE(wide), 'sede', 'regime', '{"old": {"n": "n_old"}, "new": {"n": "n_new"}}')
    SELECT * FROM turtle_triples(TABLE(documents), 'name', 'text')
    SELECT * FROM value_runs(TABLE(events), 'user_id', 'ts', 'event_type')

Rows come in the partitions that Spark has, or, for ``value_runs``, in those that the function itself asks for: by key, in order of time.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

from pyspark.sql import Row, SparkSession
from pyspark.sql import types as T
from pyspark.sql.functions import udtf
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult, OrderingColumn, PartitioningColumn, SelectedColumn

from ..sources.turtle import COLUMNS, parse


def _names(argument: AnalyzeArgument, what: str) -> list[str]:
    """The names in a constant text, separated by commas."""
    if argument.value is None or not str(argument.value).strip():
        raise ValueError(f"{what} must be a constant text")
    return [x.strip() for x in str(argument.value).split(",")]


def _fields(table: AnalyzeArgument, names: list[str]) -> list[T.StructField]:
    if not table.isTable:
        raise ValueError("the first argument must be TABLE(...)")
    held = {f.name: f for f in table.dataType.fields}
    if missing := [n for n in names if n not in held]:
        raise ValueError(f"missing columns: {missing}")
    return [T.StructField(n, held[n].dataType) for n in names]


def _distinct(fields: list[T.StructField]) -> T.StructType:
    names = [f.name for f in fields]
    if again := sorted({n for n in names if names.count(n) > 1}):
        raise ValueError(f"duplicate columns: {again}")
    return T.StructType(fields)


@udtf
class PairedUnpivot:
    """Several columns for each group become one column each; see ``operators.reshape.PairedUnpivot``.

    Arguments: the table, the columns to keep, the name of the label column, and the groups as JSON: {group: {new column: old column}}.
    Every group must name the same new columns, whose old columns have one type. Each row gives a row for each group.
    """

    @staticmethod
    def analyze(table: AnalyzeArgument, keep: AnalyzeArgument, label: AnalyzeArgument, groups: AnalyzeArgument) -> AnalyzeResult:
        kept, (name,) = _names(keep, "keep"), _names(label, "label")
        wanted = json.loads(str(groups.value))
        new = list(next(iter(wanted.values()))) if wanted else []
        if not new or any(list(g) != new for g in wanted.values()):
            raise ValueError("every group must name the same new columns")
        made = []
        for column in new:
            kinds = {f.dataType.simpleString(): f.dataType for f in _fields(table, [g[column] for g in wanted.values()])}
            if len(kinds) > 1:
                raise ValueError(f"the columns of {column} differ in type: {sorted(kinds)}")
            made.append(T.StructField(column, next(iter(kinds.values()))))
        schema = _distinct([*_fields(table, kept), T.StructField(name, T.StringType()), *made])
        used = dict.fromkeys([*kept, *(c for g in wanted.values() for c in g.values())])
        return AnalyzeResult(schema, select=[SelectedColumn(f"`{c}`") for c in used])

    def eval(self, row: Row, keep: str, label: str, groups: str) -> Iterator[tuple]:
        if not hasattr(self, "plan"):
            self.kept, self.plan = [x.strip() for x in keep.split(",")], [(g, list(c.values())) for g, c in json.loads(groups).items()]
        own = tuple(row[c] for c in self.kept)
        for group, columns in self.plan:
            yield (*own, group, *(row[c] for c in columns))


@udtf
class TurtleTriples:
    """The triples of Turtle documents, one document a row.

    Arguments: the table, the column of the document's name, after which its blank nodes are named, and the column of its text. A null text has
    no triples; a text that is not Turtle is an error that names the document.
    """

    @staticmethod
    def analyze(table: AnalyzeArgument, name: AnalyzeArgument, text: AnalyzeArgument) -> AnalyzeResult:
        (a,), (b,) = _names(name, "name"), _names(text, "text")
        _fields(table, [a, b])
        schema = T.StructType([T.StructField("document", T.StringType()), *[T.StructField(c, T.StringType()) for c in COLUMNS]])
        return AnalyzeResult(schema, select=[SelectedColumn(f"`{a}`"), SelectedColumn(f"`{b}`")] if a != b else ())

    def eval(self, row: Row, name: str, text: str) -> Iterator[tuple]:
        label, body = row[name], row[text]
        if body is not None:
            for triple in parse(body.removeprefix("﻿"), str(label)):
                yield (label, *triple)


@udtf
class ValueRuns:
    """Stretches of rows of one key, in order of time, that have one value: the key, the value, first, last and n.

    Arguments: the table, and the columns of the key, the time and the value. Rows are partitioned by key and sorted by time, then value, by the function's
    own wish; one stretch is held at a time, whatever the size of a key. Nulls are values like others; a null time comes first.
    """

    @staticmethod
    def analyze(table: AnalyzeArgument, key: AnalyzeArgument, time: AnalyzeArgument, value: AnalyzeArgument) -> AnalyzeResult:
        names = [_names(x, what)[0] for x, what in ((key, "key"), (time, "time"), (value, "value"))]
        k, t, v = _fields(table, names)
        schema = _distinct([k, v, T.StructField("first", t.dataType), T.StructField("last", t.dataType), T.StructField("n", T.LongType())])
        return AnalyzeResult(schema, partitionBy=[PartitioningColumn(f"`{names[0]}`")], orderBy=[OrderingColumn(f"`{names[1]}`", True, True), OrderingColumn(f"`{names[2]}`", True, True)])

    def __init__(self) -> None:
        self.held = None

    def eval(self, row: Row, key: str, time: str, value: str) -> Iterator[tuple]:
        k, t, v = row[key], row[time], row[value]
        if self.held is not None and self.held[1] == v:
            self.held[3:] = [t, self.held[4] + 1]
            return
        if self.held is not None:
            yield tuple(self.held)
        self.held = [k, v, t, t, 1]

    def terminate(self) -> Iterator[tuple]:
        if self.held is not None:
            yield tuple(self.held)


FUNCTIONS = {"paired_unpivot": PairedUnpivot, "turtle_triples": TurtleTriples, "value_runs": ValueRuns}


def register(spark: SparkSession) -> None:
    """Make the table functions known to the session's SQL."""
    for name, function in FUNCTIONS.items():
        spark.udtf.register(name, function)
