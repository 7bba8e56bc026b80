"""Steps on columns as a whole: names, types, missing values, keys, lookups by constant tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..core import ColumnStep, Dataset, PipelineStep, distinct_names, need, renamed
from ..functions.numbers import NO_NUMBER, italian_number, java_pattern, to_number
from ..functions.text import normalize_text, snake_case, strip, strip_accents, title_case
from .quantiles import exact_quantiles

NUMERIC = ("tinyint", "smallint", "int", "bigint", "float", "double", "decimal")


#: How many values a metric lists at most, the first in order.
LISTED = 1000


def is_numeric(kind: str) -> bool:
    return kind.startswith(NUMERIC)


class NormalizeColumnNames(PipelineStep):
    """All names to snake_case; ValueError if two become one."""

    def apply(self, dataset: Dataset) -> Dataset:
        names = {c: snake_case(c) for c in dataset.columns}
        changed = {a: b for a, b in names.items() if a != b}
        return self.done(dataset, dataset.data.toDF(*distinct_names([names[c] for c in dataset.columns])), measure={"renamed_count": len(changed), "renamed": changed})


class RenameColumns(PipelineStep):
    """Rename by a mapping, at once; KeyError for missing names, ValueError if a new name is taken by a column that stays."""

    def __init__(self, mapping: Mapping[str, str]):
        super().__init__()
        self.mapping = dict(mapping)

    def apply(self, dataset: Dataset) -> Dataset:
        need(dataset.data, self.mapping)
        taken = [b for b in self.mapping.values() if b in dataset.columns and b not in self.mapping]
        if taken:
            raise ValueError(f"columns exist already: {taken}")
        return self.done(dataset, renamed(dataset.data, self.mapping), {"mapping": self.mapping})


class DropColumns(PipelineStep):
    def __init__(self, columns: Sequence[str]):
        super().__init__()
        self.columns = list(columns)

    def apply(self, dataset: Dataset) -> Dataset:
        need(dataset.data, self.columns)
        return self.done(dataset, dataset.data.drop(*self.columns), {"columns": self.columns})


class DropEmptyColumns(PipelineStep):
    """Drop columns without a value: all of them if there are no rows. One aggregation finds them."""

    def apply(self, dataset: Dataset) -> Dataset:
        names = dataset.columns
        counts = dataset.data.agg(*[F.count(dataset.data[c]).alias(f"c{k}") for k, c in enumerate(names)]).first()
        empty = [c for k, c in enumerate(names) if not counts[f"c{k}"]]
        return self.done(dataset, dataset.data.drop(*empty), measure={"dropped": empty})


class CastTypes(PipelineStep):
    """Cast columns to int, float, str, bool (Int64 and Float64 are int and float).

    ``errors="raise"``: text that is no number fails when the data are read. ``"coerce"``: it becomes
    null; only for numbers. int is a nullable bigint, fractions truncated. str keeps nulls. bool of
    text is whether it is not empty, so "0" is true.
    """

    KINDS = {"int": "bigint", "Int64": "bigint", "float": "double", "Float64": "double", "str": "string", "bool": "boolean"}

    def __init__(self, mapping: Mapping[str, str], errors: str = "raise"):
        super().__init__()
        if errors not in ("raise", "coerce"):
            raise ValueError("errors must be raise or coerce")
        if unknown := sorted(set(mapping.values()) - set(self.KINDS)):
            raise ValueError(f"unknown types: {unknown}")
        self.mapping, self.errors = dict(mapping), errors

    def _cast(self, column: Column, kind: str, to: str) -> Column:
        target = self.KINDS[to]
        if target == "boolean" and kind == "string":
            return F.char_length(column) > 0
        if target in ("bigint", "double") and self.errors == "coerce":
            number = column.cast("double") if is_numeric(kind) or kind == "boolean" else to_number(column)
            return F.nanvl(number, F.lit(None)).try_cast(target)
        return strip(column).cast(target) if kind == "string" and target != "string" else column.cast(target)

    def apply(self, dataset: Dataset) -> Dataset:
        need(dataset.data, self.mapping)
        kinds = dict(dataset.data.dtypes)
        made = {c: self._cast(dataset.data[c], kinds[c], to) for c, to in self.mapping.items()}
        return self.done(dataset, dataset.data.withColumns(made), {"mapping": self.mapping, "errors": self.errors})


class ParseDates(PipelineStep):
    """Text to timestamps without zone, by a strftime format or ISO; ``coerce`` makes other text null."""

    def __init__(self, columns: str | Sequence[str], format: str | None = None, errors: str = "raise"):
        super().__init__()
        if errors not in ("raise", "coerce"):
            raise ValueError("errors must be raise or coerce")
        self.columns = [columns] if isinstance(columns, str) else list(columns)
        self.format, self.errors = format, errors
        self.pattern = java_pattern(format) if format else None

    def apply(self, dataset: Dataset) -> Dataset:
        need(dataset.data, self.columns)
        parse = F.try_to_timestamp if self.errors == "coerce" else F.to_timestamp
        made = {}
        for c in self.columns:
            column = dataset.data[c]
            parsed = parse(column, F.lit(self.pattern)) if self.pattern and self.errors == "coerce" else parse(column, self.pattern) if self.pattern else parse(column)
            made[c] = parsed.cast("timestamp_ntz")
        return self.done(dataset, dataset.data.withColumns(made), {"columns": self.columns, "format": self.format, "errors": self.errors})


class FillMissing(PipelineStep):
    """Fill nulls and NaN with each column's mean, from one aggregation for all columns, or its exact median, or a constant."""

    def __init__(self, columns: Sequence[str] | str, strategy: str = "mean", value: Any = None):
        super().__init__()
        if strategy not in ("mean", "median", "constant"):
            raise ValueError(f"unknown strategy {strategy!r}")
        if strategy == "constant" and value is None:
            raise ValueError("a constant needs a value")
        self.columns = [columns] if isinstance(columns, str) else list(columns)
        self.strategy, self.value = strategy, value

    def apply(self, dataset: Dataset) -> Dataset:
        data = dataset.data
        need(data, self.columns)
        kinds = dict(data.dtypes)
        known = {c: F.nanvl(data[c], F.lit(None)) if kinds[c] in ("double", "float") else data[c] for c in self.columns}
        means = [F.avg(known[c]).alias(f"v{k}") for k, c in enumerate(self.columns) if self.strategy == "mean"]
        row = data.agg(*[F.count(known[c]).alias(f"n{k}") for k, c in enumerate(self.columns)], F.count(F.lit(1)).alias("n"), *means).first()
        made, filled = {}, {}
        for k, c in enumerate(self.columns):
            value = row[f"v{k}"] if means else self.value if self.strategy == "constant" else (exact_quantiles(data, known[c], [0.5]) or [None])[0]
            made[c] = known[c] if value is None else F.coalesce(known[c].cast("double") if self.strategy != "constant" and is_numeric(kinds[c]) else known[c], F.lit(value))
            filled[c] = row["n"] - row[f"n{k}"]
        return self.done(dataset, data.withColumns(made), {"columns": self.columns, "strategy": self.strategy, "value": self.value}, {"filled_per_column": filled})


class AddNormalizedKey(PipelineStep):
    """A new column with the normalized text of another."""

    def __init__(self, source: str, target: str):
        super().__init__()
        self.source, self.target = source, target

    def apply(self, dataset: Dataset) -> Dataset:
        need(dataset.data, [self.source])
        return self.done(dataset, dataset.data.withColumn(self.target, normalize_text(dataset.data[self.source].cast("string"))), {"source": self.source, "target": self.target})


class EnrichWithStaticMapping(PipelineStep):
    """New columns looked up in constant dictionaries, one for each target.

    Values in none of the dictionaries raise a ValueError with the first ten, unless
    ``raise_on_unmatched`` is False; gaps in some of them are null.
    """

    def __init__(self, source: str, mappings: Mapping[str, Mapping[Any, Any]], raise_on_unmatched: bool = True):
        super().__init__()
        self.source, self.mappings, self.raise_on_unmatched = source, {k: dict(v) for k, v in mappings.items()}, raise_on_unmatched

    def _table(self, data: DataFrame) -> DataFrame:
        keys = sorted({str(k) for m in self.mappings.values() for k in m})
        text = {t: {str(k): v for k, v in m.items()} for t, m in self.mappings.items()}
        kinds = {t: next((type(v) for v in m.values() if v is not None), str) for t, m in text.items()}
        names = {int: "bigint", float: "double", bool: "boolean"}
        schema = ", ".join(["`__key` string", *(f"`{t}` {names.get(kinds[t], 'string')}" for t in text)])
        return data.sparkSession.createDataFrame([(k, *(m.get(k) for m in text.values())) for k in keys], schema)

    def apply(self, dataset: Dataset) -> Dataset:
        data = dataset.data
        need(data, [self.source])
        table, key = self._table(data), data[self.source].cast("string")
        values = data.select(key.alias("v")).where(F.col("v").isNotNull()).distinct()
        missing = values.join(F.broadcast(table), values.v == table["__key"], "left_anti")  # the dictionaries are constants of the program
        if self.raise_on_unmatched and (found := [r.v for r in missing.orderBy("v").limit(10).collect()]):
            raise ValueError(f"values of {self.source!r} without a mapping: {found}")
        kept = [data[c] for c in data.columns if c not in self.mappings]
        out = data.join(F.broadcast(table), key == table["__key"], "left").select(*kept, *[table[t] for t in self.mappings])
        return self.done(dataset, out, {"source": self.source, "targets": list(self.mappings)}, lambda: {"unmatched": [r.v for r in missing.orderBy("v").limit(LISTED).collect()]})


class EstimateAnnualAmount(PipelineStep):
    """``output`` = count x monthly mean x months x scale; null if either is missing."""

    def __init__(self, count: str, monthly: str, output: str, months: int = 13, scale: float = 1.0):
        super().__init__()
        if months <= 0:
            raise ValueError("months must be positive")
        self.count, self.monthly, self.output, self.months, self.scale = count, monthly, output, months, scale

    def apply(self, dataset: Dataset) -> Dataset:
        need(dataset.data, [self.count, self.monthly])
        d = dataset.data
        out = d.withColumn(self.output, d[self.count].cast("double") * d[self.monthly].cast("double") * F.lit(float(self.months)) * F.lit(float(self.scale)))

        def measure():
            r = out.agg(F.count(F.lit(1)).alias("n"), F.count(self.output).alias("some"), F.sum(self.output).alias("total")).first()
            return {"input_rows": r.n, "non_null_rows": r.some, "estimated_sum": r.total}

        return self.done(dataset, out, {"count": self.count, "monthly": self.monthly, "output": self.output, "months": self.months, "scale": self.scale}, measure)


class ParseItalianNumbers(ColumnStep):
    """Local number text to double; numeric columns stay as they are."""

    def __init__(self, columns, na_values: Sequence[str] = NO_NUMBER):
        super().__init__(columns)
        self.na_values = tuple(na_values)

    def transform_column(self, column: Column, name: str) -> Column:
        return column if is_numeric(self.kinds[name]) else italian_number(column.cast("string"), self.na_values)


class ParseItalianNumbersAuto(PipelineStep):
    """Every text column whose values are all local numbers, with or without %, becomes double, or bigint if all are whole."""

    def apply(self, dataset: Dataset) -> Dataset:
        text = [c for c, kind in dataset.data.dtypes if kind == "string"]
        value = {c: italian_number(F.regexp_replace(dataset.data[c], r"\s*%\s*$", "")) for c in text}
        blank = {c: strip(dataset.data[c]).isin(*NO_NUMBER) for c in text}
        tests = []
        for k, c in enumerate(text):
            tests += [F.count(value[c]).alias(f"n{k}"), F.count_if(value[c].isNull() & dataset.data[c].isNotNull() & ~blank[c]).alias(f"x{k}"), F.count_if(value[c] != F.floor(value[c])).alias(f"f{k}")]
        if not tests:
            return self.done(dataset, dataset.data)
        row = dataset.data.agg(*tests).first()
        hit = {c: value[c].cast("bigint") if not row[f"f{k}"] else value[c] for k, c in enumerate(text) if row[f"n{k}"] and not row[f"x{k}"]}
        return self.done(dataset, dataset.data.withColumns(hit) if hit else dataset.data, {"columns": list(hit)})


class WithColumn(PipelineStep):
    """A column by an expression: a constant, a condition, a list of sources."""

    def __init__(self, target: str, expression: Column | Any):
        super().__init__()
        self.target, self.expression = target, expression

    def apply(self, dataset: Dataset) -> Dataset:
        e = self.expression(dataset.data) if callable(self.expression) and not isinstance(self.expression, Column) else self.expression
        return self.done(dataset, dataset.data.withColumn(self.target, e if isinstance(e, Column) else F.lit(e)), {"target": self.target})


class StripStringColumns(PipelineStep):
    def apply(self, dataset: Dataset) -> Dataset:
        text = [c for c, kind in dataset.data.dtypes if kind == "string"]
        return self.done(dataset, dataset.data.withColumns({c: strip(dataset.data[c]) for c in text}) if text else dataset.data, {"columns": text})


class StripAccents(ColumnStep):
    def transform_column(self, column: Column, name: str) -> Column:
        return strip_accents(column)


class TitleCase(ColumnStep):
    def transform_column(self, column: Column, name: str) -> Column:
        return title_case(column)


class NormalizeCity(ColumnStep):
    """Name of a city without white space around it, in title case."""

    def transform_column(self, column: Column, name: str) -> Column:
        return title_case(strip(column))


class SmartTrim(ColumnStep):
    """At most so many characters: ``limits`` by column, else ``default``."""

    def __init__(self, columns, limits: Mapping[str, int] | None = None, default: int = 30):
        super().__init__(columns)
        self.limits, self.default = dict(limits or {}), default

    def transform_column(self, column: Column, name: str) -> Column:
        return F.substring(column, 1, self.limits.get(name, self.default))


class FormatItalianPhone(ColumnStep):
    """Digits only, without 00 and then 39 in front, after "+39 "; null if nothing is left. ``n_changed`` counts the cells that differ after."""

    def apply(self, dataset: Dataset) -> Dataset:
        before = dataset.data
        made = super().apply(dataset)
        differs = [F.count_if(~before[c].cast("string").eqNullSafe(self.transform_column(before[c], c))) for c in self.columns]
        count = lambda: {"n_changed": sum(before.agg(*differs).first())}
        return self.done(dataset, made.data, {"columns": self.columns}, count)

    def transform_column(self, column: Column, name: str) -> Column:
        digits = F.regexp_replace(column.cast("string"), r"\D", "")
        bare = F.regexp_replace(F.regexp_replace(digits, "^00", ""), "^39", "")
        return F.concat(F.lit("+39 "), F.nullif(bare, F.lit("")))
