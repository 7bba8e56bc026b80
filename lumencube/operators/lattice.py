"""A stored lattice of grouping sets whose cells hold mergeable state.

Rows are aggregated once, into the finest cells; the coarser ones are merged from those, so the rows are neither
repeated for each grouping set nor read again. A cell holds state, not results: counts, sums, extremes, and sketches of bounded size
for distinct counts and quantiles. New rows become cells of their own in a new version of the store, and cells
are merged when they are read or compacted; what was there is not computed again. A grouping that is not stored
is merged from the smallest stored one that has its columns.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass
from itertools import combinations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..core import distinct_names, need
from ..sources.versions import Versions
from .intervals import column


@dataclass(frozen=True)
class Measure:
    """State of a cell: how rows make it, how states are merged and what it says."""

    kind: str
    source: str | None
    make: Callable[[], Column]
    merge: Callable[[Column], Column]
    result: Callable[[Column], Column]

    @property
    def text(self) -> str:
        return f"{self.kind}:{self.source or ''}"


_same = lambda state: state


def rows() -> Measure:
    """The number of rows."""
    return Measure("rows", None, lambda: F.count(F.lit(1)), F.sum, _same)


def count(name: str) -> Measure:
    """The number of values that are not null."""
    return Measure("count", name, lambda: F.count(column(name)), F.sum, _same)


def total(name: str) -> Measure:
    return Measure("total", name, lambda: F.sum(column(name)), F.sum, _same)


def least(name: str) -> Measure:
    return Measure("least", name, lambda: F.min(column(name)), F.min, _same)


def most(name: str) -> Measure:
    return Measure("most", name, lambda: F.max(column(name)), F.max, _same)


def distinct(name: str, bits: int = 12) -> Measure:
    """About how many different values: 2^bits registers, a relative standard error of about 1.04 / sqrt(2^bits) (1.6 % for 12)."""
    return Measure(f"distinct{bits}", name, lambda: F.hll_sketch_agg(column(name), bits), F.hll_union_agg, F.hll_sketch_estimate)


def quantile(name: str, share: float, k: int = 200) -> Measure:
    """A value about ``share`` of the way up, within about 1.7 % of the ranks for ``k`` = 200; null without values."""
    at = F.lit(float(share))
    state = lambda x: F.when(F.kll_sketch_get_n_double(x) > 0, F.kll_sketch_get_quantile_double(x, at))
    return Measure(f"quantile{share}", name, lambda: F.kll_sketch_agg_double(column(name).cast("double"), k), F.kll_merge_agg_double, state)


def rollup(*names: str) -> list[tuple[str, ...]]:
    return [names[:k] for k in range(len(names), -1, -1)]


def cube(*names: str) -> list[tuple[str, ...]]:
    return [s for k in range(len(names), -1, -1) for s in combinations(names, k)]


class Lattice:
    """Grouping sets of ``dims`` with ``measures``, kept at ``path``.

    ``sets`` are tuples of dims, all kept whole; see ``rollup`` and ``cube``. Null is a value of a dim like any other; ``level`` (a
    bit for each dim that is summed over, the first dim being the highest) tells it from a total. Reading needs the same dims and measures as writing.
    """

    def __init__(self, spark: SparkSession, path: str, dims: Sequence[str], measures: Mapping[str, Measure], sets: Iterable[Sequence[str]] | None = None):
        self.spark, self.dims, self.measures = spark, list(dims), dict(measures)
        distinct_names([*self.dims, *self.measures, "level"])
        given = [tuple(s) for s in sets] if sets is not None else [tuple(self.dims)]
        if odd := [s for s in given if not set(s) <= set(self.dims)]:
            raise ValueError(f"not of the dims: {odd}")
        self.sets = sorted({tuple(d for d in self.dims if d in s) for s in given}, key=lambda s: (-len(s), s))
        self.versions = Versions(spark, path, lambda content: set(content.get("cells", [])))
        self.shape = json.dumps({"dims": self.dims, "measures": {n: m.text for n, m in self.measures.items()}, "sets": self.sets})

    def level(self, dims: Iterable[str]) -> int:
        held = set(dims)
        return sum(1 << k for k, d in enumerate(reversed(self.dims)) if d not in held)

    def cells(self, data: DataFrame) -> DataFrame:
        """The cells of all grouping sets of ``data``: one shuffle of its finest cells, then of cells only."""
        need(data, [*self.dims, *[m.source for m in self.measures.values() if m.source]])
        fine = data.groupBy(*[column(d).alias(f"d{i}") for i, d in enumerate(self.dims)]).agg(*[m.make().alias(f"m{i}") for i, m in enumerate(self.measures.values())])
        return self._regrouped(fine, self.sets)

    def _merged(self) -> list[Column]:
        return [m.merge(F.col(f"m{i}")).alias(f"m{i}") for i, m in enumerate(self.measures.values())]

    def _regrouped(self, cells: DataFrame, sets: Sequence[tuple[str, ...]]) -> DataFrame:
        at = {d: f"d{i}" for i, d in enumerate(self.dims)}
        if not self.dims:
            return cells.agg(*self._merged()).select(F.lit(0).cast("long").alias("level"), *[f"m{i}" for i in range(len(self.measures))])
        grouped = cells.groupingSets([[F.col(at[d]) for d in s] for s in sets], *[F.col(x) for x in at.values()])
        out = grouped.agg(F.grouping_id(*at.values()).cast("long").alias("level"), *self._merged())
        return out.select("level", *at.values(), *[f"m{i}" for i in range(len(self.measures))])

    def add(self, data: DataFrame) -> int:
        """Add the cells of new rows as a new version; earlier cells are not read."""
        base, content = self._content()
        folder = self.versions.write(self.cells(data))
        return self.versions.publish(base, {"shape": self.shape, "cells": [*content.get("cells", []), folder]})

    def compact(self) -> int:
        """Merge the cells of all additions into one folder."""
        base, _ = self._content()
        folder = self.versions.write(self._states())
        return self.versions.publish(base, {"shape": self.shape, "cells": [folder]})

    def _content(self, version: int | None = None) -> tuple[int, dict]:
        base = self.versions.latest() if version is None else version
        content = self.versions.content(base)
        if content and content["shape"] != self.shape:
            raise ValueError("the stored lattice has other dims, measures or grouping sets")
        return base, content

    def _states(self, version: int | None = None) -> DataFrame:
        _, content = self._content(version)
        if not content:
            raise ValueError("nothing has been added yet")
        keys = ["level", *[f"d{i}" for i in range(len(self.dims))]]
        stored = self.spark.read.parquet(*[self.versions.place(f) for f in content["cells"]])
        return stored if len(content["cells"]) == 1 else stored.groupBy(*keys).agg(*self._merged())

    def read(self, version: int | None = None) -> DataFrame:
        """All stored cells: the dims (null where summed over), level and the measures' results."""
        return self._results(self._states(version), self.dims)

    def group(self, *dims: str, version: int | None = None) -> DataFrame:
        """The cells of one grouping: stored ones, or merged from the stored grouping with the fewest dims that has them all."""
        wanted = tuple(d for d in self.dims if d in dims)
        if len(wanted) != len(set(dims)):
            raise KeyError(f"not of the dims: {sorted(set(dims) - set(self.dims))}")
        from_ = min((s for s in self.sets if set(wanted) <= set(s)), key=len, default=None)
        if from_ is None:
            raise ValueError(f"no stored grouping has {wanted}")
        states = self._states(version).where(F.col("level") == self.level(from_))
        if from_ != wanted:
            states = self._regrouped(states.drop("level"), [wanted])
        return self._results(states, wanted).drop("level")

    def _results(self, states: DataFrame, dims: Sequence[str]) -> DataFrame:
        shown = [F.col(f"d{self.dims.index(d)}").alias(d) for d in dims]
        return states.select(*shown, "level", *[m.result(F.col(f"m{i}")).alias(n) for i, (n, m) in enumerate(self.measures.items())])
