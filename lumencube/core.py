"""Datasets with a step-by-step history, steps, pipelines and recipes; no step runs a Spark job by itself."""

from __future__ import annotations

import logging
from abc import ABC, abstractmethod
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass, field
from functools import cached_property
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class StepRecord:
    """What a step did. ``measure`` is called when ``metrics`` is first read, so unread metrics cost nothing."""

    name: str
    params: Mapping[str, Any] = field(default_factory=dict)
    measure: Callable[[], Mapping[str, Any]] | Mapping[str, Any] = field(default_factory=dict, repr=False, compare=False)

    @cached_property
    def metrics(self) -> dict[str, Any]:
        return dict(self.measure() if callable(self.measure) else self.measure)


class History:
    """An immutable sequence of step records."""

    def __init__(self, records: Sequence[StepRecord] = ()):
        self._records = tuple(records)

    def append(self, record: StepRecord) -> History:
        return History((*self._records, record))

    def __len__(self) -> int:
        return len(self._records)

    def __iter__(self) -> Iterator[StepRecord]:
        return iter(self._records)

    def __getitem__(self, k):
        return self._records[k]

    def __repr__(self) -> str:
        return f"History({', '.join(r.name for r in self._records)})"


class Dataset:
    """A DataFrame and the history that led to it. Never changes; steps return new ones."""

    def __init__(self, data: DataFrame, history: History | None = None, is_observed: bool = False):
        if not isinstance(data, DataFrame):
            raise TypeError(f"a Spark DataFrame is needed, not {type(data).__name__}")
        self._data, self._history, self.is_observed = data, history or History(), is_observed

    def observed(self) -> Dataset:
        """The same data, whose later steps are measured by the job that writes the result, not by jobs of their own.

        Spark counts in the first action that completes, so let that be one over all rows, such as a sink's. Reading
        metrics before that runs one job for all steps so far.
        """
        return Dataset(self._data, self._history, True)

    @classmethod
    def from_csv(cls, path: str, spark: SparkSession | None = None, **options) -> Dataset:
        from .sources.tabular import read_csv

        return cls(read_csv(spark or SparkSession.active(), path, **options))

    @classmethod
    def from_parquet(cls, path: str, spark: SparkSession | None = None) -> Dataset:
        from .sources.tabular import read_parquet

        return cls(read_parquet(spark or SparkSession.active(), path))

    @classmethod
    def from_rows(cls, rows, schema, spark: SparkSession | None = None) -> Dataset:
        return cls((spark or SparkSession.active()).createDataFrame(rows, schema))

    @property
    def data(self) -> DataFrame:
        return self._data

    @property
    def columns(self) -> list[str]:
        return self._data.columns

    @cached_property
    def shape(self) -> tuple[int, int]:
        return self._data.count(), len(self.columns)

    @property
    def history(self) -> History:
        return self._history

    def head(self, n: int = 5):
        if self.is_observed and len(self._history):
            _ = self._history[-1].metrics  # or a few rows would be counted as all
        return self._data.limit(n).toPandas()

    def to_pandas(self):
        return self._data.toPandas()

    def to_csv(self, path: str, **options) -> None:
        from .sources.sinks import write_csv

        write_csv(self._data, path, **options)

    def to_parquet(self, path: str, **options) -> None:
        self._data.write.mode("overwrite").options(**options).parquet(path)

    def with_data(self, data: DataFrame, *, step_name: str | None = None, step_record: StepRecord | None = None) -> Dataset:
        if (step_name is None) == (step_record is None):
            raise ValueError("give either step_name or step_record")
        return Dataset(data, self._history.append(step_record or StepRecord(step_name)), self.is_observed)

    def with_columns_renamed(self, mapping: Mapping[str, str]) -> Dataset:
        need(self._data, mapping)
        return self.with_data(renamed(self._data, mapping), step_record=StepRecord("rename", {"mapping": dict(mapping)}))

    def profile(self, **options):
        from .plans.profile import profile

        return profile(self, **options)

    def __repr__(self) -> str:
        return f"Dataset({len(self.columns)} columns, {len(self._history)} steps)"


def need(data: DataFrame, names) -> None:
    """KeyError with the names that ``data`` lacks."""
    if missing := [n for n in names if n not in data.columns]:
        raise KeyError(f"missing columns: {missing}")


def distinct_names(names: Sequence[str]) -> list[str]:
    """ValueError if a name comes twice."""
    if again := sorted({n for n in names if list(names).count(n) > 1}):
        raise ValueError(f"duplicate columns: {again}")
    return list(names)


def renamed(data: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """All renames at once, so that names can swap."""
    return data.toDF(*distinct_names([mapping.get(c, c) for c in data.columns]))


class Measured:
    """What a step counts in its input and its output, of a dataset that is observed or not.

    Observed counts ride on the plan; others are one aggregation over each side when the metrics are read.
    """

    def __init__(self, dataset: Dataset):
        self.dataset, self.sides, self.observations = dataset, [], []

    def on(self, data: DataFrame, **counts: Column) -> DataFrame:
        """The data to go on with, in which ``counts`` (aggregates) are taken."""
        if not self.dataset.is_observed:
            self.sides.append((data, counts))
            return data
        self.observations.append(Observation())
        return data.observe(self.observations[-1], *[c.alias(n) for n, c in counts.items()])

    def metrics(self, out: DataFrame, say: Callable[[dict[str, Any]], Mapping[str, Any]]) -> Callable[[], Mapping[str, Any]]:
        def measure() -> Mapping[str, Any]:
            found: dict[str, Any] = {}
            for data, counts in self.sides:
                found |= data.agg(*[c.alias(n) for n, c in counts.items()]).first().asDict()
            if not all(o._jo.future().isCompleted() for o in self.observations):
                out.write.format("noop").mode("overwrite").save()
            for o in self.observations:
                found |= o.get
            return say(found)

        return measure


class PipelineStep(ABC):
    """One transformation. Subclasses return a new dataset from ``apply``."""

    name: str | None = None

    def __init__(self, name: str | None = None):
        self.name = name or self.name or type(self).__name__

    @abstractmethod
    def apply(self, dataset: Dataset) -> Dataset: ...

    def done(self, dataset: Dataset, data: DataFrame, params: Mapping[str, Any] | None = None, measure=None) -> Dataset:
        return dataset.with_data(data, step_record=StepRecord(self.name or type(self).__name__, params or {}, measure or {}))

    def __repr__(self) -> str:
        return f"{type(self).__name__}()"


class ColumnStep(PipelineStep):
    """Replaces columns one by one by an expression of their own values."""

    def __init__(self, columns: str | Sequence[str], name: str | None = None):
        super().__init__(name)
        self.columns = [columns] if isinstance(columns, str) else list(columns)

    @abstractmethod
    def transform_column(self, column: Column, name: str) -> Column: ...

    def apply(self, dataset: Dataset) -> Dataset:
        need(dataset.data, self.columns)
        self.kinds = dict(dataset.data.dtypes)
        made = {c: self.transform_column(dataset.data[c], c) for c in self.columns}
        return self.done(dataset, dataset.data.withColumns(made), {"columns": self.columns})


class Pipeline:
    """Steps in order. ``on_error``: raise, skip (keep the data and history before the step) or interactive."""

    MODES = ("interactive", "raise", "skip")

    def __init__(self, steps: Sequence[PipelineStep] = (), on_error: str = "interactive", eager: bool = False, observed: bool = False):
        if on_error not in self.MODES:
            raise ValueError(f"on_error must be one of {self.MODES}")
        self.on_error, self.eager, self.observed, self._steps = on_error, eager, observed, []
        for step in steps:
            self.add(step)

    @property
    def steps(self) -> tuple[PipelineStep, ...]:
        return tuple(self._steps)

    def add(self, step: PipelineStep) -> Pipeline:
        if not isinstance(step, PipelineStep):
            raise TypeError(f"a PipelineStep is needed, not {type(step).__name__}")
        self._steps.append(step)
        return self

    def run(self, dataset: Dataset) -> Dataset:
        """Fold the steps. Spark finds errors in the data only in an action; ``eager`` forces one after each step. With ``observed`` the
        job that writes the result measures the steps too; see ``Dataset.observed``."""
        dataset = dataset.observed() if self.observed else dataset
        for step in self._steps:
            try:
                made = step.apply(dataset)
                if self.eager:
                    made.data.write.format("noop").mode("overwrite").save()
                dataset = made
            except Exception as error:
                if not self._goes_on(step, error):
                    raise
        return dataset

    def _goes_on(self, step: PipelineStep, error: Exception) -> bool:
        if self.on_error == "skip":
            log.warning("step %s skipped: %s", step.name, error)
            return True
        if self.on_error == "raise":
            return False
        while True:
            said = input(f"step {step.name} failed: {error}\n[c]ontinue without it or [a]bort? ").strip().lower()
            if said in ("c", "continue", "s", "skip"):
                return True
            if said in ("a", "abort"):
                return False


class Recipe(ABC):
    """A parameterised pipeline."""

    @abstractmethod
    def build(self) -> Pipeline: ...

    def apply(self, dataset: Dataset) -> Dataset:
        return self.build().run(dataset)
