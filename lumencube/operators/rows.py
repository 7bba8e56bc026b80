"""Steps on rows: filters, duplicates, joins."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..core import Dataset, Measured, PipelineStep, need


class FilterRows(PipelineStep):
    """Keep the rows for which ``predicate(data)`` holds; null counts as false."""

    def __init__(self, predicate: Callable[[DataFrame], Column]):
        super().__init__()
        self.predicate = predicate

    def apply(self, dataset: Dataset) -> Dataset:
        counted = Measured(dataset)
        data = counted.on(dataset.data, before=F.count(F.lit(1)))
        out = counted.on(data.where(self.predicate(data)), after=F.count(F.lit(1)))
        return self.done(dataset, out, measure=counted.metrics(out, lambda m: {"rows_before": m["before"], "rows_after": m["after"], "rows_removed": m["before"] - m["after"]}))


class DropDuplicateRows(PipelineStep):
    """Equal rows once; nulls are equal."""

    def apply(self, dataset: Dataset) -> Dataset:
        counted = Measured(dataset)
        out = counted.on(counted.on(dataset.data, before=F.count(F.lit(1))).dropDuplicates(), after=F.count(F.lit(1)))
        return self.done(dataset, out, measure=counted.metrics(out, lambda m: {"removed_count": m["before"] - m["after"]}))


class KeepFirst(PipelineStep):
    """One row for each key: the first in the order of ``order_by``, which should tell rows apart."""

    def __init__(self, keys: Sequence[str], order_by: Sequence[str]):
        super().__init__()
        self.keys, self.order_by = list(keys), list(order_by)

    def apply(self, dataset: Dataset) -> Dataset:
        need(dataset.data, [*self.keys, *self.order_by])
        order = Window.partitionBy(*self.keys).orderBy(*[F.asc_nulls_last(c) for c in self.order_by])
        out = dataset.data.withColumn("__nth", F.row_number().over(order)).where(F.col("__nth") == 1).drop("__nth")
        return self.done(dataset, out, {"keys": self.keys})


class LeftJoinEnrich(PipelineStep):
    """Left join with the columns of another dataset.

    Nulls match nulls. Right columns whose name the left has get the suffix ``_right``; right keys
    don't come along unless they are asked for. Repeated right keys repeat rows. Whether the right
    side is broadcast is up to its size and the session's threshold.
    """

    def __init__(self, other: Dataset | DataFrame, left_on: str | Sequence[str], right_on: str | Sequence[str] | None = None, columns: Sequence[str] | None = None):
        super().__init__()
        listed = lambda x: [x] if isinstance(x, str) else list(x)
        self.other = other.data if isinstance(other, Dataset) else other
        self.left_on = listed(left_on)
        self.right_on = listed(right_on) if right_on is not None else self.left_on
        if len(self.left_on) != len(self.right_on):
            raise ValueError("left_on and right_on differ in length")
        self.columns = list(columns) if columns is not None else [c for c in self.other.columns if c not in self.right_on]

    def apply(self, dataset: Dataset) -> Dataset:
        left, right = dataset.data, self.other
        need(left, self.left_on)
        need(right, [*self.right_on, *self.columns])
        names = {c: f"{c}_right" if c in left.columns else c for c in self.columns}
        small = right.select(*[right[c].alias(f"__k{k}") for k, c in enumerate(self.right_on)], *[right[c].alias(f"__c{k}") for k, c in enumerate(self.columns)])
        on = [left[c].eqNullSafe(small[f"__k{k}"]) for k, c in enumerate(self.left_on)]
        out = left.join(small, on, "left").select(*[left[c] for c in left.columns], *[small[f"__c{k}"].alias(names[c]) for k, c in enumerate(self.columns)])
        counted = Measured(dataset)
        hit = F.count(out[names[self.columns[0]]]) if self.columns else F.count(F.lit(1))
        out = counted.on(out, n=F.count(F.lit(1)), hit=hit)
        return self.done(dataset, out, {"left_on": self.left_on, "right_on": self.right_on, "columns": self.columns}, counted.metrics(out, lambda m: {"matched": m["hit"], "unmatched": m["n"] - m["hit"]}))
