"""A profile of a dataset from one aggregation and one distinct count."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import functions as F

from ..core import Dataset
from ..functions.text import is_snake_case


@dataclass(frozen=True)
class ProfileReport:
    rows: int
    columns: int
    non_snake_case: list[str]
    duplicate_names: list[str]
    empty_columns: list[str]
    high_null_columns: dict[str, float]
    duplicate_rows: int
    dtypes: dict[str, str]

    def __str__(self) -> str:
        lines = [
            f"{self.rows} rows, {self.columns} columns",
            f"names not in snake_case: {self.non_snake_case or 'none'}",
            f"duplicate names: {self.duplicate_names or 'none'}",
            f"empty columns: {self.empty_columns or 'none'}",
            f"many nulls: {', '.join(f'{c} ({r:.0%})' for c, r in self.high_null_columns.items()) or 'none'}",
            f"duplicate rows: {self.duplicate_rows}",
        ]
        return "\n".join([*lines, *(f"  {c}: {kind}" for c, kind in self.dtypes.items())])


def profile(dataset: Dataset, high_null_threshold: float = 0.5) -> ProfileReport:
    """Names, nulls (NaN counts as null), and repeated rows. Columns over the threshold of nulls but not empty are listed with their share."""
    data = dataset.data
    names = data.columns
    safe = data.toDF(*[f"c{k}" for k in range(len(names))])
    kinds = [kind for _, kind in data.dtypes]
    known = [F.nanvl(f"c{k}", F.lit(None)) if kind in ("double", "float") else F.col(f"c{k}") for k, kind in enumerate(kinds)]
    row = safe.agg(F.count(F.lit(1)).alias("n"), *[F.count(v).alias(f"k{k}") for k, v in enumerate(known)]).first()
    n = row["n"]
    filled = [row[f"k{k}"] for k in range(len(names))]
    empty = [c for c, f in zip(names, filled, strict=True) if not f]
    share = {c: 1 - f / n for c, f in zip(names, filled, strict=True) if n and f and 1 - f / n > high_null_threshold}
    again = n - safe.distinct().count() if names else 0
    return ProfileReport(n, len(names), [c for c in names if not is_snake_case(c)], sorted({c for c in names if names.count(c) > 1}), empty, share, again, dict(zip(names, kinds, strict=True)))


def null_ratios(data):
    """(column, null_ratio) in long form."""
    counts = data.agg(F.count(F.lit(1)).alias("__n"), *[F.count(c).alias(c) for c in data.columns])
    items = [F.struct(F.lit(c).alias("column"), F.coalesce(F.try_divide(F.col("__n") - F.col(c), F.col("__n")), F.lit(0.0)).alias("null_ratio")) for c in data.columns]
    return counts.select(F.explode(F.array(*items)).alias("x")).select("x.*")
