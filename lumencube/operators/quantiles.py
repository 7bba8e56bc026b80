"""Exact quantiles without gathering a column's values in one task."""

from __future__ import annotations

from collections.abc import Sequence
from math import ceil, floor

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ACCURACY = 10_000


def exact_quantiles(data: DataFrame, column: Column, shares: Sequence[float]) -> list[float] | None:
    """Interpolated quantiles of the known values (neither null nor NaN); None if there are none.

    A sketch of bounded size gives two values around each quantile; what lies below is counted, and only
    what lies between (about 4 in ACCURACY of the rows, or one repeated value) is looked at exactly. Three aggregations.
    """
    v = data.select(F.nanvl(column.cast("double"), F.lit(None)).alias("v")).where(F.col("v").isNotNull())
    width = 2 / ACCURACY
    while True:
        ends = [min(max(p + side, 0.0), 1.0) for p in shares for side in (-width, width)]
        first = v.agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"), F.percentile_approx("v", ends, ACCURACY).alias("q")).first()
        if not first.n:
            return None
        at = [(first.n - 1) * p for p in shares]
        around = [(first.lo if a <= 0 else x, first.hi if b >= 1 else y) for a, b, x, y in zip(ends[::2], ends[1::2], first.q[::2], first.q[1::2], strict=True)]
        inside = [F.col("v").between(x, y) for x, y in around]
        counts = v.agg(*[F.count_if(F.col("v") < x).alias(f"b{k}") for k, (x, _) in enumerate(around)], *[F.count_if(i).alias(f"m{k}") for k, i in enumerate(inside)]).first()
        spans = [(counts[f"b{k}"], counts[f"m{k}"]) for k in range(len(shares))]
        if all(b <= floor(r) and ceil(r) < b + m for r, (b, m) in zip(at, spans, strict=True)):
            break
        width *= 4  # the sketch was further off than it should be
    picks = []
    for k, (r, (b, m)) in enumerate(zip(at, spans, strict=True)):
        local = [(x - b) / (m - 1) if m > 1 else 0.0 for x in (floor(r), ceil(r))]
        picks.append(F.percentile(F.when(inside[k], F.col("v")), local).alias(f"p{k}"))
    row = v.agg(*picks).first()
    return [low + (high - low) * (r - floor(r)) for r, (low, high) in zip(at, row, strict=True)]
