"""Steps over streams: stateless steps run unchanged; windows and duplicates take watermarks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..core import ColumnStep, Dataset, PipelineStep
from ..operators.columns import AddNormalizedKey, CastTypes, DropColumns, EstimateAnnualAmount, NormalizeColumnNames, ParseDates, RenameColumns, StripStringColumns, WithColumn
from ..operators.reshape import PairedUnpivot
from ..operators.rows import FilterRows, LeftJoinEnrich

#: Steps that read each row by itself, or join it with a static table.
STATELESS = (ColumnStep, AddNormalizedKey, CastTypes, DropColumns, EstimateAnnualAmount, FilterRows, LeftJoinEnrich, NormalizeColumnNames, PairedUnpivot, ParseDates, RenameColumns, StripStringColumns, WithColumn)


def apply_steps(stream: DataFrame, steps: Sequence[PipelineStep]) -> DataFrame:
    """Run steps over a stream; TypeError for one that needs all rows."""
    data = Dataset(stream)
    for step in steps:
        if not isinstance(step, STATELESS):
            raise TypeError(f"{step.name} needs all rows and can't run over a stream")
        data = step.apply(data)
    return data.data


def windowed(stream: DataFrame, time: str, keys: Sequence[str], length: str, late: str, value: str, slide: str | None = None) -> DataFrame:
    """Counts and sums of a value in event-time windows; rows later than ``late`` are not counted."""
    window = F.window(time, length, slide) if slide else F.window(time, length)
    sums = stream.withWatermark(time, late).groupBy(window.alias("w"), *keys).agg(F.count(F.lit(1)).alias("n"), F.sum(value).alias("total"))
    return sums.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *keys, "n", "total")


def drop_duplicates(stream: DataFrame, keys: Sequence[str], time: str, late: str) -> DataFrame:
    """Each key once within the watermark; state older than that is dropped."""
    return stream.withWatermark(time, late).dropDuplicatesWithinWatermark(list(keys))


def sessions(stream: DataFrame, time: str, keys: Sequence[str], gap: str, late: str) -> DataFrame:
    grouped = stream.withWatermark(time, late).groupBy(F.session_window(time, gap).alias("w"), *keys).agg(F.count(F.lit(1)).alias("n"))
    return grouped.select(F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), *keys, "n")
