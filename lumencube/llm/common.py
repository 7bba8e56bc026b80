"""Shared plumbing of the training-data operators: tables, scratch and Arrow text access."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ..scratch import shared_dir, written


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_bytes(column: pa.Array) -> Iterator[bytes | None]:
    """UTF-8 of each text of an Arrow string column, None for nulls, without decoding."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    if not len(column):
        return
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8).tolist()
    view = memoryview(data) if data is not None else memoryview(b"")
    nulls = column.null_count and column.is_null().to_pylist()
    for i in range(len(column)):
        yield None if nulls and nulls[i] else bytes(view[at[i] : at[i + 1]])


def slices(batches: Iterator[pa.RecordBatch], most: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``most`` bytes, so that long texts don't pile up."""
    for batch in batches:
        rows = batch.num_rows
        if not rows:
            continue
        step = max(1, int(rows * most / max(batch.nbytes, 1)))
        for k in range(0, rows, step):
            yield batch.slice(k, step)


def apart(docs: DataFrame, **known: str) -> DataFrame:
    """``docs`` with the columns ``known`` under the given names and all others as column_0, column_1 and so on, in their order.

    So no column's own name can meet one that an operator uses, or need quoting; ``toDF`` gives the names back.
    """
    new = {old: name for name, old in known.items()}
    return docs.toDF(*[new.get(c, f"column_{k}") for k, c in enumerate(docs.columns)])


#: Bytes of rows that go to a Python worker at once.
BATCH_BYTES = 8 << 20


def mapped(df: DataFrame, run: Callable, schema: str | StructType) -> DataFrame:
    """``df.mapInArrow`` with batches of about BATCH_BYTES at most, so that long texts need no more memory.

    Spark takes that bound from the session when the plan runs, so it stays set there.
    """
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    df.sparkSession.conf.set(key, str(BATCH_BYTES))
    return df.mapInArrow(run, schema)


__all__ = ["apart", "mapped", "shared_dir", "slices", "table", "text_bytes", "written"]
