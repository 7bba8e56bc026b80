"""As-of join: to each row the last (or next) row of another table by time, key by key.

Both sides are united, range-partitioned by key and time and sorted, so a key with very many rows is dealt over as
many tasks as it needs. A task carries the last right row along its range. What lies before the first
right row of a range is settled across the ranges' ends: each range leaves the last right row of its last
key, one row a range, and an open head takes the one of the nearest range before it that has its key.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..core import Dataset, PipelineStep, distinct_names, need
from ..scratch import shared_dir, written
from .intervals import column

DIRECTIONS = ("backward", "forward")
#: What a row of the carried table is: settled, the open head of a range, the last right row of a range.
_SETTLED, _OPEN, _LAST = 0, 1, 2


def _changes(keys: list[pa.Array]) -> np.ndarray:
    """For each row but the first whether its key differs from the row before."""
    out = np.zeros(max(0, len(keys[0]) - 1), bool) if keys else np.zeros(0, bool)
    for k in keys:
        a, b = k[1:], k[:-1]
        differ = pc.fill_null(pc.not_equal(a, b), False).to_numpy(zero_copy_only=False)
        out |= differ | (pc.is_null(a).to_numpy(zero_copy_only=False) != pc.is_null(b).to_numpy(zero_copy_only=False))
    return out


def _carry(n_keys: int):
    """Sorted rows (k0.., side, l, r) to left rows with the last right row of their key, and what a range leaves open."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        key = last = schema = None  # the key so far, and its last right row as an array of one
        first_key = True  # still within the range's first key
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            keys = [batch.column(i) for i in range(n_keys)]
            side, l, r = (batch.column(n_keys + i) for i in range(3))  # noqa: E741
            schema, now = r.type, tuple(k[0].as_py() for k in keys)
            changed = np.concatenate([[key is not None and now != key], _changes(keys) if n_keys else np.zeros(n - 1, bool)])
            is_right = side.to_numpy() == 0
            # place 0 is what was carried in, place i + 1 this batch's row i; a new key forgets what was before
            at = np.arange(1, n + 1)
            seen = np.maximum.accumulate(np.where(is_right, at, 0))
            begun = np.maximum.accumulate(np.where(changed, at, 0))
            carried = begun == 0  # rows that still have the key that came in
            place = np.where(seen >= np.maximum(begun, 1), seen, 0)
            pool = pa.concat_arrays([last if last is not None else pa.nulls(1, schema), r])
            held = last is not None
            empty = (place == 0) & ~(carried & held)
            left = np.flatnonzero(~is_right)
            if len(left):
                matched = pool.take(pa.array(place[left], mask=empty[left]))
                open_ = empty[left] & carried[left] & first_key
                kind = np.where(open_, _OPEN, _SETTLED).astype(np.int32)
                some = [k.take(pa.array(left)) for k in keys]
                yield _rows(some, l.take(pa.array(left)), matched, kind, part)
            if changed.any():
                first_key = False
            end = int(place[-1])
            last = None if empty[-1] else pool[end : end + 1]
            key = tuple(k[-1].as_py() for k in keys)
            tail, l_type = [k[-1:] for k in keys], l.type
        if last is not None:
            yield _rows(tail, pa.nulls(1, l_type), last, np.array([_LAST], np.int32), part)

    def _rows(keys, l, r, kind, part):  # noqa: E741
        columns = [*keys, l, r, pa.array(kind), pa.array(np.full(len(kind), part, np.int32))]
        return pa.RecordBatch.from_arrays(columns, names=[*[f"k{i}" for i in range(n_keys)], "l", "r", "kind", "part"])

    return run


def asof_join(left: DataFrame, right: DataFrame, left_time: str, right_time: str, on: Sequence[str] | Sequence[tuple[str, str]] = (), columns: Sequence[str] | None = None, direction: str = "backward", exact: bool = True, tolerance: Column | None = None, ties: Sequence[str] = ()) -> DataFrame:
    """All left rows, each with ``columns`` of the right row that is nearest in time on one side.

    ``backward`` takes the last right row that is not later, ``forward`` the first that is not earlier; without ``exact`` one
    of the same time does not count. Keys ``on`` are names or pairs of names; nulls (and NaN) are equal. Of right rows with one key
    and time the one with the greatest ``ties`` columns is taken, then the one with the greatest hash of all its values. ``tolerance`` is the longest
    time between the two, as a column (a number or an interval); beyond it there is no match. Left rows with a null time stay without a match;
    right rows with a null time take no part; repeated left rows stay. ``columns`` are all but the right keys by default; a
    name that the left has is an error.
    """
    if direction not in DIRECTIONS:
        raise ValueError(f"direction must be one of {DIRECTIONS}")
    pairs = [(x, x) if isinstance(x, str) else tuple(x) for x in on]
    need(left, [left_time, *[x for x, _ in pairs]])
    need(right, [right_time, *[y for _, y in pairs], *ties, *(columns or [])])
    wanted = list(columns) if columns is not None else [c for c in right.columns if c not in [y for _, y in pairs]]
    distinct_names([*left.columns, *wanted])
    kind = left.schema[left_time].dataType
    if kind != right.schema[right_time].dataType:
        raise TypeError(f"times differ in type: {kind.simpleString()} and {right.schema[right_time].dataType.simpleString()}")

    def keyed(data: DataFrame, names: list[str]) -> list[Column]:
        out = []
        for i, c in enumerate(names):
            t = data.schema[c].dataType
            if not isinstance(t, T.AtomicType):
                raise TypeError(f"key {c} is {t.simpleString()}, not a plain value")
            x = F.nanvl(column(c), F.lit(None).cast(t)) if isinstance(t, (T.FloatType, T.DoubleType)) else column(c)
            out.append(x.alias(f"k{i}"))
        return out

    names = [f"k{i}" for i in range(len(pairs))]
    mine = F.struct(*[column(c).alias(f"c{i}") for i, c in enumerate(left.columns)])
    theirs = F.struct(*[column(c).alias(f"c{i}") for i, c in enumerate(wanted)], column(right_time).alias("time"))
    everything = F.xxhash64(*[column(c) for c in right.columns])
    rank = F.struct(*[column(c).alias(f"t{i}") for i, c in enumerate(ties)], everything.alias("hash"))
    a = left.select(*keyed(left, [x for x, _ in pairs]), column(left_time).alias("time"), F.lit(1).alias("side"), mine.alias("l"))
    b = right.where(column(right_time).isNotNull()).select(*keyed(right, [y for _, y in pairs]), column(right_time).alias("time"), F.lit(0).alias("side"), theirs.alias("r"), rank.alias("rank"))
    both = a.unionByName(b, allowMissingColumns=True).withColumn("place", F.monotonically_increasing_id())
    # null times come first, where no right row has been seen; sides decide between equal times
    when = F.asc_nulls_first("time") if direction == "backward" else F.desc_nulls_first("time")
    order = [*[F.asc_nulls_first(k) for k in names], when, F.asc("side") if exact else F.desc("side"), F.asc_nulls_first("rank"), F.asc("place")]
    ordered = both.repartitionByRange(*order).sortWithinPartitions(*order).select(*names, "side", "l", "r")
    schema = T.StructType([*[ordered.schema[k] for k in names], T.StructField("l", ordered.schema["l"].dataType), T.StructField("r", ordered.schema["r"].dataType), T.StructField("kind", T.IntegerType()), T.StructField("part", T.IntegerType())])
    home = shared_dir(left.sparkSession, "asof")
    rows = written(ordered.mapInArrow(_carry(len(pairs)), schema), f"{home}/rows")
    heads = rows.where(F.col("kind") == _OPEN)
    ends = rows.where(F.col("kind") == _LAST).select(*names, "part", F.lit(1).alias("is_end"), "r")  # one row a range
    asked = heads.select(*names, "part").distinct().select("*", F.lit(0).alias("is_end"), F.lit(None).cast(ordered.schema["r"].dataType).alias("r"))  # one row a range
    before = Window.partitionBy(*(names or [F.lit(0)])).orderBy("part", "is_end").rowsBetween(Window.unboundedPreceding, -1)
    answer = ends.unionByName(asked).withColumn("r", F.last("r", ignorenulls=True).over(before)).where(F.col("is_end") == 0)
    answer = answer.select(F.col("part").alias("p"), F.col("r").alias("found"))
    settled = rows.where(F.col("kind") == _SETTLED).select("l", "r")
    out = settled.unionByName(heads.join(answer, heads.part == answer.p, "left").select("l", F.col("found").alias("r")))
    if tolerance is not None:
        time = F.col("l")[f"c{left.columns.index(left_time)}"]
        apart = time - F.col("r")["time"] if direction == "backward" else F.col("r")["time"] - time
        out = out.withColumn("r", F.when(apart <= tolerance, F.col("r")))
    return out.select(*[F.col("l")[f"c{i}"].alias(c) for i, c in enumerate(left.columns)], *[F.col("r")[f"c{i}"].alias(c) for i, c in enumerate(wanted)])


class JoinAsOf(PipelineStep):
    """``asof_join`` with another dataset."""

    def __init__(self, other: Dataset | DataFrame, left_time: str, right_time: str, on: Sequence = (), **options):
        super().__init__()
        self.other = other.data if isinstance(other, Dataset) else other
        self.left_time, self.right_time, self.on, self.options = left_time, right_time, list(on), options

    def apply(self, dataset: Dataset) -> Dataset:
        out = asof_join(dataset.data, self.other, self.left_time, self.right_time, self.on, **self.options)
        return self.done(dataset, out, {"on": self.on, **self.options}, lambda: {"rows": out.count()})
