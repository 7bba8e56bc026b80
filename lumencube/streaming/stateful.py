"""Operators over streams that keep state of their own: sessions closed by timers, and two streams joined within an interval."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from ..core import distinct_names, need
from ..operators.intervals import column

_STORE = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_SESSION = T.StructType([T.StructField(n, t) for n, t in (("first_at", T.LongType()), ("last_at", T.LongType()), ("n", T.LongType()), ("total", T.DoubleType()), ("first_kind", T.StringType()), ("last_kind", T.StringType()))])
_NAMES = _SESSION.names


@contextmanager
def state_store(spark: SparkSession) -> Iterator[None]:
    """State with timers needs the RocksDB store, which a stream takes from the session when it starts; the setting is put back afterwards."""
    before = spark.conf.get(_STORE, None)
    spark.conf.set(_STORE, _ROCKS)
    try:
        yield
    finally:
        spark.conf.set(_STORE, before) if before else spark.conf.unset(_STORE)


def merged(sessions: pd.DataFrame, gap: int) -> pd.DataFrame:
    """Sessions (or single rows as such) of one key with those less than ``gap`` microseconds apart made one."""
    if len(sessions) < 2:
        return sessions
    s = sessions.sort_values(["first_at", "first_kind"], kind="stable", ignore_index=True)
    first, last = s["first_at"].to_numpy(), s["last_at"].to_numpy()
    reach = np.maximum.accumulate(last)
    begins = np.concatenate([[0], np.flatnonzero(first[1:] - reach[:-1] >= gap) + 1])
    # the last kind is that of the latest row, of equals the greatest name
    order = s.assign(group=np.repeat(np.arange(len(begins)), np.diff(np.append(begins, len(s))))).sort_values(["group", "last_at", "last_kind"], kind="stable")
    latest = order.groupby("group", sort=True)["last_kind"].last()
    return pd.DataFrame({
        "first_at": first[begins],
        "last_at": np.maximum.reduceat(last, begins),
        "n": np.add.reduceat(s["n"].to_numpy(), begins),
        "total": np.add.reduceat(s["total"].to_numpy(), begins),
        "first_kind": s["first_kind"].to_numpy()[begins],
        "last_kind": latest.to_numpy(),
    })


class _Sessions(StatefulProcessor):
    """Open sessions of a key as a list in the state store; a timer at the end of the earliest closes those whose gap has passed."""

    def __init__(self, gap: int, keys: list[str]):
        self.gap, self.keys = gap, keys

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getListState("open", _SESSION)

    def _held(self) -> pd.DataFrame:
        return pd.DataFrame(list(self.open.get()), columns=_NAMES)

    def _keep(self, sessions: pd.DataFrame) -> None:
        if not len(sessions):
            self.open.clear()
            return
        self.open.put([tuple(r) for r in sessions[_NAMES].astype(object).itertuples(index=False)])
        self.handle.registerTimer(-(-(int(sessions["last_at"].min()) + self.gap) // 1000))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802
        now = self._held()
        for some in rows:  # each piece becomes sessions before the next is read
            made = pd.DataFrame({"first_at": some["at"], "last_at": some["at"], "n": 1, "total": some["value"].astype(float), "first_kind": some["kind"], "last_kind": some["kind"]})
            made = merged(made, self.gap)
            now = merged(pd.concat([now, made], ignore_index=True) if len(now) else made, self.gap)
        self._keep(now)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802
        now, passed = self._held(), timerValues.getCurrentWatermarkInMs() * 1000
        ended = (now["last_at"] + self.gap <= passed).to_numpy(bool)
        self._keep(now[~ended])
        if ended.any():
            out = now[ended].reset_index(drop=True)
            for i, name in enumerate(self.keys):
                out.insert(i, name, [key[i]] * len(out))
            yield out

    def close(self) -> None:
        pass


def closed_sessions(stream: DataFrame, time: str, keys: Sequence[str], kind: str, value: str, gap_seconds: int, late: str) -> DataFrame:
    """Sessions of each key, each once and when the watermark has passed its end and ``gap_seconds``: the keys, session_start,
    session_end (of its first and its last row), n, total of ``value`` (null counts as 0), and the first and the last ``kind``.

    ``time`` is a timestamp. Rows may come in any order as long as they are no later than ``late``; later ones are dropped and counted
    (see ``late_rows``), and so are rows without a time. Of rows of one time the smallest kind is the first and the greatest the last; a null kind
    is the empty text. State holds one record for each open session, not for each row. Start the stream within ``state_store``.
    """
    need(stream, [time, *keys, kind, value])
    distinct_names([*keys, "session_start", "session_end", *_NAMES])
    rows = stream.where(column(time).isNotNull()).withWatermark(time, late)
    rows = rows.select(*[column(k) for k in keys], column(time), F.unix_micros(column(time)).alias("at"), F.coalesce(column(kind).cast("string"), F.lit("")).alias("kind"), F.coalesce(column(value).cast("double"), F.lit(0.0)).alias("value"))
    schema = T.StructType([*[T.StructField(k, stream.schema[k].dataType) for k in keys], *_SESSION])
    out = rows.groupBy(*[column(k) for k in keys]).transformWithStateInPandas(_Sessions(gap_seconds * 1_000_000, list(keys)), schema, "Append", "EventTime")
    return out.select(*[column(k) for k in keys], F.timestamp_micros("first_at").alias("session_start"), F.timestamp_micros("last_at").alias("session_end"), "n", "total", "first_kind", "last_kind")


def sessions_until(data: DataFrame, time: str, keys: Sequence[str], kind: str, value: str, gap_seconds: int, late: str) -> DataFrame:
    """The same sessions of a table at rest: those that are closed once its last row has come."""
    rows = data.where(column(time).isNotNull()).select(*[column(k) for k in keys], column(time).alias("session_at"), F.coalesce(column(kind).cast("string"), F.lit("")).alias("kind"), F.coalesce(column(value).cast("double"), F.lit(0.0)).alias("value"))
    pair = F.struct("session_at", "kind")
    out = rows.groupBy(F.session_window("session_at", f"{gap_seconds} seconds").alias("w"), *[column(k) for k in keys]).agg(
        F.min("session_at").alias("session_start"), F.max("session_at").alias("session_end"), F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"), F.min(pair)["kind"].alias("first_kind"), F.max(pair)["kind"].alias("last_kind")
    )
    ended = rows.agg(F.date_trunc("millisecond", F.max("session_at") - F.expr(f"interval {late}")).alias("ended"))  # one row
    return out.join(ended, F.col("session_end") + F.expr(f"interval {gap_seconds} seconds") <= F.col("ended")).drop("w", "ended")


def interval_join(left: DataFrame, right: DataFrame, left_time: str, right_time: str, on: Sequence[tuple[str, str]], earliest: str, latest: str, late: str, how: str = "inner") -> DataFrame:
    """Rows of two streams with equal keys whose times are at most so far apart: right_time from left_time + ``earliest`` to left_time + ``latest``.

    Both streams have a watermark of ``late``, so state older than the interval and the watermark goes, and outer rows (``how`` left_outer, right_outer,
    full_outer) come when no partner can come any more. Null keys meet nothing; a name that both sides have is an error.
    Tables at rest can be joined alike.
    """
    need(left, [left_time, *[a for a, _ in on]])
    need(right, [right_time, *[b for _, b in on]])
    distinct_names([*left.columns, *right.columns])
    a, b = left.withWatermark(left_time, late), right.withWatermark(right_time, late)
    meet = (column(right_time) >= column(left_time) + F.expr(f"interval {earliest}")) & (column(right_time) <= column(left_time) + F.expr(f"interval {latest}"))
    for x, y in on:
        meet = (column(x) == column(y)) & meet
    return a.join(b, meet, how)


def late_rows(query: StreamingQuery) -> int:
    """Rows that the query's stateful operators have dropped behind the watermark, over the batches that ``recentProgress`` keeps."""
    return sum(operator["numRowsDroppedByWatermark"] for p in query.recentProgress for operator in p["stateOperators"])
