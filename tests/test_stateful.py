import datetime as dt

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lumencube.streaming import stateful

SCHEMA = "id long, user string, ts timestamp, kind string, value double"
START = dt.datetime(2024, 1, 1)


def at(minutes):
    return START + dt.timedelta(minutes=minutes)


@given(st.lists(st.tuples(st.integers(0, 120), st.sampled_from("abc"), st.integers(0, 9)), max_size=25), st.integers(1, 20), st.integers(0, 25))
@settings(max_examples=200, deadline=None)
def test_sessions_merge_in_any_pieces(rows, gap, cut):
    def sessions(some):
        frame = pd.DataFrame({"first_at": [r[0] for r in some], "last_at": [r[0] for r in some], "n": 1, "total": [float(r[2]) for r in some], "first_kind": [r[1] for r in some], "last_kind": [r[1] for r in some]})
        return stateful.merged(frame, gap)

    want = []
    for t, kind, v in sorted(rows):
        if want and t - want[-1][1] < gap:
            want[-1] = (want[-1][0], t, want[-1][2] + 1, want[-1][3] + v, want[-1][4], kind)
        else:
            want.append((t, t, 1, float(v), kind, kind))
    halves = [sessions(x) for x in (rows[:cut], rows[cut:]) if x]
    got = stateful.merged(pd.concat(halves, ignore_index=True), gap) if halves else []
    assert [tuple(r) for r in got.itertuples(index=False)] == want if rows else not len(got)


class Stream:
    """A folder of files that come one by one, and a query over it that can be started again."""

    def __init__(self, spark, place):
        self.spark, self.place = spark, place

    def add(self, rows):
        self.spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(f"{self.place}/in")

    def read(self):
        return self.spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{self.place}/in")

    def run(self, make):
        with stateful.state_store(self.spark):
            frame = make(self.read())
            query = frame.writeStream.format("parquet").option("checkpointLocation", f"{self.place}/state").option("path", f"{self.place}/out").trigger(availableNow=True).start()
            query.awaitTermination(180)
        return query, self.spark.read.schema(frame.schema).parquet(f"{self.place}/out")


def sessions(stream):
    return stateful.closed_sessions(stream, "ts", ["user"], "kind", "value", 600, "30 minutes")


def test_stream_equals_batch_after_a_restart_and_counts_late_rows(spark, tmp_path):
    rng = np.random.default_rng(3)
    rows = [(k, rng.choice(["ann", "bob", None]), at(float(m)), rng.choice(["x", "y", None]), float(rng.integers(9)) if k % 7 else None) for k, m in enumerate(rng.uniform(0, 600, 300))]
    rows = [(i, None if u == "None" else u, t, None if k == "None" else k, v) for i, u, t, k, v in rows]
    rows = [(i, str(u) if u else None, t, str(k) if k else None, v) for i, u, t, k, v in rows] + [(999, "ann", None, "x", 1.0)]
    early, late = [r for r in rows if r[2] is None or r[2] < at(300)], [r for r in rows if r[2] and r[2] >= at(300)]
    stream = Stream(spark, str(tmp_path))
    stream.add(early)
    query, got = stream.run(sessions)
    first = got.count()
    assert first > 0 and stateful.late_rows(query) == 0
    stream.add(late)
    query, got = stream.run(sessions)  # a new query, from the checkpoint
    want = stateful.sessions_until(spark.createDataFrame(rows, SCHEMA), "ts", ["user"], "kind", "value", 600, "30 minutes")
    assert want.columns == got.columns and got.count() > first
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    stream.add([(1000 + k, "ann", at(m), "z", 1.0) for k, m in enumerate((1, 2, 50))])
    query, again = stream.run(sessions)
    assert stateful.late_rows(query) == 3 and again.where("first_kind = 'z'").count() == 0
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass", "").endswith("RocksDBStateStoreProvider") is False


@pytest.mark.parametrize("how", ["inner", "left_outer"])
def test_streams_joined_within_an_interval(spark, tmp_path, how):
    rng = np.random.default_rng(4)
    rows = [(k, str(rng.choice(["ann", "bob"])), at(float(m)), str(rng.choice(["ask", "buy"])), 0.0) for k, m in enumerate(sorted(rng.uniform(0, 900, 120)))]
    rows.append((500, None, at(901.0), "ask", 0.0))
    split = lambda data: (data.where("kind = 'ask'").select("id", "user", "ts"), data.where("kind = 'buy'").select(F.col("id").alias("other"), F.col("user").alias("who"), F.col("ts").alias("then")))
    join = lambda data: stateful.interval_join(*split(data), "ts", "then", [("user", "who")], "-5 minutes", "20 minutes", "10 minutes", how)
    stream = Stream(spark, str(tmp_path))
    stream.add(rows[:60])
    stream.add(rows[60:])
    _, got = stream.run(join)
    want = {(a[0], b[0]) for a in rows for b in rows if a[3] == "ask" and b[3] == "buy" and a[1] == b[1] and a[1] and dt.timedelta(minutes=-5) <= b[2] - a[2] <= dt.timedelta(minutes=20)}
    pairs = [(r.id, r.other) for r in got.collect()]
    assert len(pairs) == len(set(pairs)) and {p for p in pairs if p[1] is not None} == want
    alone = {p[0] for p in pairs if p[1] is None}
    if how == "left_outer":  # all that can have no partner any more; the last ones still wait
        lonely = {a[0] for a in rows if a[3] == "ask"} - {a for a, _ in want}
        assert alone <= lonely and len(alone) > len(lonely) - 12
    assert {(r.id, r.other) for r in join(spark.createDataFrame(rows, SCHEMA)).collect() if r.other is not None} == want


def test_errors(spark):
    data = spark.createDataFrame([(1, "a", START, "k", 1.0)], SCHEMA)
    with pytest.raises(KeyError):
        stateful.closed_sessions(data, "no", ["user"], "kind", "value", 1, "1 hour")
    with pytest.raises(ValueError):
        stateful.closed_sessions(data.withColumnRenamed("user", "n"), "ts", ["n"], "kind", "value", 1, "1 hour")
    with pytest.raises(ValueError):
        stateful.interval_join(data, data, "ts", "ts", [("user", "user")], "0 seconds", "1 hour", "1 hour")
