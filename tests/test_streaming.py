import pytest
from pyspark.sql import functions as F

from lumencube.operators.columns import CastTypes, FillMissing, WithColumn
from lumencube.operators.rows import DropDuplicateRows, FilterRows, LeftJoinEnrich
from lumencube.streaming.steps import apply_steps, drop_duplicates, sessions, windowed

DATA = "/root/testdata/sf0.001"


def drained(frame, name, mode="append"):
    query = frame.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start()
    query.awaitTermination(120)
    return frame.sparkSession.table(name)


@pytest.fixture(scope="module")
def stream(spark, tmp_path_factory):
    place = str(tmp_path_factory.mktemp("events"))
    events = spark.read.parquet(f"{DATA}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    events.write.mode("overwrite").parquet(place)
    return spark.readStream.schema(events.schema).parquet(place), events


def test_stateless_steps(spark, stream):
    live, still = stream
    names = spark.createDataFrame([("click", 1), ("view", 2)], "kind string, code int")
    steps = [FilterRows(lambda d: d["value"] > 10), CastTypes({"user_id": "str"}), WithColumn("x", 1), LeftJoinEnrich(names, "event_type", "kind", ["code"])]
    got = drained(apply_steps(live, steps), "stateless")
    want = apply_steps(still, steps)
    assert got.exceptAll(want).count() == 0 and got.count() == want.count() > 0
    for step in (FillMissing("value"), DropDuplicateRows()):
        with pytest.raises(TypeError):
            apply_steps(live, [step])


def test_windows_duplicates_sessions(stream):
    live, still = stream
    got = drained(windowed(live, "ts", ["event_type"], "1 day", "1 hour", "value"), "windows", "complete")
    assert got.agg(F.sum("n")).first()[0] == still.count()
    assert got.count() == still.select(F.window("ts", "1 day"), "event_type").distinct().count()
    once = drained(drop_duplicates(live, ["event_id"], "ts", "1 hour"), "once")
    assert once.count() == still.select("event_id").distinct().count()
    rows = drained(sessions(live, "ts", ["user_id"], "10 minutes", "1 hour"), "sessions", "complete")
    assert rows.agg(F.sum("n")).first()[0] == still.count()
