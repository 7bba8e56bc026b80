import uuid

import pytest
from pyspark.sql import functions as F

from lumencube.core import Dataset, Pipeline
from lumencube.operators.observations import EmitObservations
from lumencube.operators.link import LinkProvinceByAcronym
from lumencube.operators.rows import DropDuplicateRows, FilterRows, LeftJoinEnrich


def jobs(spark, run):
    group = uuid.uuid4().hex
    spark.sparkContext.setJobGroup(group, "counted")
    try:
        out = run()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return out, len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


@pytest.fixture
def parts(spark):
    data = spark.createDataFrame([(k % 7, k % 3, float(k)) for k in range(50)] * 2, "id int, kind int, x double")
    names = spark.createDataFrame([(0, "zero"), (1, "one")], "code int, name string")
    dimension = spark.createDataFrame([("u0", "Zero", "000", "ZE"), ("u1", "One", "001", "ON")], "uri string, label string, istat string, acronym string")
    steps = [
        FilterRows(lambda d: d["x"] >= 10),
        DropDuplicateRows(),
        LeftJoinEnrich(names, "kind", "code", ["name"]),
        LinkProvinceByAcronym("short", dimension),
        EmitObservations("http://ex/cube", "http://ex/dsd", "http://ex/o-{id}-{x}", {"istat": "http://ex/province"}, measures={"x": "http://ex/x"}),
    ]
    return Dataset(data.withColumn("short", F.when(F.col("kind") == 0, "ze").when(F.col("kind") == 1, "on"))), steps


def metrics(done):
    return [{k: v for k, v in r.metrics.items() if k != "triples_written"} for r in done.history]


#: LinkProvinceByAcronym writes codice_istat; the observation's dimension is read from it.
def pipeline(steps, **options):
    steps[-1].dimensions = {"codice_istat": ("http://ex/province", None)}
    return Pipeline(steps, on_error="raise", **options)


def test_the_writing_job_measures_every_step(spark, parts, tmp_path):
    data, steps = parts
    plain = pipeline(steps).run(data)
    want = metrics(plain)
    assert want[0] == {"rows_before": 100, "rows_after": 80, "rows_removed": 20} and want[1] == {"removed_count": 40}
    assert want[2] == {"matched": 27, "unmatched": 13} and want[3]["unmatched"] == 13 and want[4]["observations_emitted"] == 27
    done = pipeline(steps, observed=True).run(data)
    _, written = jobs(spark, lambda: done.to_parquet(str(tmp_path / "a.parquet")))
    counted = [r for r in done.history if r.name in ("FilterRows", "DropDuplicateRows", "LeftJoinEnrich")]
    _, more = jobs(spark, lambda: [r.metrics for r in counted])
    assert written >= 1 and more == 0
    assert metrics(done) == want


def test_reading_metrics_first_runs_one_pass(spark, parts):
    data, steps = parts
    done = Pipeline(steps[:2], on_error="raise", observed=True).run(data)
    _, first = jobs(spark, lambda: done.history[1].metrics)
    _, rest = jobs(spark, lambda: done.history[0].metrics)
    assert first >= 1 and rest == 0
    assert done.history[0].metrics["rows_removed"] == 20 and done.history[1].metrics["removed_count"] == 40


def test_a_few_rows_are_not_counted_as_all(spark, parts):
    data, steps = parts
    done = Pipeline(steps[:2], on_error="raise", observed=True).run(data)
    assert len(done.head(3)) == 3
    assert done.history[0].metrics["rows_before"] == 100
    assert Dataset(data.data).observed().head(2).shape[0] == 2
