import pytest
from pyspark.sql import functions as F

from lumencube.core import ColumnStep, Dataset, History, Pipeline, PipelineStep, Recipe, StepRecord
from lumencube.operators.columns import CastTypes, DropEmptyColumns, FillMissing, NormalizeColumnNames
from lumencube.operators.rows import DropDuplicateRows


@pytest.fixture(scope="module")
def dirty(spark):
    rows = [(1, "Ada L", 30.0, None, "x"), (2, "Bob", None, None, "y"), (2, "Bob", None, None, "y"), (3, "Cid", 50.0, None, "z"), (4, "Dee", 40.0, None, None)]
    return Dataset(spark.createDataFrame(rows, '`ID` bigint, `Full Name` string, `Age` double, `EmptyCol` string, `City ` string'))


class Double(ColumnStep):
    def transform_column(self, column, name):
        return column * 2


class Broken(PipelineStep):
    def apply(self, dataset):
        raise RuntimeError("broken")


def test_dataset_and_history(dirty):
    with pytest.raises(TypeError):
        Dataset([1])
    assert dirty.shape == (5, 5) and len(dirty.head(2)) == 2 and len(dirty.history) == 0
    with pytest.raises(ValueError):
        dirty.with_data(dirty.data)
    with pytest.raises(ValueError):
        dirty.with_data(dirty.data, step_name="a", step_record=StepRecord("b"))
    new = dirty.with_columns_renamed({"ID": "Age", "Age": "ID"})
    assert new.columns[0] == "Age" and new.history[0].name == "rename" and dirty.columns[0] == "ID"
    with pytest.raises(KeyError):
        dirty.with_columns_renamed({"nope": "x"})
    h = History().append(StepRecord("a")).append(StepRecord("b"))
    assert [r.name for r in h] == ["a", "b"] and len(h) == 2 and h[1].name == "b" and repr(h) == "History(a, b)"


def test_metrics_are_measured_once_and_only_when_read():
    calls = []
    record = StepRecord("x", measure=lambda: calls.append(1) or {"n": 1})
    assert not calls
    assert record.metrics == {"n": 1} == record.metrics and calls == [1]


def test_quickstart_pipeline_and_profile(dirty):
    report = dirty.profile()
    assert (report.rows, report.duplicate_rows, report.empty_columns) == (5, 1, ["EmptyCol"])
    assert report.non_snake_case == ["ID", "Full Name", "Age", "EmptyCol", "City "] and "duplicate rows: 1" in str(report)
    assert dirty.profile(high_null_threshold=0.3).high_null_columns == {"Age": pytest.approx(0.4)}
    steps = [NormalizeColumnNames(), DropEmptyColumns(), DropDuplicateRows(), FillMissing("age", "median")]
    done = Pipeline(steps, on_error="raise").run(dirty)
    assert done.columns == ["id", "full_name", "age", "city"] and {r.id: r.age for r in done.data.collect()} == {1: 30.0, 2: 40.0, 3: 50.0, 4: 40.0}
    assert [r.name for r in done.history] == ["NormalizeColumnNames", "DropEmptyColumns", "DropDuplicateRows", "FillMissing"]
    assert done.history[0].metrics["renamed_count"] == 5 and done.history[2].metrics == {"removed_count": 1} and done.history[3].metrics == {"filled_per_column": {"age": 1}}


def test_pipeline_error_modes(dirty, monkeypatch):
    with pytest.raises(TypeError):
        Pipeline().add("step")
    with pytest.raises(ValueError):
        Pipeline(on_error="ignore")
    with pytest.raises(RuntimeError):
        Pipeline([Broken()], on_error="raise").run(dirty)
    kept = Pipeline(on_error="skip").add(Broken()).add(Double("Age")).run(dirty)
    assert [r.name for r in kept.history] == ["Double"] and kept.history[0].params == {"columns": ["Age"]}
    said = iter(["what", "c", "a"])
    monkeypatch.setattr("builtins.input", lambda _: next(said))
    assert len(Pipeline([Broken()]).run(dirty).history) == 0
    with pytest.raises(RuntimeError):
        Pipeline([Broken()]).run(dirty)
    lazy = Pipeline([CastTypes({"City ": "int"})], on_error="skip", eager=True).run(dirty)
    assert len(lazy.history) == 0


def test_column_step_and_recipe(dirty):
    with pytest.raises(KeyError):
        Double("nope").apply(dirty)

    class Twice(Recipe):
        def build(self):
            return Pipeline([Double(["ID", "Age"])], on_error="raise")

    got = Twice().apply(dirty)
    assert sorted(r.ID for r in got.data.collect()) == [2, 4, 4, 6, 8]
    assert got.data.agg(F.sum("Age")).first()[0] == 240.0
