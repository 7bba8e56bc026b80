import json
import threading

import pytest

from lumencube.core import Dataset
from lumencube.sources import files
from lumencube.sources.sinks import GraphStore, write_history
from lumencube.sources.versions import Conflict, Versions

SCHEMA = "s string, p string, o string, o_kind string, datatype string, lang string"


@pytest.fixture
def rows(spark):
    return lambda *xs: spark.createDataFrame([(f"http://ex/{x}", "http://ex/p", x, "literal", None, None) for x in xs], SCHEMA)


def names(frame):
    return sorted(r.o for r in frame.collect())


def test_versions_stay_readable(spark, tmp_path, rows):
    store = GraphStore(spark, str(tmp_path / "g"))
    assert store.graphs() == [] and store.read().count() == 0 and store.versions.latest() == 0
    first = store.put("a", rows("x", "x", "y"))
    before = store.read("a")
    second = store.put("a", rows("z"))
    store.post("a", rows("z", "w"))
    store.put("a name/with ?=signs", rows("q"))
    assert names(before) == ["x", "y"]  # opened before the change
    assert names(store.read("a", first)) == ["x", "y"] and names(store.read("a", second)) == ["z"] and names(store.read("a")) == ["w", "z"]
    assert names(store.read(version=second)) == ["z"] and names(store.read()) == ["q", "w", "z"]
    store.drop("a")
    assert store.graphs() == ["a name/with ?=signs"] and names(store.read("a")) == []
    with pytest.raises(KeyError):
        store.drop("a")
    with pytest.raises(KeyError):
        store.read(version=99)
    assert store.versions.vacuum() == 3
    assert names(store.read()) == ["q"]
    with pytest.raises(ValueError):
        store.versions.vacuum(0)


def test_half_a_put_is_not_seen(spark, tmp_path, rows):
    store = GraphStore(spark, str(tmp_path / "g"))
    store.put("a", rows("old"))
    folder = store.versions.write(rows("new"))  # written, but not published
    assert names(store.read("a")) == ["old"] and store.versions.latest() == 1
    (tmp_path / "g" / "versions" / "000000000002.json.x.tmp").write_text("{")  # a writer that died while publishing
    assert store.versions.latest() == 1
    store.versions.publish(1, {"a": [folder]})
    assert names(store.read("a")) == ["new"]


def test_of_two_writers_one_is_refused(spark, tmp_path, rows):
    store = GraphStore(spark, str(tmp_path / "g"))
    base = store.put("a", rows("one"))
    store.put("a", rows("two"), base=base)
    with pytest.raises(Conflict):
        store.put("a", rows("three"), base=base)
    with pytest.raises(Conflict):
        store.post("a", rows("four"), base=base)
    assert names(store.read("a")) == ["two"]
    assert store.put("b", rows("five"), base=base) == base + 2  # another graph is no conflict
    assert names(store.read()) == ["five", "two"]


def test_writers_at_once(spark, tmp_path):
    store = Versions(spark, str(tmp_path / "v"), lambda c: set())
    said = []

    def write(k):
        try:
            said.append(("ok", k, store.publish(0, {"k": k})))
        except Conflict:
            said.append(("refused", k, None))

    threads = [threading.Thread(target=write, args=(k,)) for k in range(8)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    won = [k for what, k, _ in said if what == "ok"]
    assert len(said) == 8 and len(won) == 1 and store.content()["k"] in won and store.numbers() == [1]


def test_history_goes_through_sparks_file_systems(spark, tmp_path):
    data = Dataset(spark.range(3).toDF("a"))
    place = write_history(data, f"file://{tmp_path}/x.parquet")
    assert place == f"file://{tmp_path}/x.history.json"
    assert json.loads(files.read_text(spark, place))["rows"] == 3
    assert json.loads((tmp_path / "x.history.json").read_text())["columns"] == ["a"]
