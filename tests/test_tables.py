import pytest

from lumencube.core import Dataset
from lumencube.functions import tables
from lumencube.operators.reshape import PairedUnpivot
from lumencube.sources.turtle import parse


@pytest.fixture
def sql(spark):
    tables.register(spark)
    return spark.sql


def test_unpivot_equals_the_step(spark, sql):
    wide = spark.createDataFrame([("x", 1, 2.0, 3, None), ("y", None, 5.0, 6, 7.0), (None, None, None, None, None)], "`k.ey` string, n_a int, m_a double, n_b int, m_b double")
    wide = wide.withColumnRenamed("k.ey", "key")
    wide.createOrReplaceTempView("wide")
    got = sql("""SELECT * FROM paired_unpivot(TABLE(wide), 'key', 'part', '{"a": {"n": "n_a", "m": "m_a"}, "b": {"n": "n_b", "m": "m_b"}}')""")
    want = PairedUnpivot({"a": {"n": "n_a", "m": "m_a"}, "b": {"n": "n_b", "m": "m_b"}}, ["key"], "part").apply(Dataset(wide)).data
    assert got.dtypes == want.dtypes
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and got.count() == 6
    assert sql("""SELECT * FROM paired_unpivot(TABLE(SELECT * FROM wide WHERE key = 'none'), 'key', 'part', '{"a": {"n": "n_a"}}')""").count() == 0
    for keep, label, groups in (("no", "part", '{"a": {"n": "n_a"}}'), ("key", "key", '{"a": {"n": "n_a"}}'), ("key", "part", "{}"), ("key", "part", '{"a": {"n": "n_a"}, "b": {"x": "n_b"}}'), ("key", "part", '{"a": {"n": "n_a"}, "b": {"n": "m_b"}}')):
        with pytest.raises(Exception, match="missing|duplicate|same new columns|differ in type"):
            sql(f"SELECT * FROM paired_unpivot(TABLE(wide), '{keep}', '{label}', '{groups}')").collect()


def test_turtle_documents(spark, sql):
    text = '@prefix ex: <http://ex/> . ex:a ex:b "c"@it, 5 ; a ex:T . [ ex:p ex:q ] ex:r _:n .'
    spark.createDataFrame([("one", text), ("two", "<http://x> <http://y> <http://z> ."), ("none", None), ("empty", "")], "name string, body string").createOrReplaceTempView("docs")
    got = sql("SELECT * FROM turtle_triples(TABLE(docs), 'name', 'body')")
    assert {tuple(r)[1:] for r in got.where("document = 'one'").collect()} == set(parse(text, "one"))
    assert got.where("document = 'two'").count() == 1 and got.count() == len(set(parse(text, "one"))) + 1
    spark.createDataFrame([("bad", "no turtle")], "name string, body string").createOrReplaceTempView("bad_docs")
    with pytest.raises(Exception, match="bad"):
        sql("SELECT * FROM turtle_triples(TABLE(bad_docs), 'name', 'body')").collect()


def test_value_runs(spark, sql):
    rows = [("a", 1, "x"), ("a", 3, "y"), ("a", 2, "x"), ("a", 4, "x"), ("a", None, "x"), ("b", 1, None), ("b", 2, None), ("b", 3, "x"), (None, 5, "z"), (None, 4, "z"), ("a", 4, "x")]
    spark.createDataFrame(rows, "k string, t int, v string").repartition(3).createOrReplaceTempView("states")
    got = sql("SELECT * FROM value_runs(TABLE(states), 'k', 't', 'v')")
    assert sorted(map(tuple, got.collect()), key=str) == sorted([("a", "x", None, 2, 3), ("a", "y", 3, 3, 1), ("a", "x", 4, 4, 2), ("b", None, 1, 2, 2), ("b", "x", 3, 3, 1), (None, "z", 4, 5, 2)], key=str)
    with pytest.raises(Exception, match="missing"):
        sql("SELECT * FROM value_runs(TABLE(states), 'k', 'no', 'v')").collect()
