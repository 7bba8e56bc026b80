import random

import pytest
from pyspark.sql import functions as F
from hypothesis import given, settings
from hypothesis import strategies as st

from lumencube.sources import ntriples, turtle_sink
from lumencube.sources.predicates import PredicateStore
from lumencube.sources.turtle import COLUMNS, RDF, XSD, n_triples, parse, read_turtle

SCHEMA = "s string, p string, o string, o_kind string, datatype string, lang string"
ODD = 'tab\t quote" back\\slash new\nline return\r é 😀 \b\f . <x> _:b @en ^^ #no comment'


def some(n=60, seed=1):
    rng = random.Random(seed)
    subjects = [f"http://ex/s{k}" for k in range(6)] + ["_:b1", "http://ex/with%20odd(name)", "http://ex/ns#x.y"]
    rows = set()
    for _ in range(n):
        o = rng.choice([("http://ex/o", "iri", None, None), ("_:b2", "bnode", None, None), (ODD, "literal", XSD + "string", None), ("", "literal", XSD + "string", None), ("1", "literal", XSD + "integer", None), ("ciao", "literal", None, "it-x-own"), ('\\u00e9 "', "literal", XSD + "string", None), ("x" * 50, "literal", "http://ex/type", None)])
        rows.add((rng.choice(subjects), rng.choice(["http://ex/p", RDF + "type", "http://ex/q#r"]), *o))
    return sorted(rows, key=str)


def as_set(frame, columns=COLUMNS):
    rows = [tuple(r) for r in frame.select(*columns).collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def test_ntriples_round_trip_and_forms(spark, tmp_path):
    rows = some()
    n_triples(spark.createDataFrame(rows, SCHEMA)).write.text(str(tmp_path / "a"))
    assert as_set(ntriples.read_ntriples(spark, str(tmp_path / "a"))) == set(rows)
    text = '# a comment\n\n  \t\n<http://a>\t<http://p>"x"@en-GB.# end "quoted"\r\n<http://a><http://p><http://b>.\r_:x <http://p> "\\u00E9\\U0001F600\\t\\\\\\"\'" .\n<http://\\u00e9> <http://p> "5"^^<http://t\\u0065> . # c\n<http://a> <http://p> _:y.z .\n<http://a> <http://p> "in <g> ." <http://g> .\n<http://a> <http://p> <http://b> _:g .\n'
    (tmp_path / "b.nt").write_text(text, encoding="utf-8", newline="")
    got = {tuple(r) for r in ntriples.read_quads(spark, str(tmp_path / "b.nt")).collect()}
    assert got == {
        ("http://a", "http://p", "x", "literal", None, "en-GB", None),
        ("http://a", "http://p", "http://b", "iri", None, None, None),
        ("_:x", "http://p", "é😀\t\\\"'", "literal", XSD + "string", None, None),
        ("http://é", "http://p", "5", "literal", "http://te", None, None),
        ("http://a", "http://p", "_:y.z", "bnode", None, None, None),
        ("http://a", "http://p", "in <g> .", "literal", XSD + "string", None, "http://g"),
        ("http://a", "http://p", "http://b", "iri", None, None, "_:g"),
    }


def test_lines_that_are_no_triples(spark):
    bad = ['<http://a> <http://p> "x"', '<http://a> "p" <http://b> .', '<http://a> <http://p> "x" y .', "<http://a> <http://p> .", "a b c .", '<http://a> <http://p> "open .', '"s" <http://p> <http://o> .', '<http://a> <http://p> "x"@ .', "<http://a b> <http://p> <http://o> ."]
    good = "<http://a> <http://p> <http://o> ."
    lines = spark.createDataFrame([(x,) for x in [*bad, good]], "value string")
    assert [r.o for r in ntriples.parsed(lines, "skip").collect()] == ["http://o"]
    for line in bad:
        with pytest.raises(Exception, match="not a triple"):
            ntriples.parsed(spark.createDataFrame([(line,)], "value string")).collect()
    with pytest.raises(ValueError):
        ntriples.parsed(lines, "drop")


def test_a_document_is_split_and_long_literals_are_no_problem(spark, tmp_path):
    rows = [(f"http://ex/s{k}", "http://ex/p", f"{k} " * 50, "literal", XSD + "string", None) for k in range(3000)]
    rows.append(("http://ex/long", "http://ex/p", '"\n' * 40_000, "literal", XSD + "string", None))
    n_triples(spark.createDataFrame(rows, SCHEMA).coalesce(1)).write.text(str(tmp_path / "one"))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        quads = ntriples.read_quads(spark, str(tmp_path / "one"))
        assert quads.rdd.getNumPartitions() > 5
        got = {r.s: r.o for r in quads.collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got == {r[0]: r[2] for r in rows}
    plan = quads._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_quads_keep_their_graphs(spark, tmp_path):
    rows = [(*r, g) for r in some(20) for g in (None, "http://g/1", "_:g")]
    frame = spark.createDataFrame(rows + rows[:5], SCHEMA + ", graph string")
    ntriples.write_quads(frame, str(tmp_path / "q"))
    assert as_set(ntriples.read_quads(spark, str(tmp_path / "q")), [*COLUMNS, "graph"]) == set(rows)


@given(st.text(max_size=30), st.sampled_from(["literal", "iri"]))
@settings(max_examples=200, deadline=None)
def test_turtle_terms_are_parsed_back(text, kind):
    text = text.encode("utf-8", "ignore").decode()
    value = text if kind == "literal" else "http://ex/" + text
    said = turtle_sink.Terms(turtle_sink.PREFIXES | {"ex": "http://ex/"}).object(value, kind, XSD + "string" if kind == "literal" else None, None)
    [got] = parse(f"@prefix ex: <http://ex/> . <http://s> <http://p> {said} .")
    assert got[2:4] == (value, kind)


def test_turtle_files_say_the_same_set(spark, tmp_path):
    rows = some(80, 2)
    frame = spark.createDataFrame(rows + rows[:9] + [("http://ex/s1", "http://ex/p", None, "iri", None, None)], SCHEMA)
    kept = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        turtle_sink.write_turtle(frame, str(tmp_path / "t"), {"ex": "http://ex/", "n": "http://ex/ns#"})
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)
    files = sorted((tmp_path / "t").glob("*.ttl"))
    texts = [f.read_text() for f in files]
    assert len([t for t in texts if t]) > 3 and any("    a " in t and "ex:o" in t for t in texts) and any("    " in t and " ;" in t and " ," in t for t in texts)
    assert as_set(read_turtle(spark, str(tmp_path / "t"), one_document=True)) == set(rows)
    assert read_turtle(spark, str(tmp_path / "t")).count() >= len(rows)  # each file's blank nodes are its own
    with pytest.raises(ValueError):
        turtle_sink.turtle_lines(frame, {"bad prefix": "http://x/"})
    turtle_sink.write_turtle(frame.limit(0), str(tmp_path / "none"))
    assert read_turtle(spark, str(tmp_path / "none")).count() == 0


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    frame = spark.createDataFrame(some(90, 3) + [("http://ex/s1", "http://ex/only", "1", "literal", None, None), (None, "http://ex/p", "x", "iri", None, None)], SCHEMA)
    return PredicateStore.build(frame, str(tmp_path_factory.mktemp("store") / "s"), buckets=4)


def test_store_keeps_the_set(spark, store):
    want = set(some(90, 3)) | {("http://ex/s1", "http://ex/only", "1", "literal", XSD + "string", None)}
    assert as_set(store.triples()) == want
    assert as_set(PredicateStore.open(spark, store.path).triples()) == want
    ids = [r.id for r in store.terms.collect()]
    assert len(ids) == len(set(ids))
    assert store.number("ciao", "literal", lang="it-x-own") is not None and store.number("ciao", "literal") is None and store.number("http://none") is None
    got = {(r.s, r.o) for r in store.decoded(store.pairs("http://ex/q#r"), "s", "o").collect()}
    assert got == {(r[0], r[2]) for r in want if r[1] == "http://ex/q#r"}
    assert store.pairs("http://ex/nothing").count() == 0


def test_star_has_no_exchange_and_reads_its_predicates(spark, store):
    patterns = {"a": "http://ex/p", "b": RDF + "type", "c": "http://ex/q#r", "d": "http://ex/only"}
    rows = set(some(90, 3)) | {("http://ex/s1", "http://ex/only", "1", "literal", XSD + "string", None)}
    of = lambda s, p: [r[2:] for r in rows if r[0] == s and r[1] == p]
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for optional in ((), ("d",)):
            star = store.star(patterns, optional)
            plan = star._jdf.queryExecution().executedPlan().toString()
            assert "Exchange" not in plan and plan.count("SortMergeJoin") == 3 and plan.count("PartitionFilters: [isnotnull(p") == 4
            want = sum(len(of(s, patterns["a"])) * len(of(s, patterns["b"])) * len(of(s, patterns["c"])) * (len(of(s, patterns["d"])) or len(optional)) for s in {r[0] for r in rows})
            assert star.count() == want > 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    got = store.decoded(store.star({"a": patterns["d"], "b": "http://ex/p"}), "subject", "a").collect()
    assert {(r.subject, r.a) for r in got} == {("http://ex/s1", "1")}
    for bad in ({}, patterns):
        with pytest.raises(ValueError):
            store.star(bad, ["a"])


def test_rare_predicates_share_a_partition(spark, tmp_path, monkeypatch):
    from lumencube.sources import predicates

    monkeypatch.setattr(predicates, "MOST_PREDICATES", 1)
    rows = some(90, 4)
    store = PredicateStore.build(spark.createDataFrame(rows, SCHEMA), str(tmp_path / "s"), buckets=2)
    assert len(store.predicates) == 1 and as_set(store.triples()) == set(rows)
    for p in ("http://ex/p", RDF + "type", "http://ex/q#r"):
        assert store.pairs(p).count() == sum(r[1] == p for r in rows)
    assert store.pairs("http://ex/nothing").count() == 0
    store.close()
    empty = PredicateStore.build(spark.createDataFrame([], SCHEMA), str(tmp_path / "e"), buckets=2)
    assert empty.triples().count() == 0


@pytest.mark.parametrize("kind", ["quads", "turtle"])
def test_writers_hold_a_share_in_each_task(spark, tmp_path, monkeypatch, kind):
    """One partition that makes many rows is dealt out before repeated ones are left out, and files are as many."""
    from lumencube import scratch

    monkeypatch.setattr(scratch, "PART_ROWS", 50)
    frame = spark.createDataFrame([(f"http://ex/{k % 500}", f"http://ex/p{k % 5}", "x", "literal", None, None) for k in range(1000)], SCHEMA).coalesce(1)
    if kind == "quads":
        ntriples.write_quads(frame.withColumn("graph", F.concat("p", F.lit("/g"))), str(tmp_path / "t"))
        assert ntriples.read_quads(spark, str(tmp_path / "t")).count() == 500
    else:
        turtle_sink.write_turtle(frame, str(tmp_path / "t"))
        assert read_turtle(spark, str(tmp_path / "t"), one_document=True).count() == 500
    assert len([p for p in (tmp_path / "t").iterdir() if p.name.startswith("part-")]) > 10


def test_store_holds_a_share_in_each_task(spark, tmp_path, monkeypatch):
    """Buckets follow the triples, and rows with a frequent object or with none are spread when numbers become terms."""
    from lumencube import scratch

    monkeypatch.setattr(scratch, "PART_ROWS", 200)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = [(f"http://ex/s{k}", "http://ex/kind", "http://ex/one", "iri", None, None) for k in range(2000)]
        rows += [(f"http://ex/s{k}", "http://ex/name", f"n{k}", "literal", XSD + "string", None) for k in range(0, 2000, 4)]
        store = PredicateStore.build(spark.createDataFrame(rows, SCHEMA), str(tmp_path / "s"), buckets=2)
        assert store.manifest["buckets"] == 13 and as_set(store.triples()) == set(rows)
        got = store.decoded(store.star({"kind": "http://ex/kind", "name": "http://ex/name"}, ["name"]), "subject", "kind", "name")
        assert {tuple(r) for r in got.collect()} == {(f"http://ex/s{k}", "http://ex/one", None if k % 4 else f"n{k}") for k in range(2000)}
        for frame in (got, store.triples()):
            assert "ENSURE_REQUIREMENTS" not in frame._jdf.queryExecution().executedPlan().toString()  # rows are dealt out once for each join
            assert max(r["count"] for r in frame.groupBy(F.spark_partition_id().alias("part")).count().collect()) < 500
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
