import hashlib
import random

from pyspark.sql import functions as F

from lumencube.llm import linededup
from lumencube.llm.queries import ORACLES, op5_line_dedup

from .oracle import assert_same

DATA = "/root/testdata/sf0.01"
FOLD = str.maketrans(linededup.UPPER, linededup.LOWER)


def plain(rows, min_chars=40, min_docs=5):
    key = lambda line: line.strip(linededup.SPACE).translate(FOLD)
    seen = {}
    for doc, text in rows:
        for line in (text or "").split("\n"):
            if doc is not None and len(key(line)) >= min_chars:
                seen.setdefault(key(line), set()).add(doc)
    last = {k: max(docs) for k, docs in seen.items() if len(docs) >= min_docs}
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if doc is None or last.get(key(x), doc) == doc]
        out.append((doc, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return out


def test_documents_match_sql(spark):
    assert_same(op5_line_dedup(spark, DATA), ORACLES["op5_line_dedup"], DATA)


def test_small_rows_match_brute_force(spark):
    rng = random.Random(6)
    bits = ["É" * 45, "A" * 44, "  " + "a" * 44 + "\t", "b" * 39, " " + "b" * 39, "x" * 40, "ß" * 20 + "Q" * 25, "ß" * 20 + "q" * 25, "é" * 45, ""]
    rows = [(rng.choice([k, k, k, None]), rng.choice([None, "\n".join(rng.choices(bits, k=rng.randint(0, 6)))])) for k in range(60)]
    rows += [(3, "x" * 40), (3, "x" * 40), (3, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("h1", F.lit(1)).withColumn("n_lines", F.lit("clash")).withColumn("doc", F.lit(0))
    for fanout in (2, 3):
        got = linededup.dedup_lines(docs, batches=5, fanout=fanout)
        assert got.columns == ["doc_id", "text", "h1", "doc", "n_lines", "n_dropped"]
        assert sorted(((r.doc_id, r.text, r.n_lines, r.n_dropped) for r in got.collect()), key=repr) == sorted(plain(rows), key=repr)
    assert linededup.dedup_lines(docs.limit(0)).count() == 0


def test_runs_tell_fresh_lines_and_compact(spark):
    runs = linededup.LineRuns(spark, fanout=2)
    seen, totals = set(), {}
    for k in range(5):
        batch = [(10 * k + d, h, h) for d in range(4) for h in range(k, k + 3 + d)]
        got = {r.h1: r.fresh for r in runs.add(spark.createDataFrame(batch, "doc long, h1 long, h2 long")).collect()}
        assert got == {h: h not in seen for _, h, _ in batch}
        seen |= set(got)
        for doc, h, _ in batch:
            totals.setdefault(h, set()).add(doc)
    assert [len(x) for x in runs.levels] == [1, 0, 1]
    assert {(r.h1, r.docs, r.last) for r in runs.counts().collect()} == {(h, len(d), max(d)) for h, d in totals.items()}


def test_long_text(spark):
    text = ("line of some forty characters and a few more\n" * 50_000).strip()
    docs = spark.createDataFrame([(k, text + f"\n{k}") for k in range(6)], "doc_id long, text string")
    got = {r.doc_id: (r.n_dropped, hashlib.md5(r.text.encode()).hexdigest()) for r in linededup.dedup_lines(docs).collect()}
    assert got[0] == (50_000, hashlib.md5(b"0").hexdigest()) and got[5][0] == 0


def test_runs_merge_without_exchange_and_hold_each_key_fresh_once(spark):
    runs = linededup.LineRuns(spark, fanout=3)
    for k in range(5, 0, -1):
        runs.add(spark.createDataFrame([(10 * k + d, h, -h) for d in range(3) for h in range(0, 40, k)], "doc long, h1 long, h2 long"))
    assert [len(x) for x in runs.levels] == [2, 1]
    assert all(r["count"] == 1 for r in runs.rows().where("fresh").groupBy("h1", "h2").count().collect())
    first = {h: max(k for k in range(1, 6) if h % k == 0) for h in range(40)}
    assert {(r.h1, r.last) for r in runs.survivors(1).collect()} == {(h, 10 * k + 2) for h, k in first.items()}
    for frame in (runs.counts(), runs.survivors(2)):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert "Bucketed: true" in plan and "Exchange" not in plan


def test_many_distinct_lines_go_in_linear_time(spark):
    text = "\n".join(f"line number {k} of some forty characters and a few more" for k in range(30_000))
    docs = spark.createDataFrame([(k, f"{text}\n{k}") for k in range(5)], "doc_id long, text string")
    got = {r.doc_id: r.n_dropped for r in linededup.dedup_lines(docs).collect()}
    assert got == {0: 30_000, 1: 30_000, 2: 30_000, 3: 30_000, 4: 0}
