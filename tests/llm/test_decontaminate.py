import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from lumencube.llm import decontaminate
from lumencube.llm.common import shared_dir
from lumencube.llm.queries import op4_benchmark_leaks

DATA = "/root/testdata/sf0.01"


def plain_tile(item, doc, least):
    """Greedy string tiling by its definition: the longest match of free tokens, again and again."""
    item_free, doc_free, covered = [True] * len(item), [True] * len(doc), []
    while True:
        best = None
        for i in range(len(item)):
            for j in range(len(doc)):
                n = 0
                while i + n < len(item) and j + n < len(doc) and item[i + n] == doc[j + n] and item_free[i + n] and doc_free[j + n]:
                    n += 1
                if n >= least and (best is None or n > best[0]):
                    best = (n, i, j)
        if best is None:
            return covered
        n, i, j = best
        item_free[i : i + n] = doc_free[j : j + n] = [False] * n
        covered.append(n)


def plain_tokens(text):
    return re.findall(r"\w+", text.lower())


def test_tiles_are_greedy_string_tiling():
    rng = random.Random(8)
    for _ in range(400):
        item = [rng.randint(1, rng.choice([2, 5, 30])) for _ in range(rng.randint(1, 25))]
        doc = [rng.randint(1, 30) for _ in range(rng.randint(0, 20))]
        for _ in range(rng.randint(0, 3)):
            s = rng.randrange(len(item))
            doc += item[s : s + rng.randint(1, 20)] + [rng.randint(1, 30)]
        got = decontaminate.tile(item, doc, 3)
        assert sorted(n for _, _, n in got) == sorted(plain_tile(item, doc, 3))
        for i, j, n in got:
            assert item[i : i + n] == doc[j : j + n]
        for side in (0, 1):
            places = [t[side] + k for t in got for k in range(t[2])]
            assert len(places) == len(set(places))


def test_tokens_of_both_ways_agree():
    for text in ("The CAT_1 sat-on: 'it'", "Été à l’École «ÑANDÚ» — 3²", "İstanbul ŞEHİR", "日本 語x, Ω", "a\x1cb\x0bc", "ÀÉÎ straße"):
        assert [x.decode() for x in decontaminate.tokens(text.encode())] == plain_tokens(text)


def test_documents_match_brute_force(spark):
    docs = {r.doc_id: plain_tokens(r.text) for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    items = {r.item_id: plain_tokens(r.text) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()}
    want = {}
    for key, item in items.items():
        seeds = {tuple(item[k : k + 5]) for k in range(len(item) - 4)}
        for doc, words in docs.items():
            if seeds & {tuple(words[k : k + 5]) for k in range(len(words) - 4)}:
                inside = set(item)
                near = [w if w in inside else k for k, w in enumerate(words)]
                runs = [w for k, w in enumerate(near) if isinstance(w, str) or (k and isinstance(near[k - 1], str))]
                c = sum(plain_tile(item, runs, 5)) / len(item)
                if c >= 0.6:
                    want[doc, key] = c
    got = {(r.doc_id, r.item_id): r.coverage for r in op4_benchmark_leaks(spark, DATA).collect()}
    assert want and got == pytest.approx(want)


def test_reordered_and_edge_cases(spark, monkeypatch):
    item = " ".join(f"w{k}" for k in range(30))
    moved = " ".join(f"w{k}" for k in [*range(20, 30), *range(10, 20), *range(10)])
    rows = [(1, f"intro {moved} outro"), (2, "w0 w1 w2 w3 w4 w5 only"), (3, None), (4, ""), (None, item.upper()), (6, item), (6, item), (7, "tiny one"), (8, "x " * 300_000 + item)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("item_id", F.lit("x")).withColumn("coverage", F.lit(1))
    bench = spark.createDataFrame([(1, item), (1, item), (2, "tiny, one!"), (3, None), (None, item), (4, "  ")], "item_id long, text string").withColumn("doc_id", F.lit(0))
    for block in (8 << 20, 60):
        got = sorted(((r.doc_id, r.item_id, r.coverage) for r in decontaminate.contaminated(docs, bench, block_bytes=block).collect()), key=str)
        assert got == sorted([(1, 1, 1.0), (None, 1, 1.0), (6, 1, 1.0), (6, 1, 1.0), (7, 2, 1.0), (8, 1, 1.0)], key=str)
    assert decontaminate.contaminated(docs.limit(0), bench).count() == 0
    assert decontaminate.contaminated(docs, bench.limit(0)).count() == 0
    partly = {r.doc_id: r.covered for r in decontaminate.overlaps(docs, bench).where("doc_id = 2").collect()}
    assert partly == {2: 6}


def test_items_that_share_an_id_or_have_none(spark):
    texts = [" ".join(f"{x}{k}" for k in range(12)) for x in "abc"]
    docs = spark.createDataFrame([*enumerate(texts), (3, "something else")], "doc_id long, text string")
    bench = spark.createDataFrame([(0, texts[0]), (0, texts[1]), (None, texts[2])], "item_id long, text string")
    for block in (8 << 20, 60):
        assert sorted((r.doc_id, r.item_id) for r in decontaminate.contaminated(docs, bench, block_bytes=block).collect()) == [(0, 0), (1, 0)]
        assert [r.doc_id for r in decontaminate.without_leaks(docs, bench, block_bytes=block).collect()] == [3]


def test_a_seed_that_all_share_makes_no_pairs(spark):
    phrase = "which of the following statements is the most accurate one"  # 6 seeds of 10 tokens
    items = [(k, phrase + "".join(f" i{k}x{n}" for n in range(20))) for k in range(30)]
    docs = [(k, f"{phrase} d{k}a d{k}b d{k}c") for k in range(300)]
    docs += [(300, items[7][1]), (301, items[9][1] + " " + phrase), (302, phrase + " " + " ".join(items[3][1].split()[12:]))]
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame([*items, (99, phrase)], "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(docs, bench).collect()}
    assert got == {(k, 99) for k in range(303)} | {(300, 7), (301, 9), (302, 3)}
    found, seeds = decontaminate._benchmark(bench, "item_id", "text", 5, False, shared_dir(spark))
    bits, sizes = decontaminate._filter(seeds, 1 << 20)
    runs = [(k, *decontaminate.passing_runs(r.text.encode(), bits, sizes)) for k, r in enumerate(docs.collect())]
    texts = spark.createDataFrame([(k, 0, seen.view(np.int64).tolist()) for k, _, _, seen in runs], "h1 long, h2 long, seeds array<long>")
    assert decontaminate._candidates(texts, seeds, found, 0.6).count() == 306  # the phrase alone would make 303 x 31
    assert decontaminate._candidates(texts, seeds, found, 0.0).count() == 303 * 31


def test_most_covered_bounds_the_tiles():
    rng = random.Random(5)
    for _ in range(300):
        item = [rng.randint(1, rng.choice([3, 9])) for _ in range(rng.randint(3, 25))]
        doc = [rng.randint(1, 9) for _ in range(rng.randint(0, 20))] + item[rng.randrange(len(item)) :]
        most = decontaminate.most_covered(np.array(item, np.uint64), np.array(doc, np.uint64), 3)
        assert sum(n for _, _, n in decontaminate.tile(item, doc, 3)) <= most <= len(item)
