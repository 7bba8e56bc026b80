import hashlib
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lumencube.llm import repetitions
from lumencube.llm.queries import op11_periodic_runs

DATA = "/root/testdata/sf0.01"
WORD = re.compile("[^\x20\x09-\x0d]+")


def plain_runs(x, least=24, times=3):
    """Every period, every maximal stretch of equal words that far apart; the smallest period of each interval."""
    found = {}
    for q in range(1, len(x) // times + 1):
        i = 0
        while i + q < len(x):
            if x[i] != x[i + q]:
                i += 1
                continue
            j = i
            while j + q < len(x) and x[j] == x[j + q]:
                j += 1
            if j + q - i >= max(least, times * q):
                found.setdefault((i, j + q), q)
            i = j
    return sorted((s, e - s, q) for (s, e), q in found.items())


def plain(doc, text):
    words = WORD.findall(text or "")
    h, n = zlib.crc32(str(doc).encode()) if doc is not None else 1, len(words)
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    number = {}
    runs = plain_runs([number.setdefault(w, len(number)) for w in words])
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    gone = {k for s, m, q in runs for k in range(s + q, s + m)}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    lines = "".join(f"{s},{m},{q}\n" for s, m, q in runs)
    return (doc, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None, sha(lines), sha(" ".join(w for k, w in enumerate(words) if k not in gone)))


@given(st.lists(st.integers(0, 2), max_size=70), st.integers(2, 9), st.integers(2, 4))
@settings(max_examples=400, deadline=None)
def test_runs_of_random_words(x, least, times):
    assert repetitions.find_runs(np.array(x, np.int64), least, times) == plain_runs(x, least, times)


@given(st.lists(st.tuples(st.lists(st.integers(0, 4), min_size=1, max_size=9), st.integers(1, 9)), max_size=8))
@settings(max_examples=300, deadline=None)
def test_runs_of_repeated_blocks(blocks):
    x = [w for block, n in blocks for w in block * n]
    assert repetitions.find_runs(np.array(x, np.int64)) == plain_runs(x)


@given(st.lists(st.integers(0, 1), min_size=1, max_size=40), st.integers(1, 40))
@settings(max_examples=200, deadline=None)
def test_z_function(x, until):
    until = min(until, len(x))
    want = [0] + [next((k for k in range(len(x) - i) if x[i + k] != x[k]), len(x) - i) for i in range(1, until)]
    assert repetitions.z_function(np.array(x), until).tolist() == want


def test_smallest_period_and_nested_runs():
    x = ([1] * 30 + [2]) * 4
    got = repetitions.find_runs(np.array(x))
    assert (0, 124, 31) in got and sum(q == 1 for _, _, q in got) == 4
    assert repetitions.find_runs(np.array([7] * 50)) == [(0, 50, 1)]
    with pytest.raises(ValueError):
        repetitions.find_runs(np.array([1]), times=1)


def test_long_texts_are_searched_in_near_linear_time():
    one = np.zeros(200_000, np.int64)
    assert repetitions.find_runs(one) == [(0, 200_000, 1)]
    fib = [0], [0, 1]
    while len(fib[1]) < 20_000:
        fib = fib[1], fib[1] + fib[0]
    assert len(repetitions.find_runs(np.array(fib[1]))) > 1000


def test_every_document_of_the_table(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect()
    got = op11_periodic_runs(spark, DATA)
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert sorted(map(tuple, got.collect())) == sorted(plain(r.doc_id, r.text) for r in docs)


def test_edge_cases(spark):
    ids = [k for k in range(200) if zlib.crc32(str(k).encode()) % 10 == 0][:6]
    other = next(k for k in range(200) if zlib.crc32(str(k).encode()) % 10)
    texts = [None, "", " \t\n\x0b\x0c\r", "one", "à b  c " * 40, "a b c d e f g h i j " * 9]
    rows = [*zip(ids, texts), (None, "x y " * 20), (other, "x y " * 20), (other, "x y " * 20), (other + 1000, None)]
    frame = spark.createDataFrame([(*r, "clash", 1, 2) for r in rows], "doc_id long, text string, runs string, n int, h int")
    got = repetitions.digest(repetitions.periodic_runs(repetitions.with_planted_runs(frame)))
    order = lambda r: (r[0] is None, r[0] or 0)
    assert sorted(map(tuple, got.collect()), key=order) == sorted((plain(*r) for r in rows), key=order)
    assert repetitions.periodic_runs(frame.limit(0)).count() == 0
