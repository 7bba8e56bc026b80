import hashlib
import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lumencube.llm import fingerprints
from lumencube.llm.queries import op12_quartile_digests

DATA = "/root/testdata/sf0.01"
WORD = 0xFFFFFFFF


def plain_print(raw):
    counts = [0] * 256
    for at in range(len(raw)):
        for k, (i, j) in enumerate(((1, 2), (1, 3), (2, 3))):
            if at + j < len(raw):
                h = (raw[at] * 0x9E3779B1 & WORD) ^ (raw[at + i] * 0x85EBCA77 & WORD) ^ (raw[at + j] * 0xC2B2AE3D & WORD)
                counts[((h ^ h >> 15) * (0x2C1B3C6D + 2 * k) & WORD) >> 24] += 1
    low, mid, high = (sorted(counts)[k] for k in (63, 127, 191))
    code = [(c > low) + (c > mid) + (c > high) for c in counts]
    body = [sum(code[k + n] << 2 * n for n in range(4)) for k in range(0, 256, 4)]
    return bytes([min(255, int(math.log2(1 + len(raw)) * 8)), 16 * (15 * low // high) + 15 * mid // high if high else 0, *body]).hex()


def plain_likeness(a, b):
    a, b = bytes.fromhex(a), bytes.fromhex(b)
    off = min(abs(a[0] - b[0]), 24) + min(abs((a[1] >> 4) - (b[1] >> 4)), 8) + min(abs((a[1] & 15) - (b[1] & 15)), 8)
    for x, y in zip(a[2:], b[2:], strict=True):
        off += sum((0, 1, 2, 4)[abs((x >> s & 3) - (y >> s & 3))] for s in (0, 2, 4, 6))
    return 1 - off / (4 * 256 + 24 + 16)


def plain(rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    texts = [t or "" for _, t in rows]
    prints, out = [plain_print(t.encode()) for t in texts], []
    for k, (doc, _) in enumerate(rows):
        text, after = texts[k], (k + 1) % len(rows)
        n = len(text) // 4
        edited = text[: len(text) - n] + texts[after][:n]
        own, other = prints[k], plain_print(edited.encode())
        out.append((doc, len(text), hashlib.sha256(edited.encode()).hexdigest(), own, other, plain_likeness(own, other), plain_likeness(own, prints[after])))
    return out


COLUMNS = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]


@given(st.binary(max_size=300))
@settings(max_examples=150, deadline=None)
def test_fingerprint_of_any_bytes(raw):
    got = fingerprints.fingerprint(raw)
    assert got == plain_print(raw) and len(got) == 2 * fingerprints.SIZE


@given(st.binary(max_size=200), st.binary(max_size=200))
@settings(max_examples=100, deadline=None)
def test_likeness_is_bounded_and_symmetric(a, b):
    a, b = fingerprints.fingerprint(a), fingerprints.fingerprint(b)
    [there], [back], [same] = (fingerprints.likenesses([x], [y]) for x, y in ((a, b), (b, a), (a, a)))
    assert 0 <= there == back <= 1 and same == 1 and there == plain_likeness(a, b)
    assert fingerprints.likenesses([], []).tolist() == []


def test_the_farthest_digests_have_likeness_0():
    far = bytes([0, 0, *[0] * 64]).hex(), bytes([255, 255, *[255] * 64]).hex()
    assert fingerprints.likenesses([far[0]], [far[1]]).tolist() == [0]


def test_chunks_do_not_show(monkeypatch):
    raw = np.random.default_rng(1).integers(0, 256, 1000, np.uint8).tobytes()
    want = fingerprints.counters(raw).tolist()
    for chunk in (1, 2, 3, 7, 999, 1000):
        monkeypatch.setattr(fingerprints, "CHUNK", chunk)
        assert fingerprints.counters(raw).tolist() == want


def test_every_document_of_the_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect()]
    got = op12_quartile_digests(spark, DATA)
    assert sorted(got.columns) == sorted(COLUMNS)
    got = sorted(map(tuple, got.select(*COLUMNS).collect()))
    want = sorted(plain(rows))
    assert [r[:5] for r in got] == [r[:5] for r in want]
    assert np.allclose([r[5:] for r in got], [r[5:] for r in want], rtol=0, atol=1e-12)
    # an edited text is nearer than the next document, for nearly all that are long enough to have counts
    far = [(r[5], r[6]) for r in got if r[1] >= 200]
    assert np.mean([a > b for a, b in far]) > 0.98


@pytest.mark.parametrize("parts", [1, 3, 9])
def test_edge_cases(spark, parts):
    rows = [(7, "àé€𝄞" * 5), (3, None), (None, "no id here, but a text"), (9, ""), (1, "x" * 1000), (2, "ab"), (2_000_000_000_000, "the last document's text")]
    frame = spark.createDataFrame([(*r, "clash", 1) for r in rows], "doc_id long, text string, fingerprint string, place int").repartition(parts)
    got = fingerprints.compared(fingerprints.edited_by_next(frame)).select(*COLUMNS).collect()
    order = lambda r: (r[0] is not None, r[0] or 0)
    for a, b in zip(sorted(map(tuple, got), key=order), plain(rows), strict=True):
        assert a[:5] == b[:5] and np.allclose(a[5:], b[5:])
    assert fingerprints.edited_by_next(frame.limit(0)).count() == 0
    alone = fingerprints.compared(fingerprints.edited_by_next(frame.where("doc_id = 1"))).select(*COLUMNS).collect()
    assert tuple(alone[0]) == plain([rows[4]])[0]


def test_repeated_rows_and_ids(spark):
    rows = [(5, "one text of five, which is repeated")] * 40 + [(5, "another text of five"), (6, "six")]
    got = fingerprints.edited_by_next(spark.createDataFrame(rows, "doc_id long, text string").repartition(5))
    assert got.count() == 42
    prints = {(r.doc_id, r.fingerprint) for r in got.collect()}
    assert prints == {(d, plain_print(t.encode())) for d, t in rows}
    # 39 of the equal rows are followed by an equal row, one by another row
    assert got.where("doc_id = 5 and fingerprint = next_fingerprint").count() == 39


def test_likeness_of_null_and_fingerprints_alone(spark):
    frame = spark.createDataFrame([(1, "some text here"), (None, None)], "doc_id long, text string")
    got = fingerprints.fingerprints(frame)
    assert {tuple(r) for r in got.collect()} == {(1, plain_print(b"some text here")), (None, plain_print(b""))}
    near = got.select(fingerprints.likeness("fingerprint", "fingerprint"), fingerprints.likeness("fingerprint", F.lit(None).cast("string"))).collect()
    assert [tuple(r) for r in near] == [(1.0, None)] * 2
