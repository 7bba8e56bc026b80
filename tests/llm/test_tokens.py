import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lumencube.llm import idstore, packing, tokens
from lumencube.llm.queries import op6_best_fit_packing, op7_token_id_files

DATA = "/root/testdata/sf0.01"
ODD = [None, "", " ", "a  b\n\n c", "it's  we'll\tI'D", "x" * 5000, "日本語 text é ü", "tail \r\n ", "½ 3²x <|endoftext|> y", "hello <|endoftext|> world", "<|endoftext|>", "a<|endoftext|><|endoftext|>b <|endoftext", "á́ \x0b \x1c z\x85", "naïve  Straße", "42" * 30 + "...!!"]


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(tokens.default_vocabulary())
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


def test_ids_are_the_librarys(spark, library, monkeypatch):
    texts = [r.text for r in spark.read.parquet(f"{DATA}/documents.parquet").limit(300).collect()] + ODD
    for piece, memo in ((tokens.PIECE, tokens.MEMO_WORDS), (64, 50)):
        monkeypatch.setattr(tokens, "PIECE", piece)
        monkeypatch.setattr(tokens, "MEMO_WORDS", memo)
        own = tokens.Encoder(tokens.default_vocabulary())
        for text in texts:
            assert own.ids(text).tolist() == library(text)
        assert [x.tolist() for x in own.batch(texts)] == [library(x) for x in texts]


def test_added_tokens_have_their_own_id():
    assert tokens.Encoder(tokens.default_vocabulary()).ids("hello <|endoftext|> world").tolist() == [31373, 220, 50256, 995]


def check_plan(histogram, limit):
    taken, ranks = {}, {}
    for length, lo, hi, first, offset in packing.plan(histogram, limit):
        ranks.setdefault(length, []).append((lo, hi))
        for k in range(hi - lo):
            taken.setdefault(first + k, []).append((offset, length))
    for length, n in histogram.items():
        spans = sorted(ranks[length])
        assert spans[0][0] == 0 and spans[-1][1] == n and all(a[1] == b[0] for a, b in zip(spans, spans[1:]))
    for parts in taken.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= limit
    return len(taken)


def plain_best_fit(histogram, limit):
    rooms = []
    for length in sorted(histogram, reverse=True):
        for _ in range(histogram[length]):
            fits = [r for r in rooms if r >= length]
            if fits:
                rooms.remove(min(fits))
                rooms.append(min(fits) - length)
            else:
                rooms.append(limit - length)
    return len(rooms)


def test_plan_is_best_fit_decreasing():
    rng = random.Random(5)
    for limit in (10, 50, 200):
        for _ in range(30):
            histogram = {rng.randint(1, limit): rng.randint(1, 25) for _ in range(rng.randint(1, 20))}
            assert check_plan(histogram, limit) == plain_best_fit(histogram, limit)
    assert packing.plan({}) == []


def check_packing(rows, texts, library):
    assert sorted((r.doc_id, r.piece) for r in rows) == sorted({(r.doc_id, r.piece) for r in rows})
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    assert set(by_doc) == set(texts)
    for doc, parts in by_doc.items():
        ids = np.array([*library(texts[doc]), 0], "<u4")
        at = 0
        for r in sorted(parts, key=lambda r: r.piece):
            assert r.start == at and r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            assert r.length == 2048 or r.piece == 0
            at += r.length
        assert at == len(ids) and len(parts) == -(-len(ids) // 2048)
    for parts in by_sequence.values():
        at = 0
        for r in sorted(parts, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 2048
    total = sum(r.length for r in rows)
    assert len(by_sequence) <= -(-total // 2048) * 1.01 + 1


def test_packing_of_documents(spark, library):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    check_packing(op6_best_fit_packing(spark, DATA).collect(), texts, library)


def test_packing_edge_cases(spark, library):
    texts = dict(enumerate([*ODD, "w " * 2047, "w " * 2048, "w " * 9000]))
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").withColumn("rank", F.lit("x")).withColumn("length", F.lit(None))
    placed = packing.pack(docs)
    check_packing(placed.collect(), texts, library)
    whole = {r.sequence_id: r.ids for r in packing.sequences(docs, placed).collect()}
    for r in placed.collect():
        part = np.array(whole[r.sequence_id][r.offset : r.offset + r.length], "<u4")
        assert zlib.crc32(part.tobytes()) == r.ids_crc32
    assert packing.pack(docs.limit(0)).count() == 0
    twice = packing.pack(docs.unionByName(docs).withColumn("doc_id", F.lit(None).cast("long"))).collect()
    assert len(twice) == 2 * placed.count() and all(r.doc_id is None for r in twice)


@pytest.mark.parametrize("plane", ["bit", "byte"])
def test_chunks_round_trip(plane):
    rng = np.random.default_rng(1)
    for ids in (np.zeros(0, np.uint32), np.zeros(9, np.uint32), rng.integers(0, 50257, 65536).astype(np.uint32), np.array([2**32 - 1, 0, 5], np.uint32)):
        data, sizes = idstore.pack_chunk(ids, plane)
        assert (idstore.unpack_chunk(data, sizes, len(ids), plane) == ids).all()


def check_files(rows, texts, library):
    at = 0
    for r, (doc, text) in zip(sorted(rows, key=lambda r: r.doc_id), sorted(texts.items()), strict=True):
        ids = np.array([*library(text), 2], "<u4")
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (doc, at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)


def test_files_of_documents(spark, library):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    check_files(op7_token_id_files(spark, DATA).collect(), texts, library)


def test_places_without_a_scheme_are_the_default_stores(spark, tmp_path):
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    before = conf.get("fs.defaultFS")
    try:
        conf.set("fs.defaultFS", "hdfs://names:8020")
        assert idstore.qualified(spark, "/a/b") == "hdfs://names:8020/a/b"
    finally:
        conf.set("fs.defaultFS", before)
    assert idstore.qualified(spark, str(tmp_path)) == f"file://{tmp_path}"
    assert idstore.qualified(spark, f"file://{tmp_path}/x") == f"file://{tmp_path}/x"


def test_files_edge_cases(spark, library, tmp_path):
    texts = dict(enumerate(ODD * 3))
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").withColumn("shard", F.lit("x"))
    idstore.write_ids(docs, str(tmp_path / "a"), block=16)
    got = idstore.read_ids(spark, str(tmp_path / "a"))
    got = got.select("doc_id", "start", (F.length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))
    check_files(got.collect(), texts, library)
    name = idstore.read_manifest(spark, str(tmp_path / "a")).first().name
    reader = idstore.ShardReader(idstore.qualified(spark, str(tmp_path / "a")), name)
    everything = np.concatenate([ids for _, _, ids in reader.documents()])
    assert (reader.span(5, 41) == everything[5:41]).all()
    idstore.write_ids(docs.limit(0), str(tmp_path / "b"))
    assert idstore.read_ids(spark, str(tmp_path / "b")).count() == 0
    many = spark.range(20_000).select(F.lit(None).cast("long").alias("doc_id"), F.lit("same words").alias("text"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    idstore.write_ids(many.unionByName(docs.select("doc_id", "text")), str(tmp_path / "d"))
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert idstore.read_manifest(spark, str(tmp_path / "d")).where("n_docs > 3000").count() > 2
    rows = idstore.read_ids(spark, str(tmp_path / "d")).orderBy("start").collect()
    assert len(rows) == 20_000 + docs.count() and [r.doc_id for r in rows[19_999:20_001]] == [None, 0]
    same = docs.withColumn("doc_id", F.when(F.col("doc_id") > 3, 4))
    idstore.write_ids(same, str(tmp_path / "c"))
    assert idstore.read_ids(spark, str(tmp_path / "c")).groupBy("doc_id").count().count() == 2
