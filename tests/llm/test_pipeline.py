import zlib

import numpy as np
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from lumencube.llm import decontaminate, langid, linededup, tokens

from .test_decontaminate import plain_tile, plain_tokens
from .test_linededup import plain as plain_lines
from .test_simhash import plain_fingerprint, plain_groups
from .test_tokens import check_packing

DATA = "/root/testdata/sf0.01"


def stages(spark, docs, sf_dir=DATA):
    out, columns = [], docs.columns
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < 4:
            assert docs.columns == columns
            docs = spark.createDataFrame(docs.collect(), docs.schema)
        out.append(docs.collect())
    return out


def test_stages_match_brute_force(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    one, two, three, four, five = stages(spark, docs)
    texts = {r.doc_id: r.text for r in docs.collect()}
    model = langid.learn(docs.where(~langid.held_out()))
    rejected = model.decide(list(texts.values()))["rejected"]
    assert {r.doc_id for r in one} == {d for d, x in zip(texts, rejected) if not x}
    want = {d: t for d, t, _, _ in plain_lines([(r.doc_id, r.text) for r in one])}
    assert {r.doc_id: r.text for r in two} == want and all(r.n_chars == len(r.text) for r in two)
    groups = plain_groups({d: plain_fingerprint(t) for d, t in want.items()})
    assert {r.doc_id for r in three} == set(groups.values()) < set(want)
    items = [plain_tokens(r.text) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    leaks = set()
    for r in three:
        words = plain_tokens(r.text)
        seeds = {tuple(words[k : k + 5]) for k in range(len(words) - 4)}
        for item in items:
            if seeds & {tuple(item[k : k + 5]) for k in range(len(item) - 4)}:
                inside = set(item)
                near = [w if w in inside else k for k, w in enumerate(words)]
                runs = [w for k, w in enumerate(near) if isinstance(w, str) or (k and isinstance(near[k - 1], str))]
                if sum(plain_tile(item, runs, 5)) / len(item) >= 0.6:
                    leaks.add(r.doc_id)
    assert leaks and {r.doc_id for r in four} == {r.doc_id for r in three} - leaks
    t = Tokenizer.from_file(tokens.default_vocabulary())
    check_packing(five, {r.doc_id: r.text for r in four}, lambda x: t.encode(x or "", add_special_tokens=False).ids)
    total = sum(zlib.crc32(np.array([r.doc_id, r.piece, r.length, r.ids_crc32], "<u4").tobytes()) for r in five)
    rerun = corpus_pipeline.run(spark, DATA).collect()
    assert total == sum(zlib.crc32(np.array([r.doc_id, r.piece, r.length, r.ids_crc32], "<u4").tobytes()) for r in rerun)


def test_nulls_repeats_and_empty_tables(spark):
    line = "the cat sat on the mat and the dog ran away over the hill"
    rows = [(1, None, "en", "a", 0), (2, "", None, None, None), (3, f"{line} one", "en", "a", 5), (3, f"{line} one", "en", "a", 5), (None, f"{line} two", "en", None, 5), (5, f"{line} three", None, "b", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for name in ("rejected", "score", "component_id", "fp", "gone", "n_lines", "batch", "doc", "item_id", "rank", "length", "ids"):
        docs = docs.withColumn(name, F.lit("clash"))
    one, _, three, _, five = stages(spark, docs)
    assert len(one) == 4 and sorted(str(r.doc_id) for r in three) == ["3", "5", "None"]
    assert len(five) == 3
    assert [len(x) for x in stages(spark, docs.limit(0))] == [0] * 5


def test_leaks_are_filtered_row_by_row(spark):
    docs = spark.createDataFrame([(1, None, "x"), (2, "clean text", None), (3, "a b c d e f", "y")], "doc_id long, text string, item_id string")
    bench = spark.createDataFrame([(9, "A, b c d e f!"), (8, "none of this one here")], "item_id long, text string")
    for block in (8 << 20, 5):
        got = decontaminate.without_leaks(docs, bench, block_bytes=block).select("doc_id", F.col("item_id")).collect()
        assert sorted(map(tuple, got)) == [(1, "x"), (2, None)]


def test_near_dedup_keeps_one_row_of_each_group(spark):
    near = [f"{' '.join(f'w{k % 13} x{k}' for k in range(60))} {end}" for end in ("one", "two")]
    other = " ".join(f"y{k} z{k}" for k in range(50))
    rows = [(4, near[0], "a"), (4, near[1], "b"), (7, near[0], "c"), (5, other, "d"), (5, near[0], "e"), (9, other, "f"), (9, other, "f"), (8, None, "g"), (8, "", "h"), (8, "", "h")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("print", F.lit("x")).withColumn("n", F.lit(0))
    got = corpus_pipeline.near_dedup(spark, docs, DATA)
    assert got.columns == docs.columns
    kept = sorted((r.doc_id, r.text) for r in got.collect() if r.doc_id != 8)
    assert [d for d, _ in kept] == [4, 5] and kept[0][1] in near and kept[1][1] == other
    assert sum(r.doc_id == 8 for r in got.collect()) == 1


#: Names that the stages use themselves, or that need quoting.
NAMES = ["n_lines", "n_dropped", "__kept", "__doc", "__gone", "__n", "__h1", "__h2", "__id", "__print", "a.b", "a`b", "TEXT", "column_0", "h1", "doc", "print", "score", "lang_pred", "sp ace"]


def test_every_extra_column_keeps_its_values(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").where("doc_id < 60")
    held = docs.select(*docs.columns, *[(F.col("doc_id") * 100 + k).alias(f"c{k}") for k in range(len(NAMES) - 1)], F.concat(F.lit("x"), "doc_id").alias("last")).toDF(*docs.columns, *NAMES)
    columns = held.columns
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES[:4]):
        made = stage(spark, held, DATA)
        assert made.columns == columns, name
        rows = made.collect()
        assert rows, name
        for r in rows:
            assert list(r)[5:] == [r[0] * 100 + k for k in range(len(NAMES) - 1)] + [f"x{r[0]}"], name
        held = spark.createDataFrame([tuple(r) for r in rows], made.schema)
    assert corpus_pipeline.best_fit_packing(spark, held, DATA).count() >= len(rows)


def test_line_dedup_and_leaks_alone_keep_extra_columns(spark):
    line = "a line of forty characters or a few more than that"
    docs = spark.createDataFrame([(k, f"{line}\nown {k}", *[k * 10 + i for i in range(4)]) for k in range(6)], "id long, body string, a long, b long, c long, d long").toDF("h1", "a.b", "__doc", "__h1", "batch", "n_lines")
    got = linededup.dedup_lines(docs, "h1", "a.b")
    assert got.columns == ["h1", "a.b", "__doc", "__h1", "batch", "n_lines", "n_dropped"]
    assert sorted(tuple(r) for r in got.collect()) == [(k, f"own {k}" if k < 5 else f"{line}\nown 5", k * 10, k * 10 + 1, k * 10 + 2, 2, int(k < 5)) for k in range(6)]
    bench = spark.createDataFrame([(1, "a line of forty characters or a few more")], "item_id long, text string")
    assert decontaminate.without_leaks(docs, bench, text_col="a.b").columns == docs.columns
