import math
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from lumencube.llm import langid
from lumencube.llm.queries import op1_language_id

DATA = "/root/testdata/sf0.01"


def plain_kneser_ney(texts, order):
    """p(c | history) by the definition, with dictionaries."""
    counts = [Counter() for _ in range(order + 1)]
    for t in texts:
        codes = [32] * (order - 1) + langid.normalized(t).tolist()
        for i in range(order - 1, len(codes)):
            counts[order][tuple(codes[i - order + 1 : i + 1])] += 1
    for n in range(order - 1, 0, -1):
        for gram in counts[n + 1]:
            counts[n][gram[1:]] += 1
    follow = [defaultdict(dict) for _ in range(order + 1)]
    for n in range(1, order + 1):
        for gram, c in counts[n].items():
            follow[n][gram[:-1]][gram[-1]] = c
    vocabulary = len(counts[1]) + 1

    def discount(n):
        one, two = (sum(c == k for c in counts[n].values()) for k in (1, 2))
        return min(max(one / (one + 2 * two) if one else 0.5, 0.1), 0.95)

    d = [discount(n) if n else 0 for n in range(order + 1)]

    def p(gram):
        n = len(gram)
        if not n:
            return 1 / vocabulary
        after = follow[n].get(gram[:-1])
        if not after:
            return p(gram[1:])
        total = sum(after.values())
        return max(after.get(gram[-1], 0) - d[n], 0) / total + d[n] * len(after) / total * p(gram[1:])

    return p


def test_probabilities_are_kneser_ney():
    texts = {"a": ["the theme of the thin man", "then he ran"], "b": ["der Mann und die Frau", "das Ende", "tür zu"]}
    model = langid.train([(k, v, v) for k, v in texts.items()], 3, 0.01, 4.0)
    probe = ["them und zür", "xyz the q", "Frau"]
    codes, real = langid._runs([langid.normalized(t) for t in probe], 3)
    got = model.log_probabilities(codes, real)
    for k, lang in enumerate(model.languages):
        p = plain_kneser_ney(texts[lang], 3)
        want = [math.log(p(tuple(codes[i - 2 : i + 1].tolist()))) for i in np.flatnonzero(real)]
        assert np.allclose(got[:, k], want, atol=1e-4)


def test_held_out_accuracy_and_no_clean_text_rejected(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    got = op1_language_id(spark, DATA).join(docs, "doc_id").collect()
    assert len(got) == docs.count()
    held = [r for r in got if r.held_out]
    assert len(held) > 100 and sum(r.lang == r.lang_pred for r in held) / len(held) > 0.99
    assert all(0 <= r.score <= 1 for r in got)
    assert sum(r.rejected for r in got) <= 1


def test_other_scripts_and_noise_are_rejected(spark):
    model = langid.learn(spark.read.parquet(f"{DATA}/documents.parquet"))
    odd = ["Привет мир как дела сегодня у вас дома " * 5, "こんにちは世界の人々" * 5, "qzxj vkqw xqzj wvkq jxqz kvwq " * 20]
    assert model.decide(odd)["rejected"].all()
    mixed = "the of and that was with this " * 8 + "der die das und ist von nicht " * 8
    assert not model.decide([mixed])["rejected"][0]


def test_long_texts_are_scored_whole(spark, monkeypatch):
    model = langid.learn(spark.read.parquet(f"{DATA}/documents.parquet"))
    text = spark.read.parquet(f"{DATA}/documents.parquet").orderBy(F.desc("n_chars")).first().text
    whole = model.score([text])
    monkeypatch.setattr(langid, "PIECE", 997)
    pieces = model.score([text])
    assert abs(whole[0][0] - pieces[0][0]) < 60 and np.allclose(whole[1], pieces[1], rtol=0.02)


def test_edge_cases(spark):
    rows = [(1, None, "en"), (2, "", "en"), (3, "12 !?", "de"), (4, "the cat", None), (None, "le chat", "fr"), (6, "the dog and the cat", "en"), (6, "the dog and the cat", "en"), (7, "der hund und die katze", "de")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("score", F.lit("x")).withColumn("place", F.lit(1))
    model = langid.learn(docs)
    assert model.languages == ["de", "en", "fr"]
    got = {r.doc_id: (r.lang_pred, r.score, r.rejected) for r in langid.predict(docs, model).collect()}
    assert langid.predict(docs, model).count() == len(rows)
    assert got[1] == got[2] == got[3] == ("und", 0.0, True)
    assert got[4][0] == "en" and got[6][0] == "en" and got[7][0] == "de"
    assert langid.predict(docs.limit(0), model).count() == 0
    for m in (model, None):
        kept = langid.without_rejected(docs.withColumn("rejected", F.lit(1)), m)
        assert kept.columns[-1] == "rejected" and sorted(str(r.doc_id) for r in kept.collect()) == ["4", "6", "6", "7", "None"]
    assert langid.learn(docs.where("lang is null")) is None
    assert {r.lang_pred for r in langid.predict(docs, None).collect()} == {"und"}


def test_sample_is_bounded(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    got = langid.sample(docs, "doc_id", "text", "lang", 50_000, 120_000).groupBy("lang").agg(F.sum(F.char_length("text")).alias("n"), F.max(F.char_length("text")).alias("last")).collect()
    assert len(got) == 4 and all(0 < r.n <= 30_000 + r.last for r in got)


@pytest.mark.parametrize("text,want", [("ABC, d'É!", "abc d é "), ("", ""), ("áb", None)])
def test_normalized(text, want):
    codes = langid.normalized(text)
    assert want is None or "".join(map(chr, codes)) == want


def test_predictions_match_brute_force(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    rows = langid.sample(docs.where(~langid.held_out()), "doc_id", "text", "lang", 12_000, 48_000).collect()
    by = {}
    for lang, text, place in sorted((r.lang, r.text, r.place) for r in rows):
        by.setdefault(lang, []).append((text, place % 4 == 0))
    model = langid.learn(docs.where(~langid.held_out()), train_chars=12_000, total_chars=48_000)
    assert model.languages == sorted(by)
    plain = {lang: plain_kneser_ney([t for t, c in x if not c], 4) for lang, x in by.items()}
    some = docs.where("n_chars < 400").orderBy("doc_id").limit(25)
    for r in langid.predict(some, model, keep=["doc_id", "text"]).collect():
        codes = [32] * 3 + langid.normalized(r.text).tolist()
        want = {lang: -sum(math.log(p(tuple(codes[i - 3 : i + 1]))) for i in range(3, len(codes))) / (len(codes) - 3) for lang, p in plain.items()}
        assert r.lang_pred == min(want, key=want.get) and r.cross_entropy == pytest.approx(want[r.lang_pred], abs=1e-4)


def test_limits_are_calibrated(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    model = langid.learn(docs.where(~langid.held_out()))
    assert set(model.report) == set(model.languages) and len(set(model.limit.tolist())) > 2
    for n_clean, rejected, n_noise, accepted in model.report.values():
        assert n_clean >= 5 and n_noise >= 20 and rejected <= 0.05 and accepted <= 0.1
    strict = langid.learn(docs.where(~langid.held_out()), accept_rate=0.5)
    assert (strict.limit > model.limit).all()
    texts = [r.text for r in docs.where(langid.held_out()).collect()]
    noise = langid._noise(texts)
    assert model.decide(noise)["rejected"].mean() > 0.95 and model.decide(texts)["rejected"].mean() < 0.01
