"""Language ID by interpolated Kneser-Ney character models in sorted hash arrays.

Training: for each language a bounded sample of labelled texts (``train_chars`` code points, drawn by
hash, whole texts) is counted on the driver and the tables of all languages are merged,
so the model's size is bounded by ``total_chars``, whatever the corpus. For each
order the union of the languages' n-grams is one sorted array of 64-bit hashes, beside it a matrix of
log probabilities (languages as columns); n-grams that are in no language's table fall to the next
order through the sorted array of histories and their back-off weights.

Prediction: the language of the lowest cross-entropy per character. Rejection: a text's
cross-entropy, taken block by block in the language that fits each best (a text may mix learned
languages), is compared with what calibration texts of that language (sample texts that were not
counted) have, with the spread that its length allows. The limit comes from both sides: blocks of the
calibration texts with their letters shuffled are what should go, and the limit is where ``accept_rate``
of them would pass, unless more than ``reject_rate`` of the calibration texts would go there; then it is
where those stay. Longer noise lies further off. ``Model.report`` has both rates as measured on calibration texts that set no limit.
"""

from __future__ import annotations

import random
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import mapped, shared_dir, slices, text_bytes, written

SPACE = 32
PIECE = 1 << 19
BLOCK = 64
#: Rows of (language, two numbers) up to which the table of languages is broadcast.
BROADCAST_ROWS = 10_000
# Odd multipliers, one for each place of an n-gram.
PLACES = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB], np.uint64)

#: Set on the code point of a mark, which alone doesn't make a word.
MARK = np.uint32(1 << 24)


@cache
def _folding() -> np.ndarray:
    """For each code point its lower-case letter, or the mark, or a space; made once for each worker."""
    table = np.full(0x110000, SPACE, np.uint32)
    for x in range(0x110000):
        c = chr(x)
        if c.isalpha():
            low = c.lower()
            table[x] = ord(low) if len(low) == 1 else x
        elif unicodedata.category(c)[0] == "M":
            table[x] = x | MARK
    return table


def normalized(text: str) -> np.ndarray:
    """Lower-case letters and marks as code points, everything between them one space."""
    codes = _folding()[np.frombuffer(text.encode("utf-32-le"), np.uint32)]
    keep = codes != SPACE
    keep[1:] |= codes[:-1] != SPACE
    return codes[keep]


def _hashes(codes: np.ndarray, order: int) -> list[np.ndarray]:
    """For each n from 1 to ``order`` the hash of the n characters that end at each place (wrapping at the start)."""
    out, c = [], codes.astype(np.uint64) + np.uint64(1)
    total = np.zeros(len(c), np.uint64)
    for n in range(order):
        total = total + np.roll(c, n) * PLACES[n]
        out.append(total)
    return out


def _runs(parts: list[np.ndarray], order: int) -> tuple[np.ndarray, np.ndarray]:
    """All texts in one array, each after ``order - 1`` spaces; and which places are of texts."""
    pad = np.full(order - 1, SPACE, np.uint32)
    codes = np.concatenate([x for p in parts for x in (pad, p)])
    real = np.ones(len(codes), bool)
    at = 0
    for p in parts:
        real[at : at + order - 1] = False
        at += order - 1 + len(p)
    return codes, real


@dataclass
class Counts:
    """One language's tables, one entry for each order from 1: hashes, log probabilities; histories, log back-off weights."""

    grams: list[np.ndarray]
    logp: list[np.ndarray]
    histories: list[np.ndarray]
    weights: list[np.ndarray]
    floor: float


def fit(texts: list[str], order: int) -> Counts:
    """Interpolated Kneser-Ney over the texts: the highest order counts occurrences, lower ones distinct left neighbours."""
    codes, real = _runs([p for t in texts if len(p := normalized(t))] or [np.array([SPACE], np.uint32)], order)
    hashes = _hashes(codes, order)
    where = np.flatnonzero(real)
    # distinct n-grams of each order: first places, for the lower orders' keys
    first = where[np.unique(hashes[-1][where], return_index=True)[1]]
    count = np.unique(hashes[-1][where], return_counts=True)[1].astype(np.float64)
    tables: list = [None] * order
    tables[-1] = (first, count)
    for n in range(order - 1, 0, -1):
        above = tables[n][0]  # one place for each distinct (n+1)-gram: each is one left neighbour of its n-gram
        _, at, c = np.unique(hashes[n - 1][above], return_index=True, return_counts=True)
        tables[n - 1] = (above[at], c.astype(np.float64))
    grams, logp, histories, weights = [], [], [], []
    vocabulary = len(tables[0][0]) + 1
    lower_p = None
    previous = np.empty(0, np.uint64)
    for n in range(1, order + 1):
        at, c = tables[n - 1]
        key = hashes[n - 1][at]
        once, twice = (c == 1).sum(), (c == 2).sum()
        discount = once / (once + 2 * twice) if once else 0.5
        discount = min(max(discount, 0.1), 0.95)
        if n == 1:
            history = np.zeros(len(at), np.uint64)
        else:
            history = hashes[n - 2][at - 1]
        kinds, back = np.unique(history, return_inverse=True)
        total = np.bincount(back, weights=c)
        distinct = np.bincount(back)
        weight = discount * distinct / total
        if n == 1:
            lower = np.full(len(at), 1.0 / vocabulary)
        else:
            lower = lower_p[np.searchsorted(previous, hashes[n - 2][at])]
        p = (c - discount) / total[back] + weight[back] * lower
        rank = np.argsort(key)
        grams.append(key[rank])
        logp.append(np.log(p[rank]))
        histories.append(kinds)
        weights.append(np.log(weight))
        previous, lower_p = key[rank], p[rank]
    return Counts(grams, logp, histories, weights, -float(np.log(vocabulary)))


@dataclass
class Model:
    """All languages' tables over the union of their n-grams, and the calibration."""

    languages: list[str]
    order: int
    grams: list[np.ndarray]
    logp: list[np.ndarray]
    histories: list[np.ndarray]
    weights: list[np.ndarray]
    floor: np.ndarray
    mean: np.ndarray = None
    between: np.ndarray = None
    within: np.ndarray = None
    limit: np.ndarray = None
    sharpness: float = 1.0
    #: of each language: clean texts, share of them rejected, noise texts, share of them accepted
    report: dict[str, tuple[int, float, int, float]] = None

    def log_probabilities(self, codes: np.ndarray, real: np.ndarray) -> np.ndarray:
        """For each real place the log probability of its character in each language."""
        hashes = _hashes(codes, self.order)
        where = np.flatnonzero(real)
        out = np.zeros((len(where), len(self.languages)), np.float32)
        todo = np.arange(len(where))
        for n in range(self.order, 0, -1):
            key = hashes[n - 1][where[todo]]
            at = np.searchsorted(self.grams[n - 1], key)
            at[at == len(self.grams[n - 1])] = 0
            hit = self.grams[n - 1][at] == key
            out[todo[hit]] += self.logp[n - 1][at[hit]]
            todo = todo[~hit]
            if not len(todo):
                return out
            if n > 1:
                history = hashes[n - 2][where[todo] - 1]
                table = self.histories[n - 1]
                at = np.searchsorted(table, history)
                at[at == len(table)] = 0
                known = table[at] == history
                out[todo[known]] += self.weights[n - 1][at[known]]
            else:
                out[todo] += self.weights[0][0] + self.floor
        return out

    def score(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of whole texts: characters; by language, sums of log probabilities and of their squares; and the sum
        over blocks of ``BLOCK`` characters of the best language's log probability there."""
        n = len(texts)
        chars, total, square = np.zeros(n, np.int64), np.zeros((n, len(self.languages))), np.zeros((n, len(self.languages)))
        piecewise = np.zeros(n)
        held, size = [], 0

        def flush() -> None:
            nonlocal held, size
            if held:
                codes, real = _runs([x for _, x in held], self.order)
                logp = self.log_probabilities(codes, real)
                starts = np.cumsum([0] + [len(x) for _, x in held])[:-1]
                whose = np.array([k for k, _ in held])
                np.add.at(total, whose, np.add.reduceat(logp, starts, axis=0, dtype=np.float64))
                np.add.at(square, whose, np.add.reduceat(logp * logp, starts, axis=0, dtype=np.float64))
                np.add.at(chars, whose, [len(x) for _, x in held])
                blocks = [np.arange(s, s + len(x), BLOCK) for s, (_, x) in zip(starts, held, strict=True)]
                best = np.add.reduceat(logp, np.concatenate(blocks), axis=0, dtype=np.float64).max(axis=1)
                np.add.at(piecewise, np.repeat(whose, [len(b) for b in blocks]), best)
            held, size = [], 0

        for k, text in enumerate(texts):
            for at in range(0, len(text or ""), PIECE):
                part = normalized(text[at : at + PIECE])
                if len(part) and ((part != SPACE) & (part < MARK)).any():
                    held.append((k, part))
                    size += len(part)
                    if size > PIECE:
                        flush()
        flush()
        return chars, total, square, piecewise

    def decide(self, texts: list[str | None]) -> dict[str, np.ndarray]:
        chars, total, _, piecewise = self.score(texts)
        n = np.maximum(chars, 1)
        entropy = -total / n[:, None]
        best = entropy.argmin(axis=1)
        one = np.arange(len(texts))
        z = (-piecewise / n - self.mean[best]) / np.sqrt(self.between[best] + self.within[best] / n)
        odds = (entropy[one, best][:, None] - entropy) * np.sqrt(n)[:, None] * self.sharpness
        p = 1 / np.exp(np.clip(odds, -700, 0)).sum(axis=1)
        return {"best": best, "entropy": entropy[one, best], "score": np.where(chars > 0, p, 0.0), "rejected": (chars == 0) | (z > self.limit[best]), "empty": chars == 0}


def _merged(languages: list[str], parts: list[Counts], order: int) -> Model:
    floor = np.array([p.floor for p in parts], np.float32)
    grams, logp, histories, weights = [], [], [], []
    for n in range(1, order + 1):
        hist = np.unique(np.concatenate([p.histories[n - 1] for p in parts]))
        weight = np.zeros((len(hist), len(parts)), np.float32)
        for k, p in enumerate(parts):
            weight[np.searchsorted(hist, p.histories[n - 1]), k] = p.weights[n - 1]
        histories.append(hist)
        weights.append(weight)
        union = np.unique(np.concatenate([p.grams[n - 1] for p in parts]))
        table = np.full((len(union), len(parts)), np.nan, np.float32)
        for k, p in enumerate(parts):
            table[np.searchsorted(union, p.grams[n - 1]), k] = p.logp[n - 1]
        grams.append(union)
        logp.append(table)
    return Model(languages, order, grams, logp, histories, weights, floor)


def _filled(model: Model, parts: list[Counts], suffixes: list[dict]) -> None:
    """Where a language lacks an n-gram of the union, its back-off value."""
    for n in range(1, model.order + 1):
        table = model.logp[n - 1]
        if n == 1:
            gap = np.isnan(table)
            table[gap] = np.broadcast_to(model.weights[0][0] + model.floor, table.shape)[gap]
            continue
        history, suffix = suffixes[n - 1]
        at = np.searchsorted(model.histories[n - 1], history)
        back = model.weights[n - 1][at]
        low = model.logp[n - 2][np.searchsorted(model.grams[n - 2], suffix)]
        gap = np.isnan(table)
        table[gap] = (back + low)[gap]


def train(samples: list[tuple[str, list[str], list[str]]], order: int, reject_rate: float, accept_rate: float) -> Model:
    """A model from (language, texts to count, texts to calibrate with), which are bounded."""
    samples = sorted(samples)
    parts, keys = [], [{} for _ in range(order)]
    for _, texts, _ in samples:
        parts.append(fit(texts, order))
        codes, real = _runs([p for t in texts if len(p := normalized(t))] or [np.array([SPACE], np.uint32)], order)
        hashes, where = _hashes(codes, order), np.flatnonzero(real)
        for n in range(2, order + 1):
            gram, at = np.unique(hashes[n - 1][where], return_index=True)
            at = where[at]
            keys[n - 1].setdefault("gram", []).append(gram)
            keys[n - 1].setdefault("history", []).append(hashes[n - 2][at - 1])
            keys[n - 1].setdefault("suffix", []).append(hashes[n - 2][at])
    model = _merged([x for x, _, _ in samples], parts, order)
    suffixes = [None]
    for n in range(2, order + 1):
        gram, at = np.unique(np.concatenate(keys[n - 1]["gram"]), return_index=True)
        assert (gram == model.grams[n - 1]).all()
        suffixes.append((np.concatenate(keys[n - 1]["history"])[at], np.concatenate(keys[n - 1]["suffix"])[at]))
    _filled(model, parts, suffixes)
    _calibrate(model, [c or t for _, t, c in samples], reject_rate, accept_rate)
    return model


def _noise(texts: list[str]) -> list[str]:
    """Blocks of the texts with their characters shuffled, a few of each: letters of the language in no order of it."""
    rng = random.Random(5)
    out = []
    for text in texts:
        plain = "".join(map(chr, normalized(text) & (MARK - np.uint32(1))))
        out += ["".join(rng.sample(x, len(x))) for x in (plain[k : k + BLOCK] for k in range(0, 8 * BLOCK, BLOCK)) if len(x) == BLOCK]
    return out


#: Calibration texts that a limit needs; a language with fewer has the limit of all together, and if
#: these are fewer only texts without a letter are rejected.
LEAST_TEXTS = 20


def _calibrate(model: Model, held: list[list[str]], reject_rate: float, accept_rate: float) -> None:
    many = len(model.languages)
    model.mean, model.between, model.within, model.limit = np.zeros(many), np.full(many, 1e-4), np.ones(many), np.full(many, np.inf)
    model.report, odds = {}, []

    def deviations(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Of each text with letters its language, as it would be predicted, and how far off it is there."""
        chars, total, _, piecewise = model.score(texts)
        some = chars > 0
        n, own = chars[some], total[some].argmax(axis=1)
        return own, (-piecewise[some] / n - model.mean[own]) / np.sqrt(model.between[own] + model.within[own] / n)

    for k, texts in enumerate(held):
        chars, total, square, piecewise = model.score(texts)
        some = chars > 0
        if not some.any():
            continue
        n, s, q = chars[some], total[some, k], square[some, k]
        entropy = -piecewise[some] / n
        model.mean[k] = np.average(entropy, weights=np.minimum(n, 2000))
        model.within[k] = max(4 * (q.sum() / n.sum() - (s.sum() / n.sum()) ** 2), 1e-3)  # characters depend on each other
        model.between[k] = max(float(np.average((entropy - model.mean[k]) ** 2, weights=n)), 1e-4)
        e = -total[some] / n[:, None]
        odds.append(((e.min(axis=1)[:, None] - e) * np.sqrt(n)[:, None], e.argmin(axis=1), k))
    (clean_at, clean_all), (noise_at, noise_all) = deviations([t for x in held for t in x]), deviations([t for x in held for t in _noise(x)])
    for k in range(many):
        clean, noise = clean_all[clean_at == k], noise_all[noise_at == k]
        if min(len(clean), len(noise)) < LEAST_TEXTS:
            clean, noise = clean_all, noise_all
        if min(len(clean), len(noise)) >= LEAST_TEXTS:
            stay = float(clean[::2].max() * 1.05 if len(clean) < 2 / reject_rate else np.quantile(clean[::2], 1 - reject_rate))
            model.limit[k] = max(stay, float(np.quantile(noise[::2], accept_rate)))
            model.report[model.languages[k]] = len(clean[1::2]), float((clean[1::2] > model.limit[k]).mean()), len(noise[1::2]), float((noise[1::2] <= model.limit[k]).mean())
    best = (np.inf, 1.0)
    for sharp in (0.25, 0.5, 1.0, 2.0, 4.0, 8.0):
        loss = 0.0
        for o, _, k in odds:
            p = np.exp(o * sharp)
            loss -= np.log(np.maximum(p[:, k] / p.sum(axis=1), 1e-12)).sum()
        best = min(best, (loss, sharp))
    model.sharpness = best[1]


def _place(docs: DataFrame, id_col: str) -> Column:
    return F.xxhash64(F.col(id_col).cast("string"), F.lit("sample"))


def sample(docs: DataFrame, id_col: str, text_col: str, lang_col: str, train_chars: int, total_chars: int) -> DataFrame:
    """At most ``train_chars`` code points (or one text) of each language, ``total_chars`` in all: whole texts, in order of a hash of the id."""
    labelled = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    counts = labelled.groupBy(F.col(lang_col).alias("__lang")).agg(F.count(F.lit(1)).alias("__n"), F.sum(F.char_length(F.col(text_col).cast("string")).cast("double")).alias("__chars"))
    some = counts.limit(BROADCAST_ROWS + 1).collect()  # a row for each language
    few = len(some) <= BROADCAST_ROWS
    counts = docs.sparkSession.createDataFrame([tuple(r) for r in some], counts.schema) if few else written(counts, f"{shared_dir(docs.sparkSession)}/languages")
    train_chars = min(train_chars, total_chars // max(1, len(some) if few else counts.count()))
    # a hash limit that leaves about twice the bound, so that the exact cut below sorts little
    share = F.least(F.lit(1.0), F.greatest(2.0 * train_chars / F.greatest("__chars", F.lit(1.0)), F.lit(64.0) / F.col("__n")))
    rows = labelled.join(F.broadcast(counts) if few else counts, F.col(lang_col) == F.col("__lang"))
    rows = rows.where((_place(docs, id_col).bitwiseAND(0x7FFFFFFF)) / F.lit(2.0**31) < share)
    rows = rows.select(F.col("__lang").cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"), _place(docs, id_col).alias("place"))
    size = F.sum(F.char_length("text").cast("long")).over(Window.partitionBy("lang").orderBy("place", "text").rowsBetween(Window.unboundedPreceding, -1))
    return rows.withColumn("before", F.coalesce(size, F.lit(0))).where(F.col("before") < train_chars).select("lang", "text", "place")


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", train_chars: int = 1_500_000, total_chars: int = 24_000_000, order: int = 4, reject_rate: float = 0.0005, accept_rate: float = 0.01) -> Model | None:
    """Fit on labelled rows; None if there are none. ``train_chars`` (a language) and ``total_chars`` (all) bound the sample and with it the model."""
    rows = sample(docs, id_col, text_col, lang_col, train_chars, total_chars).collect()  # bounded by total_chars
    by: dict[str, tuple[list[str], list[str]]] = {}
    for lang, text, place in sorted((r.lang, r.text, r.place) for r in rows):
        by.setdefault(lang, ([], []))[place % 4 == 0].append(text)
    samples = [(lang, a or b, b) for lang, (a, b) in by.items()]
    return train(samples, order, reject_rate, accept_rate) if samples else None


def predict(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The language of every whole text.

    Returns ``keep`` (default: the id) and lang_pred, score (0 to 1), cross_entropy (nats a character),
    rejected. A text that is null or has no letter is ``und`` with score 0 and rejected; without a
    model every text is ``und`` with score 0, and only those without letters are rejected. Repeated
    rows stay; an empty table gives an empty result.
    """
    keep = keep if keep is not None else [id_col]
    own_text = [] if text_col in keep and dict(docs.dtypes)[text_col] == "string" else [F.col(text_col).cast("string").alias("__text")]
    source = docs.select(*[F.col(c) for c in keep], *own_text)
    at = len(keep) if own_text else keep.index(text_col)
    kept = source.select(*keep).schema
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by learn()
    extra = [("lang_pred", pa.string()), ("score", pa.float64()), ("cross_entropy", pa.float64()), ("rejected", pa.bool_())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in slices(batches, 4 << 20):
            texts = [t.decode() if t else None for t in text_bytes(batch.column(at))]
            if own is None:
                empty = [not t or not any(map(str.isalpha, t)) for t in texts]
                made = [["und"] * len(texts), [0.0] * len(texts), [None] * len(texts), empty]
            else:
                d = own.decide(texts)
                lang = ["und" if e else own.languages[b] for e, b in zip(d["empty"], d["best"], strict=True)]
                entropy = [None if e else float(x) for e, x in zip(d["empty"], d["entropy"], strict=True)]
                made = [lang, d["score"], entropy, d["rejected"]]
            columns = [batch.column(k) for k in range(len(keep))] + [pa.array(x, kind) for x, (_, kind) in zip(made, extra, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, names=[*keep, *(n for n, _ in extra)])

    kinds = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept), "lang_pred string", "score double", "cross_entropy double", "rejected boolean"])
    return mapped(source, run, kinds)


def without_rejected(docs: DataFrame, model: Model | None, text_col: str = "text") -> DataFrame:
    """The rows and columns of ``docs`` that the model doesn't reject; see ``predict``. A filter inside each task."""
    names, kinds = docs.columns, docs.schema
    at = names.index(text_col)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by learn()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in slices(batches, 4 << 20):
            texts = [t.decode() if t else None for t in text_bytes(batch.column(at))]
            gone = own.decide(texts)["rejected"].tolist() if own else [not t or not any(map(str.isalpha, t)) for t in texts]
            yield batch.filter(pa.array([not x for x in gone], pa.bool_()))

    return mapped(docs, run, kinds)


def held_out(id_col: str = "doc_id") -> Column:
    """The fold that is never learned from."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % 5 == 0
