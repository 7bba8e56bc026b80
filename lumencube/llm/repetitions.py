"""Periodic runs of words, found by Main and Lorentz's divide and conquer.

A run is a stretch of consecutive words with smallest period q, at least ``least`` words and
``times`` periods long, that no neighbouring word extends with that period. A text's words become
small integers. A stretch is cut in the middle; Z-functions on both sides of the cut give, for every
period at once, how far words that far apart agree to the left and to the right of it, and so every
repetition that crosses the cut. Then both halves are searched alike. Every run lies whole in the first stretch whose
cut it crosses, so a repetition that would go on beyond its stretch is part of one found
before and is left. Of equal intervals the smallest period stays.

With three periods or more each word of a run is there three times. So before each cut a stretch falls into parts at the words
that it holds too rarely; in prose this leaves little to search, and no run is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import mapped, slices, text_bytes

LEAST = 24
TIMES = 3


def z_function(x: np.ndarray, until: int) -> np.ndarray:
    """For each place before ``until`` how long ``x`` agrees there with its own beginning; 0 for place 0."""
    n = len(x)
    z = [0] * until
    left = right = 0
    for i in (np.flatnonzero(x[1:until] == x[0]) + 1).tolist() if n else ():  # the others are 0
        if i < right and z[i - left] < right - i:
            z[i] = z[i - left]
            continue
        end, step = max(right, i + 1), 8
        while end < n:  # by growing blocks up to the first difference
            stop = min(n, end + step)
            odd = x[end:stop] != x[end - i : stop - i]
            at = int(odd.argmax())
            if odd[at]:
                end += at
                break
            end, step = stop, step * 4
        z[i], left, right = end - i, i, end
    return np.array(z, np.int64)


def _crossing(x: np.ndarray, low: int, cut: int, high: int, least: int, times: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(starts, ends, periods) of the repetitions within low to high that cross ``cut``."""
    u, v, wall = x[low:cut], x[cut:high], np.array([-1])
    for left, right, turned in ((u, v, False), (v[::-1], u[::-1], True)):
        # a whole period lies to the right: it agrees with what follows for ``on`` words, and with the left for ``back`` words
        most = min(len(right), (len(left) + len(right)) // times)
        if not most:
            continue
        on = np.append(z_function(right, min(most + 1, len(right))), 0)[1 : most + 1]
        joined = np.concatenate([left[::-1], wall, right[:most][::-1], left[::-1]])
        back = z_function(joined, len(left) + 1 + most)[len(left) + 1 :][::-1]
        period = np.arange(1, most + 1)
        length = back + period + on
        k = np.flatnonzero(length >= np.maximum(least, times * period))
        if len(k):
            start = cut + back[k] - length[k] if turned else cut - back[k]
            yield start, start + length[k], period[k]


def _parts(x: np.ndarray, low: int, high: int, least: int, times: int) -> Iterator[tuple[int, int]]:
    """The stretches of low to high whose words are all there ``times`` times at least."""
    todo = [(low, high)]
    while todo:
        low, high = todo.pop()
        if high - low < least:
            continue
        part = x[low:high]
        base = int(part.min())
        if int(part.max()) - base < 4 * len(part):
            at = part - base
        else:
            _, at = np.unique(part, return_inverse=True)
        rare = np.flatnonzero((np.bincount(at) < times)[at])
        if not len(rare):
            yield low, high
            continue
        edges = np.concatenate([[-1], rare, [high - low]])
        for k in np.flatnonzero(np.diff(edges) > least).tolist():
            todo.append((low + int(edges[k]) + 1, low + int(edges[k + 1])))


def find_runs(x: np.ndarray, least: int = LEAST, times: int = TIMES) -> list[tuple[int, int, int]]:
    """The runs (start, length, period) of an array of word numbers from 0, by start, then period."""
    if times < 2 or least < 2:
        raise ValueError("a run has two periods and two words at least")
    found: dict[tuple[int, int], int] = {}
    todo = list(_parts(x, 0, len(x), least, times))
    while todo:
        low, high = todo.pop()
        cut = (low + high) // 2
        for start, end, period in _crossing(x, low, cut, high, least, times):
            whole = np.ones(len(start), bool)
            if low > 0:
                whole &= (start > low) | (x[low - 1] != x[low - 1 + period])
            if high < len(x):
                whole &= (end < high) | (x[high] != x[high - period])
            for s, e, q in zip(start[whole].tolist(), end[whole].tolist(), period[whole].tolist(), strict=True):
                found[s, e] = min(found.get((s, e), q), q)
        todo += _parts(x, low, cut, least, times)
        todo += _parts(x, cut, high, least, times)
    return sorted((start, end - start, period) for (start, end), period in found.items())


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words joined by a space, without those that a run holds after its first period."""
    if not runs:
        return b" ".join(words)
    gone = np.zeros(len(words), bool)
    for start, length, period in runs:
        gone[start + period : start + length] = True
    return b" ".join([words[k] for k in np.flatnonzero(~gone).tolist()])


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST, times: int = TIMES) -> DataFrame:
    """Find the periodic runs of every whole text and collapse each to its first period.

    Words are ``[^\\x20\\x09-\\x0D]+``. One row for each input row: doc_id, n_words, runs
    array<struct<start, length, period>> by start, then period, and text, the words that stay joined by one space. Null and
    empty texts have no words; a null id stays; repeated rows stay; other columns are not read; an empty table gives
    an empty result. A text is searched as a whole in one task, in memory that grows with its words.
    """
    kinds = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            many, runs, texts = [], [], []
            for raw in text_bytes(batch.column(1)):
                words = raw.split() if raw else []  # bytes are split at exactly the six white-space characters
                number: dict[bytes, int] = {}
                ids = [number.setdefault(w, len(number)) for w in words] if len(words) >= least else []
                found = find_runs(np.array(ids, np.int64), least, times)
                many.append(len(words))
                runs.append([{"start": s, "length": n, "period": q} for s, n, q in found])
                texts.append(collapsed(words, found))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(many, pa.int64()), pa.array(runs, kinds), pa.array(texts, pa.binary()).cast(pa.string())], names=["doc_id", "n_words", "runs", "text"])

    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return mapped(source, run, "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, text string")


def strongest(runs: Column) -> Column:
    """The run of ``runs`` with the greatest exact length / period; of equals the first; null if there are none."""
    return F.aggregate(runs, F.get(runs, F.lit(0)), lambda best, x: F.when(x["length"] * best["period"] > best["length"] * x["period"], x).otherwise(best))


def digest(found: DataFrame) -> DataFrame:
    """The count of runs, the strongest of them, and SHA-256 of all runs and of the collapsed text."""
    lines = F.transform("runs", lambda x: F.concat(F.concat_ws(",", x["start"], x["length"], x["period"]), F.lit("\n")))
    best = found.select("*", strongest(F.col("runs")).alias("best"))
    return best.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2(F.col("text"), 256).alias("collapsed_sha256"),
    )


def with_planted_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text): of a tenth of the documents, by a hash of the id, the words from a place on repeat periodically, three to ten times.

    With h the CRC-32 of the decimal id and g = h div 10 this is so where h % 10 = 0: of n > 0 words each
    word i >= a becomes word a + (i - a) % p, where a = g % n and p = 1 + (n - a) div (3 + g % 8). Other texts, and rows with a null id, stay as they are.
    """
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.filter(F.split("text", "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    some = source.select("*", h.alias("h"), F.when(h % 10 == 0, words).alias("words")).select("*", F.expr("h div 10").alias("g"), F.size("words").cast("long").alias("n"))
    some = some.select("*", F.expr("if(n > 0, g % n, null)").alias("a")).select("*", F.expr("1 + (n - a) div (3 + g % 8)").alias("p"))
    # the words up to a + p, and then those from a on: whole copies and the beginning of one more
    again = F.expr("concat(slice(words, 1, int(a)), flatten(array_repeat(slice(words, int(a) + 1, int(p)), int((n - a) div p))), slice(words, int(a) + 1, int((n - a) % p)))")
    return some.select("doc_id", F.when(F.col("a").isNotNull(), F.array_join(again, " ")).otherwise(F.col("text")).alias("text"))
