"""Document fingerprints: a quartile digest of hashed byte triplets.

Triplets of bytes within a sliding window are hashed into ``BUCKETS`` counters. The digest keeps of each
counter only which quarter of the counters it lies in (two bits), and of the text its length on a
logarithmic scale and how the quartiles compare. A change to a part of a text moves few counters
over a quartile, so digests of alike texts are alike whatever their lengths, and a digest has the same
size for every text.

Digests are compared bucket by bucket: a counter that moved by one, two or three quarters adds
``STEPS`` of that; lengths and quartiles add up to a limit each. The sum is at most ``MOST``, so 1 less its
share is a likeness from 0 to 1, and 1 for equal texts.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from .common import mapped, shared_dir, slices, text_bytes, written

BUCKETS = 256
#: The places in the window, after the first, of a triplet's other two bytes.
TRIPLETS = ((1, 2), (1, 3), (2, 3))
#: What a counter's move by so many quarters adds to the difference.
STEPS = np.array([0, 1, 2, 4], np.int64)
#: Length codes to a doubling of the length; the most that lengths, and each ratio of quartiles, can add.
PER_DOUBLING, MOST_LENGTH, MOST_RATIO = 8, 24, 8
MOST = int(STEPS[-1]) * BUCKETS + MOST_LENGTH + 2 * MOST_RATIO
#: Bytes of a digest: length, ratios, four buckets a byte.
SIZE = 2 + BUCKETS // 4
CHUNK = 1 << 20


def counters(raw: bytes) -> np.ndarray:
    """How many triplets of the bytes fall into each bucket."""
    out, reach = np.zeros(BUCKETS, np.int64), max(b for _, b in TRIPLETS)
    for at in range(0, len(raw), CHUNK):  # a chunk owns the triplets that begin in it
        x = np.frombuffer(raw, np.uint8, min(CHUNK + reach, len(raw) - at), at).astype(np.uint32)
        for k, (i, j) in enumerate(TRIPLETS):
            n = min(CHUNK, len(x) - j)
            if n > 0:
                h = x[:n] * np.uint32(0x9E3779B1) ^ x[i : i + n] * np.uint32(0x85EBCA77) ^ x[j : j + n] * np.uint32(0xC2B2AE3D)
                h = (h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D + 2 * k)
                out += np.bincount(h >> np.uint32(24), minlength=BUCKETS)
    return out


def fingerprint(raw: bytes) -> str:
    """The digest of a UTF-8 text in lowercase hexadecimal; texts too short for a triplet have no counts."""
    counts = counters(raw)
    low, mid, high = np.sort(counts)[[BUCKETS // 4 - 1, BUCKETS // 2 - 1, 3 * BUCKETS // 4 - 1]].tolist()
    code = (counts > low).astype(np.uint8) + (counts > mid) + (counts > high)
    length = min(255, int(math.log2(1 + len(raw)) * PER_DOUBLING))
    ratios = 16 * (15 * low // high) + 15 * mid // high if high else 0
    return bytes([length, ratios, *(code.reshape(-1, 4) @ np.array([1, 4, 16, 64], np.uint8)).tolist()]).hex()


def _unpacked(prints: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    x = np.frombuffer(bytes.fromhex("".join(prints)), np.uint8).reshape(len(prints), SIZE).astype(np.int64)
    buckets = x[:, 2:, None] >> np.array([0, 2, 4, 6]) & 3
    return x[:, 0], np.stack([x[:, 1] >> 4, x[:, 1] & 15], axis=1), buckets.reshape(len(prints), BUCKETS)


def likenesses(a: list[str], b: list[str]) -> np.ndarray:
    """The likeness of each digest of ``a`` to that of ``b`` in its place."""
    (length, ratios, buckets), (length_b, ratios_b, buckets_b) = _unpacked(a), _unpacked(b)
    off = STEPS[np.abs(buckets - buckets_b)].sum(axis=1)
    off += np.minimum(np.abs(length - length_b), MOST_LENGTH)
    off += np.minimum(np.abs(ratios - ratios_b), MOST_RATIO).sum(axis=1)
    return 1 - off / MOST


@F.pandas_udf(DoubleType())
def likeness(a: pd.Series, b: pd.Series) -> pd.Series:
    """The likeness of two digest columns, from 0 to 1; null where either is null."""
    out = np.full(len(a), np.nan)
    both = (a.notna() & b.notna()).to_numpy()
    out[both] = likenesses(a[both].tolist(), b[both].tolist())
    return pd.Series(out).astype("Float64").mask(~both)


def _source(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fingerprint) of every whole text, one row for each input row.

    Null texts are empty; null ids stay; repeated rows stay; other columns are not read; an empty table gives
    an empty result.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([fingerprint(t or b"") for t in text_bytes(batch.column(1))], pa.string())], names=["doc_id", "fingerprint"])

    return mapped(_source(docs, id_col, text_col), run, "doc_id long, fingerprint string")


_DONE = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, next_fingerprint string"
_KINDS = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string())


def _edited(doc: int | None, raw: bytes, own: str, following: bytes, following_print: str, share: int) -> tuple:
    text = raw.decode()
    n = len(text) // share
    # n code points have n to 4 n bytes, so only so much of the next text is decoded
    edited = (text[: len(text) - n] + following[: 4 * n].decode(errors="ignore")[:n]).encode()
    return doc, len(text), hashlib.sha256(edited).hexdigest(), own, fingerprint(edited), following_print


def _batch(rows: list[tuple], names: list[str], kinds: tuple) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)


def edited_by_next(docs: DataFrame, share: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every whole text, of the next one and of a text edited with it.

    The edited text has, for the last floor(n_chars / ``share``) code points, the first as many (or all) of the
    next document in ascending doc_id; after the last comes the first, which may be the document itself. One row for
    each input row: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, next_fingerprint.

    Null texts are empty; null ids come before all others, and rows of one id go by a hash of their texts and then by their
    place; other columns are not read; an empty table gives an empty result. Texts are range-partitioned once in that order and
    a task streams its range with two texts in memory. Only the first and the last document of each range are put
    aside, and meet across the ranges' ends by a join on the range's number.
    """
    home = shared_dir(docs.sparkSession)
    names = [x.split()[0] for x in _DONE.split(", ")]
    aside_names, aside_kinds = [*names, "part", "at", "text"], (*_KINDS, pa.int32(), pa.int32(), pa.string())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, held = TaskContext.get().partitionId(), None

        def aside(at: int) -> tuple:
            return held[0], None, None, held[2], None, None, part, at, held[1].decode()

        for batch in slices(batches):
            rows = []
            for doc, text in zip(batch.column(0).to_pylist(), text_bytes(batch.column(1)), strict=True):
                text = text or b""
                now = (doc, text, fingerprint(text))
                if held:
                    rows.append((*_edited(*held, *now[1:], share), part, 0, None))
                first, held = not held, now
                if first:
                    rows.append(aside(1))
            yield _batch(rows, aside_names, aside_kinds)
        if held:
            yield _batch([aside(2)], aside_names, aside_kinds)

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            doc, own, own_print, following, following_print = (batch.column(k) for k in range(5))
            rows = zip(doc.to_pylist(), text_bytes(own), own_print.to_pylist(), text_bytes(following), following_print.to_pylist(), strict=True)
            yield _batch([_edited(*r, share) for r in rows], names, _KINDS)

    source = _source(docs, id_col, text_col).withColumns({"key": F.xxhash64("text"), "place": F.monotonically_increasing_id()})
    order = [F.asc_nulls_first("doc_id"), F.asc("key"), F.asc("place")]
    ordered = source.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    rows = written(mapped(ordered, run, f"{_DONE}, part int, at int, text string"), f"{home}/rows")
    first, last = rows.where(F.col("at") == 1), rows.where(F.col("at") == 2)
    parts = sorted(r.part for r in first.select("part").collect())  # one row for each range
    after = docs.sparkSession.createDataFrame([*zip(parts, parts[1:] + parts[:1], strict=True)], "part int, next_part int")
    following = first.select(F.col("part").alias("next_part"), F.col("text").alias("next_text"), F.col("fingerprint").alias("next_print"))
    ends = last.join(after, "part").join(following, "next_part").select("doc_id", "text", "fingerprint", "next_text", "next_print")
    return rows.where(F.col("at") == 0).select(*names).unionByName(mapped(ends, finish, _DONE))


def compared(rows: DataFrame) -> DataFrame:
    """The rows of ``edited_by_next`` with the likeness of the fingerprint to the edited text's and to the next document's."""
    near = {"near_edited": likeness("fingerprint", "edited_fingerprint"), "near_next": likeness("fingerprint", "next_fingerprint")}
    return rows.withColumns(near).drop("next_fingerprint")
