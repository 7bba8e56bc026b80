"""SimHash near-duplicate groups by covering locality-sensitive hashing.

Fingerprints: 64-bit majority votes over XXH64 hashes of word shingles. Linking: bit ``i`` gets
a nonzero vector m(i) of GF(2)^(r+1); table ``v`` keeps the bits with <m(i), v> = 1. For any r
differing bits some v is orthogonal to all their vectors, so the two fingerprints agree on
every bit that table v keeps: each pair within radius r meets in one of the 2^(r+1) - 1 tables.

Only distinct fingerprints are linked, so exact copies never multiply. A bucket over
``bucket_rows`` is not compared where it is: its rows go through the same construction over the
bits that its mask left free, again exact, and there a bucket holds at most 2^(free bits)
distinct fingerprints (about 2^16), whatever the size of the corpus. The largest buckets, which a
bounded sketch finds, are told apart before the shuffle, so that no task reads one of them whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mapped, shared_dir, slices, text_bytes, written
from .components import connected_components

BITS = 64
PIECE = 1 << 20


def _votes(hashes: list[int]) -> np.ndarray:
    h = np.array(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8)
    return np.unpackbits(h, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)


def fingerprint(text: bytes | None, words: int = 4, seed: int = 42) -> int:
    """Fingerprint of one UTF-8 text; null, empty or blank text gives 0.

    A-Z are lower-cased, words are runs of bytes other than space and 0x09-0x0D, shingles are
    ``words`` of them joined by one space, repeats included; fewer words make one shingle. A bit
    is set if it is set in over half the hashes. Long texts go piece by piece.
    """
    total, n, carry, at = np.zeros(BITS, np.int64), 0, [], 0
    text = text or b""
    digest = xxhash.xxh64_intdigest
    while at < len(text):
        end = at + PIECE
        while end < len(text) and text[end] not in b" \t\n\x0b\x0c\r":
            end += 1
        run = carry + text[at:end].lower().split()
        at = end
        if len(run) < words:
            carry = run
            continue
        hashes = [digest(b" ".join(x), seed) for x in zip(*(run[k:] for k in range(words)), strict=False)]
        total += _votes(hashes)
        n += len(hashes)
        carry = run[len(run) - words + 1 :] if words > 1 else []
    if not n:
        if not carry:
            return 0
        total, n = _votes([digest(b" ".join(carry), seed)]), 1
    return int.from_bytes(np.packbits(total * 2 > n, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 4) -> DataFrame:
    """(doc_id, fp, print) for every row of ``docs``: the fingerprint's 64 bits as a signed long, and XXH64 of the text as Spark has it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            fps = np.array([fingerprint(t, words) for t in text_bytes(batch.column(1))], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps.view(np.int64)), batch.column(2)], names=["doc_id", "fp", "print"])

    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return mapped(source.withColumn("print", F.xxhash64("text")), run, "doc_id long, fp long, print long")


def covering_masks(radius: int, free: list[int] | None = None) -> list[int]:
    """The masks over the given bit positions; any ``radius`` of them are missed by some mask."""
    free = list(range(BITS)) if free is None else free
    last = (1 << (radius + 1)) - 1
    vectors = {bit: k % last + 1 for k, bit in enumerate(free)}
    return [sum(1 << bit for bit, m in vectors.items() if (m & v).bit_count() % 2) for v in range(1, last + 1)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _forest(x: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges that span the components of the values within ``radius`` bits; each value is visited once."""
    left, a, b = x.copy(), [], []
    while len(left) > 1:
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            p = queue.pop()
            near = np.bitwise_count(left ^ p) <= radius
            if near.any():
                found = left[near]
                a.append(np.full(len(found), p))
                b.append(found)
                queue.extend(found)
                left = left[~near]
    return (np.concatenate(a), np.concatenate(b)) if a else (x[:0], x[:0])


def _linker(radius: int, most: int):
    """Reads (path, key, fp) sorted by path and key; yields links (kind 0) and rows of buckets over ``most`` (kind 1)."""

    def out(kind, path, a, b) -> pa.RecordBatch:
        n = len(a)
        return pa.RecordBatch.from_arrays([pa.array(np.full(n, kind, np.int32)), pa.array(np.broadcast_to(np.asarray(path, np.int32), n)), pa.array(np.asarray(a).view(np.int64)), pa.array(np.asarray(b).view(np.int64))], names=["kind", "path", "a", "b"])

    def buckets(path, fp, starts, ends) -> Iterator[pa.RecordBatch]:
        size = ends - starts
        two = starts[size == 2]
        if len(two):
            a, b = fp[two], fp[two + 1]
            near = np.bitwise_count(a ^ b) <= radius
            yield out(0, 0, a[near], b[near])
        links = []
        for s, e in zip(starts[size > 2], ends[size > 2], strict=True):
            if e - s > most:
                yield out(1, path[s:e], fp[s:e], fp[s:e])
            else:
                links.append(_forest(fp[s:e], radius))
        if links:
            yield out(0, 0, np.concatenate([x for x, _ in links]), np.concatenate([x for _, x in links]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, key, fp = np.empty(0, np.int32), np.empty(0, np.int64), np.empty(0, np.uint64)
        spilled = None  # the bucket that is too large to hold
        for batch in batches:
            p, k, f = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            f = f.view(np.uint64)
            if spilled is not None:
                same = (p == spilled[0]) & (k == spilled[1])
                n = int(same.sum())
                if n:
                    yield out(1, p[:n], f[:n], f[:n])
                    p, k, f = p[n:], k[n:], f[n:]
                if not len(p):
                    continue
                spilled = None
            path, key, fp = np.concatenate([path, p]), np.concatenate([key, k]), np.concatenate([fp, f])
            new = np.flatnonzero((path[1:] != path[:-1]) | (key[1:] != key[:-1])) + 1
            starts = np.concatenate([[0], new]).astype(np.int64)
            yield from buckets(path, fp, starts[:-1], starts[1:])
            s = int(starts[-1])
            path, key, fp = path[s:], key[s:], fp[s:]
            if len(path) > most:
                spilled = (path[0], key[0])
                yield out(1, path, fp, fp)
                path, key, fp = path[:0], key[:0], fp[:0]
        if len(path):
            yield from buckets(path, fp, np.array([0]), np.array([len(path)]))

    return run


def _giants(keyed: DataFrame, most: int) -> list[int]:
    """Hashes of the largest buckets, as a sketch of bounded size finds them: at most 1000, none of ``most`` rows or fewer."""
    row = keyed.agg(F.expr("approx_top_k(xxhash64(path, key), 1000, 10000)").alias("top")).first()
    return [x.item for x in row.top or [] if x["count"] > most]


def links(fps: DataFrame, radius: int = 4, bucket_rows: int = 512) -> DataFrame:
    """(a, b): links that connect the distinct values of ``fp`` exactly as all pairs within ``radius`` bits do."""
    home = shared_dir(fps.sparkSession)
    rows = fps.select(F.lit(0).alias("path"), "fp")
    paths = [(0, list(range(BITS)), 0)]
    found: list[DataFrame] = []
    for level in range(2):
        masks, deeper = [], []
        for path, free, fixed in paths:
            for v, mask in enumerate(covering_masks(radius, free)):
                deeper.append((path * 31 + v + 1, [x for x in free if not mask >> x & 1], fixed | mask))
                masks.append((path, deeper[-1][0], fixed | mask))
        entry = {path: [] for path, _, _ in paths}
        for path, to, mask in masks:
            entry[path].append(F.struct(F.lit(to).alias("path"), F.col("fp").bitwiseAND(F.lit(_signed(mask))).alias("key")))
        if level == 0:
            spread = F.array(*entry[0])
        else:  # only the buckets that were too large, by their own masks
            spread = F.lit(None)
            for path in {p for p, _, _ in paths}:
                spread = F.when(F.col("path") == path, F.array(*entry[path])).otherwise(spread)
        keyed = rows.select(F.explode(spread).alias("x"), "fp").select("x.path", "x.key", "fp")
        giants = [] if level else _giants(keyed, bucket_rows)
        if giants:  # their rows go on from where they are, as one task would read all of a bucket
            heavy = F.xxhash64("path", "key").isin(giants)
            ahead = written(keyed.where(heavy).select("path", "fp"), f"{home}/giants")
            keyed = keyed.where(~heavy)
        keyed = keyed.repartition("path", "key").sortWithinPartitions("path", "key", "fp")
        most = bucket_rows if level == 0 else 1 << 30
        got = written(mapped(keyed, _linker(radius, most), "kind int, path int, a long, b long"), f"{home}/links{level}")
        found.append(got.where("kind = 0").select("a", "b"))
        if level:
            break
        over = got.where("kind = 1").select("path", F.col("a").alias("fp"))
        over = over.unionByName(ahead) if giants else over
        hot = {r.path for r in over.select("path").distinct().collect()}  # at most 31 values
        if not hot:
            break
        paths = [x for x in deeper if x[0] in hot]
        rows = over
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out.distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 4, radius: int = 4, bucket_rows: int = 512) -> DataFrame:
    """Group documents whose fingerprints chain within ``radius`` bits.

    One row for each input row: doc_id, fp (long), component_id (the smallest id of the group), print (XXH64 of the text).
    Null or blank texts have fingerprint 0 and are linked like any other. Rows with a null id
    keep their row and take the group's smallest non-null id. Repeated rows stay repeated. Other
    columns of ``docs`` are not read. An empty table gives an empty result.
    """
    home = shared_dir(docs.sparkSession)
    fps = written(fingerprints(docs, id_col, text_col, words), f"{home}/fingerprints")
    classes = written(fps.groupBy("fp").agg(F.min("doc_id").alias("least")), f"{home}/classes")
    parts = connected_components(links(classes, radius, bucket_rows))
    labelled = classes.join(parts, classes.fp == parts.node, "left").select("fp", "least", F.coalesce("component", "fp").alias("component"))
    least = labelled.groupBy("component").agg(F.min("least").alias("component_id"))
    named = written(labelled.join(least, "component").select("fp", "component_id"), f"{home}/named")
    return fps.join(named, "fp").select("doc_id", "fp", "component_id", "print")
