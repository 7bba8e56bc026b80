"""Best-fit packing of token sequences, planned on the histogram of lengths.

1. One pass encodes each text and cuts only those over the limit; it keeps lengths, not ids.
2. A histogram of at most ``limit`` lengths goes to the driver: its size doesn't depend on the data.
3. Best fit decreasing runs on counts: groups of equal sequences take groups of equal pieces in
   bulk, so planning time depends on the number of lengths, not of documents. The plan is a
   table of rank ranges within each length.
4. Every piece gets its rank within its length and takes the slot of that rank. Ranks come from
   counts by (chunk, length) and positions inside a chunk, so no task ever holds a whole length.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import mapped, shared_dir, slices, text_bytes, written
from .tokens import default_vocabulary, encoder

LIMIT = 2048


def encoded_pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", limit: int = LIMIT, end_id: int = 0, vocabulary: str | None = None) -> DataFrame:
    """(doc_id, piece, start, length, ids, chunk, nth): the token ids of each piece as little-endian uint32 bytes;
    ``chunk`` is the task that made the row, ``nth`` counts from 0 within its chunk and length.

    A document is its text's ids and ``end_id``; null and empty texts are ``end_id`` alone. Only
    documents over ``limit`` are cut; all their pieces but the first have ``limit`` ids.
    """
    path = vocabulary or default_vocabulary()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        own, chunk, seen = encoder(path), TaskContext.get().partitionId(), {}
        for batch in slices(batches, 2 << 20):
            doc, piece, start, length, data, nth = [], [], [], [], [], []
            texts = [t.decode() if t else "" for t in text_bytes(batch.column(1))]
            for key, ids in zip(batch.column(0).to_pylist(), own.batch(texts), strict=True):
                ids = np.append(ids, np.uint32(end_id)).astype("<u4")
                first = (len(ids) - 1) % limit + 1
                cuts = [0, *range(first, len(ids) + 1, limit)]
                for k, (s, e) in enumerate(zip(cuts, cuts[1:], strict=False)):
                    doc.append(key)
                    piece.append(k)
                    start.append(s)
                    length.append(e - s)
                    data.append(ids[s:e].tobytes())
                    nth.append(seen.get(e - s, 0))
                    seen[e - s] = nth[-1] + 1
            columns = [pa.array(doc, pa.int64()), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(data, pa.binary())]
            columns += [pa.array(np.full(len(doc), chunk, np.int32)), pa.array(nth, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "piece", "start", "length", "ids", "chunk", "nth"])

    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return mapped(source, run, "doc_id long, piece int, start long, length long, ids binary, chunk int, nth long")


def plan(histogram: dict[int, int], limit: int = LIMIT) -> list[tuple[int, int, int, int, int]]:
    """Best fit decreasing over counts.

    Returns ranges (length, rank_from, rank_to, first_sequence, offset): the pieces of that length
    with ranks from rank_from (0-based) up to rank_to lie at ``offset`` in the sequences counted
    from first_sequence.
    """
    free: list[int] = []  # the room left in open groups, ascending
    groups: dict[int, list[tuple[int, int]]] = {}  # room -> [(first sequence, how many)]
    slots, next_sequence = [], 0

    def keep(room: int, first: int, n: int) -> None:
        if room and n:
            if room not in groups:
                bisect.insort(free, room)
                groups[room] = []
            groups[room].append((first, n))

    for length in sorted(histogram, reverse=True):
        if not 0 < length <= limit:
            raise ValueError(f"length {length} is not within 1 to {limit}")
        left, rank = histogram[length], 0
        while left:
            k = bisect.bisect_left(free, length)
            if k < len(free):
                room = free[k]
                first, n = groups[room].pop()
                if not groups[room]:
                    del groups[room]
                    free.pop(k)
            else:
                room, first = limit, next_sequence
                n = -(-left // (limit // length))
                next_sequence += n
            fit = room // length
            full, some = divmod(min(left, n * fit), fit)
            for begin, many, each in ((first, full, fit), (first + full, 1, some)):
                if many and each:
                    for j in range(each):
                        slots.append((length, rank, rank + many, begin, limit - room + j * length))
                        rank += many
                    left -= many * each
                    keep(room - each * length, begin, many)
            used = full + (some > 0)
            keep(room, first + used, n - used)
    return slots


def with_ranks(pieces: DataFrame) -> DataFrame:
    """Add ``rank``: from 0 within each length, in any order. ``pieces`` must be a written table with ``chunk`` and ``nth``."""
    counts = pieces.groupBy("chunk", "length").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("chunk", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    return pieces.join(base, ["chunk", "length"]).withColumn("rank", F.col("base") + F.col("nth")).drop("base")


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", limit: int = LIMIT, end_id: int = 0, vocabulary: str | None = None) -> DataFrame:
    """Pack all documents into sequences of at most ``limit`` token ids.

    Returns for each piece: doc_id, piece, start (ids of its document before it), length,
    ids_crc32, sequence_id, offset. Sequences fill from offset 0 without gaps. Null and empty
    texts are one end id. Repeated rows are packed again, rows with a null id too; other columns
    are not read; an empty table gives an empty result.
    """
    home = shared_dir(docs.sparkSession)
    raw = encoded_pieces(docs, id_col, text_col, limit, end_id, vocabulary)
    pieces = written(raw.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "chunk", "nth"), f"{home}/pieces")
    histogram = {r.length: r.n for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most ``limit`` rows
    slots = docs.sparkSession.createDataFrame(plan(histogram, limit), "length long, rank_from long, rank_to long, first_sequence long, offset long")
    ranked = with_ranks(pieces)
    placed = ranked.join(F.broadcast(slots), (ranked.length == slots.length) & (ranked["rank"] >= slots.rank_from) & (ranked["rank"] < slots.rank_to))
    return placed.select("doc_id", "piece", "start", ranked.length, "ids_crc32", (F.col("first_sequence") + F.col("rank") - F.col("rank_from")).alias("sequence_id"), "offset")


def sequences(docs: DataFrame, placed: DataFrame, id_col: str = "doc_id", text_col: str = "text", limit: int = LIMIT, end_id: int = 0, vocabulary: str | None = None) -> DataFrame:
    """The packed sequences themselves: (sequence_id, ids array<int>, doc_ids), for ids that are unique and not null."""
    raw = encoded_pieces(docs, id_col, text_col, limit, end_id, vocabulary).select("doc_id", "piece", "ids")
    both = raw.join(placed.select("doc_id", "piece", "sequence_id", "offset"), ["doc_id", "piece"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [[x["ids"] for x in row] for row in batch.column(1).to_pylist()]
            ids = [np.frombuffer(b"".join(x), "<u4").astype(np.int32) for x in parts]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.list_(pa.int32())), batch.column(2)], names=["sequence_id", "ids", "doc_ids"])

    grouped = both.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "doc_id", "ids"))).alias("parts"))  # at most ``limit`` ids
    return mapped(grouped.select("sequence_id", "parts", F.col("parts.doc_id").alias("doc_ids")), run, "sequence_id long, ids array<int>, doc_ids array<long>")
