"""Token-id files: bit-plane shuffled, zstandard-compressed chunks with a chunk index.

A shard file holds the ids of a contiguous range of documents in ascending id order:

    magic "LCBP0001" | chunk payloads | index | index length (u64) | magic

A chunk is ``block`` consecutive ids of the shard (the last may be shorter; chunks ignore document
bounds). Its ids are transposed: plane k has bit k (or byte k) of every id, and each plane is a
zstandard frame of its own. The index is a zstandard frame of JSON: for each chunk its place, ids
and plane sizes; for each document its id, first id in the shard and count (delta coded). Files are
written under a task's own name and then moved, so a task that runs twice leaves one whole file.
The manifest has one line for each shard: name, ids before it, ids and documents in it.
"""

from __future__ import annotations

import json
import re
import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import mapped, slices, text_bytes
from .tokens import default_vocabulary, encoder

MAGIC = b"LCBP0001"
BLOCK = 1 << 16


def pack_chunk(ids: np.ndarray, plane: str = "bit", level: int = 3) -> tuple[bytes, list[int]]:
    """The planes of one block of uint32 ids, lowest first; only as many as the largest id needs."""
    ids = np.ascontiguousarray(ids, "<u4")
    zip_ = zstandard.ZstdCompressor(level=level).compress
    top = int(ids.max()).bit_length() if len(ids) else 0
    if plane == "byte":
        planes = [np.ascontiguousarray(ids.view(np.uint8).reshape(-1, 4)[:, k]).tobytes() for k in range(-(-top // 8))]
    else:
        narrow = ids.astype(np.uint16) if top <= 16 else ids
        planes = [np.packbits((narrow & narrow.dtype.type(1 << k)) != 0, bitorder="little").tobytes() for k in range(top)]
    out = [zip_(x) for x in planes]
    return b"".join(out), [len(x) for x in out]


def unpack_chunk(data: bytes, sizes: list[int], n: int, plane: str = "bit") -> np.ndarray:
    """The ids that ``pack_chunk`` was given."""
    unzip = zstandard.ZstdDecompressor().decompress
    kind = np.uint16 if plane == "bit" and len(sizes) <= 16 else np.uint32
    ids, at = np.zeros(n, kind), 0
    for k, size in enumerate(sizes):
        raw = np.frombuffer(unzip(data[at : at + size]), np.uint8)
        at += size
        if plane == "byte":
            ids |= raw.astype(np.uint32) << np.uint32(8 * k)
        else:
            ids |= np.unpackbits(raw, count=n, bitorder="little").astype(kind) << kind(k)
    return ids.astype(np.uint32)


def qualified(spark: SparkSession, uri: str) -> str:
    """``uri`` with its scheme: a path without one lies in the cluster's default file system, as for Spark's own readers."""
    place = spark._jvm.org.apache.hadoop.fs.Path(uri)
    if place.toUri().getScheme() is None:
        place = place.makeQualified(spark._jvm.org.apache.hadoop.fs.FileSystem.getDefaultUri(spark._jsc.hadoopConfiguration()), spark._jvm.org.apache.hadoop.fs.Path("/"))
    return re.sub("^file:/+", "file:///", place.toString())


def _files(uri: str) -> tuple[fs.FileSystem, str]:
    """The store and path of a qualified place."""
    return fs.FileSystem.from_uri(uri)


class ShardWriter:
    """Writes one shard as ids come; memory holds one block and the documents' counts."""

    def __init__(self, uri: str, name: str, block: int = BLOCK, plane: str = "bit"):
        self.store, root = _files(uri)
        self.store.create_dir(root, recursive=True)
        self.final, self.temp = f"{root}/{name}", f"{root}/.{name}.{uuid.uuid4().hex}"
        self.out = self.store.open_output_stream(self.temp)
        self.out.write(MAGIC)
        self.at, self.block, self.plane = len(MAGIC), block, plane
        self.rest, self.held, self.chunks, self.docs, self.counts = [], 0, [], [], []

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.docs.append(doc_id)
        self.counts.append(len(ids))
        self.rest.append(ids)
        self.held += len(ids)
        if self.held >= self.block:
            held = np.concatenate(self.rest)
            for k in range(0, len(held) - self.block + 1, self.block):
                self._chunk(held[k : k + self.block])
            self.rest = [held[len(held) - len(held) % self.block :].copy()]
            self.held = len(self.rest[0])

    def _chunk(self, ids: np.ndarray) -> None:
        data, sizes = pack_chunk(ids, self.plane)
        self.out.write(data)
        self.chunks.append([self.at, len(ids), sizes])
        self.at += len(data)

    def close(self) -> tuple[int, int]:
        """Finish the file; the numbers of ids and documents in it."""
        if self.held:
            self._chunk(np.concatenate(self.rest))
        index = zstandard.compress(json.dumps({"plane": self.plane, "chunks": self.chunks, "docs": self.docs, "counts": self.counts}).encode())
        self.out.write(index + struct.pack("<Q", len(index)) + MAGIC)
        self.out.close()
        self.store.move(self.temp, self.final)
        return sum(self.counts), len(self.docs)


class ShardReader:
    """Random access to one shard: the index first, then only the chunks that are asked for."""

    def __init__(self, uri: str, name: str):
        store, root = _files(uri)
        self.file = store.open_input_file(f"{root}/{name}")
        size = self.file.size()
        tail = self.file.read_at(16, size - 16)
        if tail[8:] != MAGIC or self.file.read_at(8, 0) != MAGIC:
            raise ValueError(f"{name} is not a shard")
        (n,) = struct.unpack("<Q", tail[:8])
        self.index = json.loads(zstandard.decompress(self.file.read_at(n, size - 16 - n)))

    def documents(self) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """(doc_id, first id in the shard, ids), in order; memory holds the chunks of one document."""
        chunks, ids, start = iter(self.index["chunks"]), np.empty(0, np.uint32), 0
        for doc, n in zip(self.index["docs"], self.index["counts"], strict=True):
            parts = [ids]
            have = len(ids)
            while have < n:
                parts.append(self._read(*next(chunks)))
                have += len(parts[-1])
            ids = np.concatenate(parts) if len(parts) > 1 else ids
            yield doc, start, ids[:n]
            ids = ids[n:]
            start += n

    def _read(self, at: int, n: int, sizes: list[int]) -> np.ndarray:
        return unpack_chunk(self.file.read_at(sum(sizes), at), sizes, n, self.index["plane"])

    def span(self, start: int, stop: int) -> np.ndarray:
        """ids from ``start`` up to ``stop`` of the shard, reading only their chunks."""
        out, at = [], 0
        for place, n, sizes in self.index["chunks"]:
            if at < stop and at + n > start:
                out.append(self._read(place, n, sizes)[max(0, start - at) : stop - at])
            at += n
        return np.concatenate(out) if out else np.empty(0, np.uint32)


def write_ids(docs: DataFrame, uri: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 2, vocabulary: str | None = None, block: int = BLOCK, plane: str = "bit") -> DataFrame:
    """Encode whole texts and write them, with ``end_id`` after each, as shards in ascending id order.

    Null texts are empty, null ids come first, repeated ids are ordered by a hash of their texts; other
    columns are not read. Texts are range-partitioned by id, hash and place in the input, so a shard is
    one task's range and an id with very many rows, or none, fills as many as it needs;
    adaptive execution sets their size. Returns the manifest (shard, name, start, n_ids, n_docs), which is
    one row for each shard, and writes it beside them.
    """
    path, uri = vocabulary or default_vocabulary(), qualified(docs.sparkSession, uri)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        own, shard, writer = encoder(path), TaskContext.get().partitionId(), None
        for batch in slices(batches, 2 << 20):
            writer = writer or ShardWriter(uri, f"shard-{shard:06d}.lcbp", block, plane)
            texts = [t.decode() if t else "" for t in text_bytes(batch.column(1))]
            for key, ids in zip(batch.column(0).to_pylist(), own.batch(texts), strict=True):
                writer.add(key, np.append(ids, np.uint32(end_id)))
        if writer:
            n_ids, n_docs = writer.close()
            yield pa.RecordBatch.from_pydict({"shard": pa.array([shard], pa.int32()), "n_ids": pa.array([n_ids], pa.int64()), "n_docs": pa.array([n_docs], pa.int64())})

    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    source = source.withColumns({"key": F.xxhash64("text"), "place": F.monotonically_increasing_id()})
    order = [F.asc_nulls_first("doc_id"), F.asc("key"), F.asc("place")]
    ordered = source.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    made = sorted(mapped(ordered, run, "shard int, n_ids long, n_docs long").collect())  # one row for each shard
    rows, at = [], 0
    for shard, n_ids, n_docs in made:
        rows.append((shard, f"shard-{shard:06d}.lcbp", at, n_ids, n_docs))
        at += n_ids
    store, root = _files(uri)
    store.create_dir(root, recursive=True)
    with store.open_output_stream(f"{root}/manifest.json") as out:
        out.write(json.dumps(rows).encode())
    return _manifest(docs.sparkSession, rows)


def _manifest(spark: SparkSession, rows: list) -> DataFrame:
    return spark.createDataFrame([tuple(r) for r in rows], "shard int, name string, start long, n_ids long, n_docs long")


def read_manifest(spark: SparkSession, uri: str) -> DataFrame:
    store, root = _files(qualified(spark, uri))
    with store.open_input_file(f"{root}/manifest.json") as file:
        return _manifest(spark, json.loads(file.read()))


def read_ids(spark: SparkSession, uri: str) -> DataFrame:
    """(doc_id, start, ids): every document from the files; start counts the ids of all documents before it; ids are little-endian uint32 bytes."""
    uri = qualified(spark, uri)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                held, size = ([], [], []), 0
                for doc, start, ids in ShardReader(uri, name).documents():
                    for column, x in zip(held, (doc, base + start, ids.astype("<u4").tobytes()), strict=True):
                        column.append(x)
                    size += len(ids)
                    if size > 1 << 20:
                        yield _rows(held)
                        held, size = ([], [], []), 0
                if held[0]:
                    yield _rows(held)

    shards = read_manifest(spark, uri).select("name", "start")
    n = max(1, shards.count())
    return shards.repartition(n, "name").mapInArrow(run, "doc_id long, start long, ids binary")


def _rows(held) -> pa.RecordBatch:
    kinds = (("doc_id", pa.int64()), ("start", pa.int64()), ("ids", pa.binary()))
    return pa.RecordBatch.from_arrays([pa.array(x, kind) for x, (_, kind) in zip(held, kinds, strict=True)], names=[n for n, _ in kinds])
