"""Hard-negative mining by blocked dense matrix products.

Vectors are scaled to whole numbers and packed into blocks of rows. Blocks of anchors meet blocks of
candidates, and a matrix product in float64 scores a pair of blocks at once: as long as no sum of products can reach 2^53 it is
exact, and where one could, Python's integers score that pair of blocks instead.

1. Each task keeps the best same-label rows of every anchor it has seen. Such lists can be merged, so a
   window over the tasks' lists gives each anchor's positives.
2. The positives travel with their anchors, in new blocks, through the candidates again. Each of
   them opens a window of scores, and the best different-label rows in each window are kept and merged alike.

Once a list is full, only candidates that reach its last score leave the matrix, so little is sorted.
Anchor blocks are broadcast while all of them are within ``BROADCAST_BYTES``; beyond that anchors and candidates
meet in a grid of strips and groups on the shuffle, in one plan whatever their number.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import mapped, shared_dir, written

#: Rows and bytes of vectors of a block at most; anchors scored at once.
ROWS, BLOCK_BYTES, TILE = 2048, 4 << 20, 256
#: Bytes of anchors that are broadcast at most.
BROADCAST_BYTES = 64 << 20
#: Entries of lists that a task holds before it passes them on.
HELD = 1 << 21
_EXACT = 2.0**53
_LEAST = np.iinfo(np.int64).min


def best(group: np.ndarray, ids: np.ndarray, score: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each group the ``k`` highest scores, ties to the smaller id, in that order."""
    order = np.lexsort((ids, ~score, group))
    group, ids, score = group[order], ids[order], score[order]
    first = np.flatnonzero(np.diff(group, prepend=-1))
    nth = np.arange(len(group)) - np.repeat(first, np.diff(np.append(first, len(group))))
    return group[nth < k], ids[nth < k], score[nth < k]


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of the whole-number rows of ``a`` and ``b``: exact, as floats or, where a sum could reach 2^53, as Python's integers."""
    if a.size and b.size and float(np.abs(a).max()) * float(np.abs(b).max()) * a.shape[1] >= _EXACT:
        whole = [[[int(x) for x in row] for row in m.tolist()] for m in (a, b)]
        return np.array([[sum(x * y for x, y in zip(r, s, strict=True)) for s in whole[1]] for r in whole[0]], object).reshape(len(a), len(b))
    return a @ b.T


class _Lists:
    """The best ``k`` of each of ``n`` groups so far."""

    def __init__(self, n: int, k: int) -> None:
        self.k, self.floor = k, np.full(n, _LEAST)
        self.group = self.ids = self.score = np.empty(0, np.int64)

    def add(self, group: np.ndarray, ids: np.ndarray, score: np.ndarray) -> None:
        if not len(group):
            return
        joined = (np.concatenate(x) for x in ((self.group, group), (self.ids, ids), (self.score, score.astype(np.int64))))
        self.group, self.ids, self.score = best(*joined, self.k)
        last = np.flatnonzero(np.diff(self.group, append=-1))
        full = last[np.bincount(self.group)[self.group[last]] == self.k]
        self.floor[self.group[full]] = self.score[full]


def _pack(scored: bool) -> Callable:
    """Rows (id, label, dim, vector[, positives]) into blocks of one dimension each."""
    extra = ("many", "positive_ids", "positive_scores") if scored else ()

    def made(dim: int, rows: list[tuple]) -> dict:
        held = {"dim": dim, "ids": np.array([r[0] for r in rows], np.int64), "labels": np.array([r[1] for r in rows], np.int64), "vectors": np.array([r[2] for r in rows], np.float64)}
        if scored:
            held["many"] = np.array([len(r[3]) for r in rows], np.int64)
            held["positive_ids"] = np.array([p["id"] for r in rows for p in r[3]], np.int64)
            held["positive_scores"] = np.array([p["score"] for r in rows for p in r[3]], np.int64)
        return held

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, nth, held, size = TaskContext.get().partitionId(), 0, {}, 0

        def block(dim: int) -> pa.RecordBatch:
            nonlocal nth, size
            rows = held.pop(dim)
            size -= len(rows) * max(dim, 1)
            columns = made(dim, rows)
            out = {"dim": pa.array([dim], pa.int32()), "block": pa.array([part << 33 | nth], pa.int64())}
            out |= {name: pa.array([columns[name].tobytes()], pa.binary()) for name in ("ids", "labels", "vectors", *extra)}
            nth += 1
            return pa.RecordBatch.from_pydict(out)

        for batch in batches:
            columns = [batch.column(k) for k in range(batch.num_columns)]
            for k, dim in enumerate(columns[2].to_pylist()):
                row = (columns[0][k].as_py(), columns[1][k].as_py(), columns[3][k].values.to_numpy(zero_copy_only=False), *([columns[4][k].as_py()] if scored else []))
                held.setdefault(dim, []).append(row)
                size += max(dim, 1)
                if len(held[dim]) >= ROWS or len(held[dim]) * dim * 8 >= BLOCK_BYTES:
                    yield block(dim)
                while size * 8 >= 4 * BLOCK_BYTES:  # many dimensions at once
                    yield block(max(held, key=lambda d: len(held[d]) * max(d, 1)))
        for dim in list(held):
            yield block(dim)

    return run


_BLOCK = "dim int, block long, ids binary, labels binary, vectors binary"
_SCORED = f"{_BLOCK}, many binary, positive_ids binary, positive_scores binary"


def _meeting(candidates: DataFrame, anchors: DataFrame) -> DataFrame:
    """Every pair of a candidate block and an anchor block of the same dimension; the anchors' columns begin with ``a_``."""
    spark = anchors.sparkSession
    size = anchors.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.length("ids") + F.length("vectors")), F.lit(0)).alias("bytes")).first()
    n = candidates.count()
    tasks = max(1, min(n, max(2 * spark.sparkContext.defaultParallelism, n * max(1, size.n) // 512)))
    named = anchors.select("dim", *[F.col(c).alias(f"a_{c}") for c in anchors.columns if c != "dim"])
    if size.bytes <= BROADCAST_BYTES:
        return candidates.repartition(tasks).join(F.broadcast(named), "dim")
    strips = -(-size.bytes // BROADCAST_BYTES)
    left = candidates.select("*", F.pmod(F.xxhash64("block"), F.lit(tasks)).alias("group"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(strips - 1).cast("long"))).alias("strip"))
    right = named.select("*", F.pmod(F.xxhash64("a_block"), F.lit(strips)).alias("strip"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(tasks - 1).cast("long"))).alias("group"))
    return left.join(right, ["dim", "group", "strip"])


def _read(batch: pa.RecordBatch, k: int, prefix: str, extra: tuple[str, ...] = ()) -> tuple:
    dim = batch["dim"][k].as_py()
    get = lambda name, kind=np.int64: np.frombuffer(batch[prefix + name][k].as_buffer(), kind)
    ids = get("ids")
    return ids, get("labels"), get("vectors", np.float64).reshape(len(ids), dim), *(get(x) for x in extra)


def _positives(k: int) -> Callable:
    """The ``k`` best same-label rows of each anchor among the candidates of a task: (anchor_id, id, score)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[np.ndarray, _Lists]] = {}
        for batch in batches:
            for n in range(batch.num_rows):
                ids, labels, vectors = _read(batch, n, "")
                own, own_labels, own_vectors = _read(batch, n, "a_")
                _, lists = held.setdefault(batch["a_block"][n].as_py(), (own.copy(), _Lists(len(own), k)))
                for at in range(0, len(own), TILE):
                    tile = slice(at, at + TILE)
                    score = products(own_vectors[tile], vectors)
                    i, j = np.nonzero((score >= lists.floor[tile, None]) & (own_labels[tile, None] == labels) & (own[tile, None] != ids))
                    lists.add(i + at, ids[j], score[i, j])
                if sum(len(x.group) for _, x in held.values()) > HELD:
                    yield from out(held)
                    held.clear()
        yield from out(held)

    def out(held: dict) -> Iterator[pa.RecordBatch]:
        for own, x in held.values():
            yield pa.RecordBatch.from_arrays([pa.array(own[x.group]), pa.array(x.ids), pa.array(x.score)], names=["anchor_id", "id", "score"])

    return run


def _windows(scores: np.ndarray, least: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The whole scores s with least * p <= 100 * s <= most * p for each positive score p: first and last."""
    whole = scores.tolist()
    return np.array([-(-least * p // 100) for p in whole], np.int64), np.array([most * p // 100 for p in whole], np.int64)


def _negatives(k: int, least: int, most: int) -> Callable:
    """The ``k`` best different-label rows in the window of each anchor's positives: (anchor_id, positive_id, positive_score, id, score)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple] = {}
        for batch in batches:
            for n in range(batch.num_rows):
                ids, labels, vectors = _read(batch, n, "")
                own, own_labels, own_vectors, many, positive, reached = _read(batch, n, "a_", ("many", "positive_ids", "positive_scores"))
                first = np.concatenate([[0], np.cumsum(many)])  # an anchor's positives are groups first[i] up to first[i + 1]
                block = batch["a_block"][n].as_py()
                if block not in held:
                    held[block] = (np.repeat(own, many), positive.copy(), reached.copy(), _windows(reached, least, most), _Lists(len(positive), k))
                low, high = held[block][3]
                lists = held[block][4]
                for at in range(0, len(own), TILE):
                    score = products(own_vectors[at : at + TILE], vectors)
                    other = own_labels[at : at + TILE, None] != labels
                    for slot in range(int(many[at : at + TILE].max(initial=0))):
                        some = np.flatnonzero(many[at : at + TILE] > slot)
                        group = first[at + some] + slot
                        s = score[some]
                        i, j = np.nonzero((s >= np.maximum(low[group], lists.floor[group])[:, None]) & (s <= high[group][:, None]) & other[some])
                        lists.add(group[i], ids[j], s[i, j])
                if sum(len(x[4].group) for x in held.values()) > HELD:
                    yield from out(held)
                    held.clear()
        yield from out(held)

    def out(held: dict) -> Iterator[pa.RecordBatch]:
        for own, positive, reached, _, x in held.values():
            columns = [own[x.group], positive[x.group], reached[x.group], x.ids, x.score]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["anchor_id", "positive_id", "positive_score", "id", "score"])

    return run


def usable(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", scale: int = 256) -> DataFrame:
    """(id, label, dim, vector) of the rows that take part: components are floor(``scale`` * x), in double precision.

    Rows with a null id, label or vector, or with a null or non-finite component, take no part. Of rows that share
    an id the one with the smallest label, then vector, takes part; vectors are grouped for that only if an id is there twice.
    """
    whole = F.col("vector").isNotNull() & F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"), F.col(vector_col).cast("array<double>").alias("vector"))
    rows = rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & whole)
    if not rows.groupBy("id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty():
        rows = rows.groupBy("id").agg(F.min(F.struct("label", "vector")).alias("row")).select("id", "row.label", "row.vector")
    # rint of the exact floor: Spark's own floor would give longs
    scaled = F.transform("vector", lambda x: F.rint(x * float(scale)) - F.when(F.rint(x * float(scale)) > x * float(scale), 1.0).otherwise(0.0))
    return rows.select("id", "label", F.size("vector").alias("dim"), scaled.alias("vector"))


def hard_negatives(vectors: DataFrame, every: int = 50, positives: int = 5, k: int = 3, least: int = 50, most: int = 95, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", scale: int = 256) -> DataFrame:
    """For each anchor and each of its positives the ``k`` best different-label rows within a window of scores.

    Anchors are the rows whose id is divisible by ``every``. A row's score is its inner product with the anchor, over components
    floor(``scale`` * x); higher scores come first, ties by the smaller id. An anchor's positives are its first ``positives`` other rows
    of the same label, all if there are fewer. Negatives satisfy least * positive_score <= 100 * score <= most * positive_score. Returns
    anchor_id, positive_id, rank (from 1), negative_id, positive_score, negative_score. Rows that take part are those of
    ``usable``; vectors of another dimension than the anchor's score nothing with it; anchors without positives and
    positives without negatives have no rows; other columns are not read; an empty table gives an empty result. A score that
    no long can hold is an error.
    """
    home = shared_dir(vectors.sparkSession)
    rows = written(usable(vectors, id_col, vector_col, label_col, scale), f"{home}/rows")
    candidates = written(mapped(rows, _pack(False), _BLOCK), f"{home}/candidates")
    chosen = rows.where(F.col("id") % every == 0)
    anchors = written(mapped(chosen, _pack(False), _BLOCK), f"{home}/anchors")
    found = mapped(_meeting(candidates, anchors), _positives(positives), "anchor_id long, id long, score long")
    order = Window.partitionBy("anchor_id").orderBy(F.desc("score"), "id")
    kept = found.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= positives)
    lists = kept.groupBy("anchor_id").agg(F.array_sort(F.collect_list(F.struct("nth", "id", "score"))).alias("positives"))  # ``positives`` entries at most
    scored = chosen.join(lists, chosen.id == lists.anchor_id).select("id", "label", "dim", "vector", "positives")
    anchors = written(mapped(scored, _pack(True), _SCORED), f"{home}/scored")
    found = mapped(_meeting(candidates, anchors), _negatives(k, least, most), "anchor_id long, positive_id long, positive_score long, id long, score long")
    order = Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("score"), "id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
