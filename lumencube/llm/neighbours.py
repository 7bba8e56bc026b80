"""Nearest neighbours by largest inner product over randomly rotated one-bit codes.

Index: a vector less the centroid is scaled to length 1, padded with zeros to at least ``BITS``
dimensions and rotated by a random orthogonal matrix; its code is the packed signs. Padding makes codes
longer and their errors smaller by the root of it. Two scalars correct a code: the length, and the inner
product of the unit vector with its own code.

Search: a query is rotated alike and quantized to ``LEVELS`` bits a coordinate, kept as bit planes, so
that its inner product with a code is a weighted sum of population counts of packed words. This
estimates every inner product without bias, with a bound on the error (``epsilon`` deviations).
1. Over the codes of a bounded sample of rows the best estimates of each query are found and their
   vectors fetched; the k-th best exact score is a bound that the answer's k-th can't be under.
2. Over the codes of all rows, those whose upper bound reaches it survive, with the queries they survive for.
3. Survivors' vectors are fetched by row number and scored exactly; the k best are the answer.
The scans read no vectors.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import mapped, shared_dir, slices, written

ROWS = 2048
TILE = 64
SEED = 20
BITS = 512
LEVELS = 4


def code_bits(dim: int) -> int:
    """Bits of the codes of ``dim`` dimensions."""
    return -(-max(dim, BITS) // 64) * 64


@cache
def rotation(dim: int, seed: int = SEED, bits: int = 0) -> np.ndarray:
    """The first ``dim`` rows of a random orthogonal matrix of ``bits`` (or ``dim``) columns; made once for each worker."""
    bits = bits or dim
    q, r = np.linalg.qr(np.random.default_rng([seed, dim]).standard_normal((bits, dim)))
    return (q * np.sign(np.diag(r))).T


def encode(vectors: np.ndarray, centroid: np.ndarray, seed: int = SEED, bits: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(packed signs, lengths, inner products of unit vectors and their codes) of the rows."""
    dim = vectors.shape[1]
    bits = bits or dim
    rest = vectors - centroid
    length = np.linalg.norm(rest, axis=1)
    unit = (rest / np.where(length > 0, length, 1.0)[:, None]) @ rotation(dim, seed, bits)
    own = np.abs(unit).sum(axis=1) / np.sqrt(bits)
    return np.packbits(unit > 0, axis=1, bitorder="little"), length, np.where(length > 0, own, 1.0)


def _words(packed: np.ndarray) -> np.ndarray:
    """Packed bytes as 64-bit words, padded with zeros."""
    n, size = packed.shape
    whole = np.zeros((n, -(-size // 8) * 8), np.uint8)
    whole[:, :size] = packed
    return whole.view("<u8")


@dataclass(frozen=True)
class Quantized:
    """Rotated queries, each coordinate ``low + step * u`` with u of LEVELS bits."""

    planes: np.ndarray  # bit j of u, packed: (LEVELS, words, queries)
    low: np.ndarray
    step: np.ndarray
    total: np.ndarray  # of the quantized coordinates
    lost: np.ndarray  # length of what quantizing took

    @classmethod
    def of(cls, rotated: np.ndarray) -> Quantized:
        low, high, top = rotated.min(axis=1), rotated.max(axis=1), (1 << LEVELS) - 1
        step = np.where(high > low, (high - low) / top, 1.0)
        u = np.rint((rotated - low[:, None]) / step[:, None]).astype(np.uint8)
        near = low[:, None] + step[:, None] * u
        planes = np.stack([_words(np.packbits(u >> j & 1, axis=1, bitorder="little")).T for j in range(LEVELS)])
        return cls(np.ascontiguousarray(planes), low, step, near.sum(axis=1), np.linalg.norm(rotated - near, axis=1))


def _counts(words: np.ndarray, planes: np.ndarray) -> np.ndarray:
    """Sum over set bits of each code of the queries' u, by population counts: (codes x queries)."""
    out = np.zeros((len(words), planes.shape[2]), np.float32)
    for at in range(0, len(words), TILE):
        tile = words[at : at + TILE]
        both = np.empty((len(tile), planes.shape[2]), np.uint64)
        some = np.empty(both.shape, np.uint8)
        for j, plane in enumerate(planes):
            total = np.zeros(both.shape, np.uint16)
            for w, row in enumerate(plane):
                np.bitwise_and(tile[:, w, None], row[None, :], out=both)
                np.bitwise_count(both, out=some)
                total += some
            out[at : at + TILE] += total * np.float32(1 << j)
    return out


def estimates(codes: np.ndarray, length: np.ndarray, own: np.ndarray, bits: int, rotated: np.ndarray | Quantized, size: np.ndarray, epsilon: float) -> tuple[np.ndarray, np.ndarray]:
    """Estimated inner products (vectors x queries) of the centred vectors with the queries, and their error bounds."""
    q = rotated if isinstance(rotated, Quantized) else Quantized.of(rotated)
    words = _words(codes)
    ones = np.bitwise_count(words).sum(axis=1, dtype=np.int64).astype(np.float32)
    scale = (length / own / np.sqrt(bits)).astype(np.float32)
    got = _counts(words, q.planes)
    got *= 2 * q.step.astype(np.float32)
    got += ones[:, None] * (2 * q.low).astype(np.float32)
    got -= q.total.astype(np.float32)
    got *= scale[:, None]
    spread = length * np.sqrt(np.maximum(1 - own**2, 0)) / own * (epsilon / np.sqrt(max(bits - 1, 1)))
    error = spread.astype(np.float32)[:, None] * size.astype(np.float32)
    error += scale[:, None] * (epsilon * q.lost).astype(np.float32)
    return got, error


def _usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    v = F.col(vector_col).cast("array<double>")
    good = F.forall(v, lambda x: x.isNotNull() & (F.abs(x) < float("inf")) & ~F.isnan(x)) & F.exists(v, lambda x: x != 0)
    return vectors.where(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull() & good).select(F.col(id_col).cast("long").alias("vec_id"), v.alias("vector"))


@dataclass(frozen=True)
class Index:
    """The rows (row, vec_id, vector, dim, code, length, own) and what their codes were made with; ``row`` numbers them."""

    rows: DataFrame
    centroids: dict[int, np.ndarray]
    seed: int

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Index:
        made = spark.read.parquet(f"{path}/centroids").collect()  # a row for each dimension
        seed = next((r.seed for r in made), SEED)
        return cls(spark.read.parquet(f"{path}/rows"), {r.dim: np.array(r.centroid) for r in made}, seed)


def build(vectors: DataFrame, path: str, id_col: str = "vec_id", vector_col: str = "embedding", sample_rows: int = 4096, seed: int = SEED) -> Index:
    """Write the index of every usable vector to ``path`` and return it.

    Vectors that are null or zero, or hold null or non-finite components, and rows with a null id take
    no part. The centroid of each dimension is the mean of at most ``sample_rows`` vectors in order of
    a hash of their ids; it only centres the codes, every vector is indexed.
    """
    rows = _usable(vectors, id_col, vector_col)
    some = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample_rows).select("vector").collect()  # bounded by sample_rows
    by: dict[int, list] = {}
    for r in some:
        by.setdefault(len(r.vector), []).append(r.vector)
    centroids = {dim: np.mean(x, axis=0) for dim, x in by.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        row = TaskContext.get().partitionId() << 40
        for batch in slices(batches, 4 << 20):
            lists = batch.column(1)
            sizes = np.diff(lists.offsets.to_numpy())
            flat = lists.flatten().to_numpy()
            starts = np.cumsum(sizes) - sizes
            n = len(sizes)
            code, length, own = [b""] * n, np.zeros(n), np.ones(n)
            for dim in np.unique(sizes).tolist():
                at = np.flatnonzero(sizes == dim)
                c = centroids.get(dim, np.zeros(dim))
                x = flat[starts[at][:, None] + np.arange(dim)]
                packed, length[at], own[at] = encode(x, c, seed, code_bits(dim))
                for i, p in zip(at.tolist(), packed, strict=True):
                    code[i] = p.tobytes()
            columns = [pa.array(np.arange(row, row + n)), batch.column(0), lists, pa.array(sizes.astype(np.int32)), pa.array(code, pa.binary()), pa.array(length), pa.array(own)]
            yield pa.RecordBatch.from_arrays(columns, names=["row", "vec_id", "vector", "dim", "code", "length", "own"])
            row += n

    made = written(mapped(rows, run, "row long, vec_id long, vector array<double>, dim int, code binary, length double, own double"), f"{path}/rows")
    table = [(dim, [float(x) for x in c], seed) for dim, c in centroids.items()]
    written(vectors.sparkSession.createDataFrame(table, "dim int, centroid array<double>, seed long"), f"{path}/centroids")
    return Index(made, centroids, seed)


def _best(query: np.ndarray, vec: np.ndarray, score: np.ndarray, k: int, once: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k best rows of each query: largest score, then smallest id; repeated rows of one id, or with ``once`` all of an id, are one."""
    if once:
        order = np.lexsort((-score, vec, query))
        query, vec, score = query[order], vec[order], score[order]
        new = np.ones(len(query), bool)
        new[1:] = (query[1:] != query[:-1]) | (vec[1:] != vec[:-1])
        query, vec, score = query[new], vec[new], score[new]
    order = np.lexsort((vec, -score, query))
    query, vec, score = query[order], vec[order], score[order]
    same = np.zeros(len(query), bool)
    same[1:] = (query[1:] == query[:-1]) & (vec[1:] == vec[:-1]) & (score[1:] == score[:-1])
    query, vec, score = query[~same], vec[~same], score[~same]
    starts = np.flatnonzero(np.concatenate([[True], query[1:] != query[:-1]])) if len(query) else np.empty(0, int)
    rank = np.arange(len(query)) - np.repeat(starts, np.diff(np.append(starts, len(query))))
    keep = rank < k
    return query[keep], vec[keep], score[keep]


@dataclass(frozen=True)
class _Block:
    """One block of queries of one dimension, as the scans need it."""

    ids: np.ndarray
    vectors: np.ndarray
    codes: Quantized
    size: np.ndarray
    base: np.ndarray  # inner products with the centroid

    @classmethod
    def of(cls, ids: np.ndarray, vectors: np.ndarray, centroid: np.ndarray, seed: int) -> _Block:
        dim = vectors.shape[1]
        return cls(ids, vectors, Quantized.of(vectors @ rotation(dim, seed, code_bits(dim))), np.linalg.norm(vectors, axis=1), vectors @ centroid)

    def bounds(self, part: pa.RecordBatch, dim: int, epsilon: float) -> tuple[np.ndarray, np.ndarray]:
        """Estimates and upper bounds of the inner products (rows x queries), from codes alone."""
        code = np.frombuffer(b"".join(part["code"].to_pylist()), np.uint8).reshape(part.num_rows, -1)
        length = part["length"].to_numpy()
        got, error = estimates(code, length, part["own"].to_numpy(), code_bits(dim), self.codes, self.size, epsilon)
        got += self.base.astype(np.float32)
        error += (1e-5 * (np.abs(self.base) + self.size * (1 + length.max()))).astype(np.float32)  # of single precision
        error += got
        return got, error


def _parts(batches: Iterator[pa.RecordBatch], blocks: dict[int, _Block], rows: int = ROWS) -> Iterator[tuple[int, _Block, pa.RecordBatch]]:
    """The rows by dimension, where queries have it, a few at a time."""
    for whole in batches:
        for at in range(0, whole.num_rows, rows):
            batch = whole.slice(at, rows)
            dims = batch["dim"].to_numpy()
            for dim in np.unique(dims).tolist():
                if dim in blocks:
                    yield dim, blocks[dim], batch.filter(pa.array(dims == dim))


def _prober(blocks: dict[int, _Block], k: int, epsilon: float):
    """For each query the rows of the ``k`` best estimates of other ids in the task's part: (query_id, row)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = np.empty(0, np.int64)
        kept = {dim: (none, none, np.empty(0)) for dim in blocks}
        rows = {dim: {} for dim in blocks}
        for dim, block, part in _parts(batches, blocks):
            vec, row = part["vec_id"].to_numpy(), part["row"].to_numpy()
            got, _ = block.bounds(part, dim, epsilon)
            most = min(len(vec), 2 * k + 1)
            top = np.argpartition(-got, most - 1, axis=0)[:most]
            j = np.broadcast_to(np.arange(len(block.ids)), top.shape).ravel()
            i = top.ravel()
            own = vec[i] != block.ids[j]
            i, j = i[own], j[own]
            query, ids, score = kept[dim]
            kept[dim] = _best(np.concatenate([query, j]), np.concatenate([ids, vec[i]]), np.concatenate([score, got[i, j].astype(np.float64)]), k, once=True)
            rows[dim].update(zip(vec.tolist(), row.tolist(), strict=True))
            rows[dim] = {v: rows[dim][v] for v in np.unique(kept[dim][1]).tolist()}
        for dim, (query, ids, score) in kept.items():
            if len(query):
                row = np.array([rows[dim][v] for v in ids.tolist()], np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(blocks[dim].ids[query]), pa.array(row), pa.array(score)], names=["query_id", "row", "estimate"])

    return run


def _sieve(blocks: dict[int, _Block], least: dict[int, np.ndarray], epsilon: float):
    """The rows whose upper bound reaches some query's ``least``: (row, places of those queries in their block)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for dim, block, part in _parts(batches, blocks):
            _, upper = block.bounds(part, dim, epsilon)
            i, j = np.nonzero(upper >= least[dim])
            own = part["vec_id"].to_numpy()[i] != block.ids[j]
            i, j = i[own], j[own].astype(np.int32)
            if len(i):
                left, many = np.unique(i, return_counts=True)
                lists = pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(many)]).astype(np.int32), pa.array(j))
                yield pa.RecordBatch.from_arrays([pa.array(part["row"].to_numpy()[left]), lists], names=["row", "queries"])

    return run


def _scorer(blocks: dict[int, _Block], least: dict[int, np.ndarray], k: int):
    """Exact scores of (vec_id, vector, dim, queries): the ``k`` best of the task for each query."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = np.empty(0, np.int64)
        kept = {dim: (none, none, np.empty(0)) for dim in blocks}
        for dim, block, part in _parts(batches, blocks, 256):
            vec, x = part["vec_id"].to_numpy(), part["vector"].flatten().to_numpy().reshape(-1, dim)
            lists = part["queries"]
            j = lists.flatten().to_numpy()
            i = np.repeat(np.arange(len(vec)), np.diff(lists.offsets.to_numpy()))
            score = np.concatenate([np.einsum("nd,nd->n", x[i[s : s + 65536]], block.vectors[j[s : s + 65536]]) for s in range(0, len(i), 65536)] or [np.empty(0)])
            slack = 1e-13 * dim * np.linalg.norm(x, axis=1)[i] * block.size[j]  # the bound's sum may be rounded otherwise
            near = score >= least[dim][j] - slack
            query, ids, best = kept[dim]
            kept[dim] = _best(np.concatenate([query, j[near]]), np.concatenate([ids, vec[i[near]]]), np.concatenate([best, score[near]]), k)
        for dim, (query, ids, score) in kept.items():
            if len(query):
                yield pa.RecordBatch.from_arrays([pa.array(blocks[dim].ids[query]), pa.array(ids), pa.array(score)], names=["query_id", "vec_id", "score"])

    return run


CODES = ("row", "vec_id", "dim", "code", "length", "own")


def search(index: Index, queries: DataFrame, k: int = 20, epsilon: float = 3.0, block_bytes: int = 4 << 20, block_rows: int = 4096, probe_rows: int = 1 << 14) -> DataFrame:
    """The ``k`` vectors of ``index`` with the largest inner product with each query, other than the query's own id.

    ``queries`` has the columns vec_id and vector of the index's rows; of two vectors with one id the
    smaller is the query. Blocks of queries go to the tasks one by
    one: a block has at most about ``block_rows`` queries and ``block_bytes`` bytes, however many there are.
    ``probe_rows`` is how many rows about, by a hash of their number, set the first bounds; all rows are
    searched. Vectors of another dimension than the query's are no candidates; repeated rows of one id and vector are one.
    Returns query_id, rank (from 1; ties to the smaller id), vec_id, score (double precision, on the
    original vectors). Queries without candidates have no rows.
    """
    home = shared_dir(index.rows.sparkSession)
    queries = written(queries.groupBy("vec_id").agg(F.min("vector").alias("vector")), f"{home}/queries")
    shape = queries.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("vector")).alias("dim")).first()
    rows = max(1, min(block_rows, block_bytes // (8 * max(shape.dim or 1, 1))))
    blocks = max(1, -(-shape.n // rows))
    share = min(1.0, probe_rows / max(1, index.rows.count()))
    codes = index.rows.select(*CODES)
    probe = codes.where(F.xxhash64("row").bitwiseAND(0x7FFFFFFF) / F.lit(2.0**31) < share)
    found = []
    for b in range(blocks):
        some = queries.where(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == b).collect()
        by: dict[int, tuple[list, list]] = {}
        for r in some:
            ids, vectors = by.setdefault(len(r.vector), ([], []))
            ids.append(r.vec_id)
            vectors.append(r.vector)
        held = {dim: _Block.of(np.array(ids, np.int64), np.array(v, np.float64), index.centroids.get(dim, np.zeros(dim)), index.seed) for dim, (ids, v) in by.items()}
        guesses = mapped(probe, _prober(held, k, epsilon), "query_id long, row long, estimate double")
        first = Window.partitionBy("query_id").orderBy(F.desc("estimate"), "row")
        guesses = guesses.withColumn("nth", F.row_number().over(first)).where(F.col("nth") <= 2 * k)
        scored = guesses.join(index.rows.select("row", "vec_id", "dim", "vector"), "row").groupBy("row").agg(F.first("vec_id").alias("vec_id"), F.first("dim").alias("dim"), F.first("vector").alias("vector"), F.collect_list("query_id").alias("ids"))
        bounds = _first_bounds(scored, held, k)
        left = mapped(codes, _sieve(held, bounds, epsilon), "row long, queries array<int>")
        fetched = left.join(index.rows.select("row", "vec_id", "dim", "vector"), "row").select("vec_id", "vector", "dim", "queries")
        found.append(mapped(fetched, _scorer(held, bounds, k), "query_id long, vec_id long, score double"))
    out = reduce(DataFrame.unionByName, found)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    best = out.dropDuplicates(["query_id", "vec_id", "score"]).withColumn("rank", F.row_number().over(order))
    return best.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _first_bounds(scored: DataFrame, blocks: dict[int, _Block], k: int) -> dict[int, np.ndarray]:
    """For each query of the block the k-th best exact score of distinct ids in ``scored``, or no bound if there are fewer."""
    places = {dim: {q: n for n, q in enumerate(block.ids.tolist())} for dim, block in blocks.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for vec, dim, vector, ids in zip(*(batch[c].to_pylist() for c in ("vec_id", "dim", "vector", "ids")), strict=True):
                at = [places[dim][q] for q in ids]
                score = np.einsum("qd,d->q", blocks[dim].vectors[at], np.array(vector))
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array([vec] * len(ids), pa.int64()), pa.array(score)], names=["query_id", "vec_id", "score"])

    each = mapped(scored, run, "query_id long, vec_id long, score double").groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"))
    kth = {r.query_id: r.score for r in each.withColumn("nth", F.row_number().over(order)).where(F.col("nth") == k).collect()}  # a row for each query of the block
    return {dim: np.array([kth.get(q, -np.inf) for q in block.ids.tolist()]) for dim, block in blocks.items()}


def nearest(vectors: DataFrame, every: int = 20, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding", epsilon: float = 3.0) -> DataFrame:
    """Index ``vectors`` and search it with every row whose id is divisible by ``every``."""
    index = build(vectors, f"{shared_dir(vectors.sparkSession)}/index", id_col, vector_col)
    return search(index, index.rows.where(F.col("vec_id") % every == 0).select("vec_id", "vector"), k, epsilon)
