"""Benchmark decontamination by greedy string tiling.

Texts become lower-case word tokens. A document and a test item that share a seed (``seed_words``
equal tokens in a row) are tiled: again and again the longest matches of tokens that no tile covers
are found by running Karp-Rabin at a shrinking search length and marked, so passages whose parts
were reordered count as well. The share of the item's tokens under tiles is its coverage.

Neither side is broadcast. Every seed of the benchmark sets a bit of a filter of at most ``block_bytes``,
and one pass over the documents keeps, of each, the runs of tokens whose seeds pass it (as 64-bit hashes
of the tokens). The seeds of those runs are joined with the benchmark's on the shuffle, each different text
once; a pair whose shared seeds could not cover enough of the item goes, the others are tiled. An item's most
common seeds that together cover too little of it are left out of that join: no pair needs them to be found.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from math import log2

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import apart, mapped, shared_dir, slices, text_bytes, written

_TOKEN = re.compile(r"\w+")
# A Mersenne prime and the base of the rolling hash.
PRIME, BASE = (1 << 61) - 1, 1_000_003
PIECE = 1 << 20


#: Lower-case ASCII letters, digits and the underscore stay, other ASCII is white space, longer UTF-8 stays.
_BYTES = bytes(x + 32 if 65 <= x <= 90 else x if x >= 128 or chr(x).isalnum() or x == 95 else 32 for x in range(256))
_NOT_LATIN = re.compile(r"[^\x00-\x7fªµºÀ-ÖØ-öø-įıĲ-ɏ]")


def tokens(raw: bytes) -> list[bytes]:
    """Lower-case runs of word characters of a UTF-8 text; Latin texts take a faster way to the same tokens."""
    if raw.isascii():
        return raw.translate(_BYTES).split()
    text = raw.decode()
    if _NOT_LATIN.search(text):
        return [x.encode() for x in _TOKEN.findall(text.lower())]
    return text.lower().encode().translate(_BYTES).split()


def windows(ids: list[int], free: list[bool], size: int) -> Iterator[tuple[int, int]]:
    """(hash, start) of every window of ``size`` free tokens, rolled from one to the next."""
    top = pow(BASE, size - 1, PRIME)
    value, run = 0, 0
    for k, x in enumerate(ids):
        if not free[k]:
            value = run = 0
            continue
        if run >= size:
            value = (value - (ids[k - size] + 1) * top) % PRIME
        value = (value * BASE + x + 1) % PRIME
        run += 1
        if run >= size:
            yield value, k - size + 1


def matches(item: list[int], item_free: list[bool], doc: list[int], doc_free: list[bool], size: int) -> list[tuple[int, int, int]]:
    """Maximal matches (length, item place, doc place) of at least ``size`` free tokens."""
    table: dict[int, list[int]] = {}
    for value, i in windows(item, item_free, size):
        table.setdefault(value, []).append(i)
    found: set[tuple[int, int, int]] = set()
    done: dict[int, int] = {}  # for each diagonal, where its last match ended
    for value, j in windows(doc, doc_free, size):
        for i in table.get(value, ()):
            if done.get(j - i, -1) > j or item[i : i + size] != doc[j : j + size]:
                continue
            n = size
            while i + n < len(item) and j + n < len(doc) and item[i + n] == doc[j + n] and item_free[i + n] and doc_free[j + n]:
                n += 1
            done[j - i] = j + n
            found.add((n, i, j))
    return sorted(found, key=lambda m: (-m[0], m[1], m[2]))


def tile(item: list[int], doc: list[int], least: int) -> list[tuple[int, int, int]]:
    """Tiles (item place, doc place, length) of at least ``least`` tokens, longest first."""
    item_free, doc_free, tiles = [True] * len(item), [True] * len(doc), []
    size = max(least, len(item) // 2)
    while True:
        found = matches(item, item_free, doc, doc_free, size)
        if found and found[0][0] > 2 * size:
            size = found[0][0]
            continue
        again = False
        for n, i, j in found:
            if all(item_free[i : i + n]) and all(doc_free[j : j + n]):
                item_free[i : i + n] = doc_free[j : j + n] = [False] * n
                tiles.append((i, j, n))
            else:
                again = True  # what is left of it may still be long
        if again:
            continue
        if size == least:
            return tiles
        size = max(least, size // 2)


def token_ids(words: list[bytes]) -> np.ndarray:
    """A 64-bit hash of each token."""
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def seed_values(ids: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit hash of every window of ``size`` tokens."""
    n = max(0, len(ids) - size + 1)
    value = np.full(n, size, np.uint64)
    for k in range(size):
        value = value * np.uint64(0x9E3779B97F4A7C15) + ids[k : n + k]
        value ^= value >> np.uint64(29)
    return value


def _pieces(raw: bytes) -> Iterator[bytes]:
    """Parts that end at white space, so that no token is cut."""
    at = 0
    while at < len(raw):
        end = at + PIECE
        while end < len(raw) and raw[end] not in b" \t\n\r":
            end += 1
        yield raw[at:end]
        at = end


def _ids_of(raw: bytes) -> np.ndarray:
    return token_ids(tokens(raw)) if len(raw) <= PIECE else np.concatenate([token_ids(tokens(x)) for x in _pieces(raw)])


def passing_runs(raw: bytes, bits: np.ndarray, sizes: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
    """(tokens, their places, distinct seeds) of the runs whose seeds pass the filter, a token 0 after each run; None if none does."""
    ids, seeds = _ids_of(raw), []
    mask = np.uint64(len(bits) * 8 - 1)
    change = np.zeros(len(ids) + 1, np.int32)
    for size in sizes:
        value = seed_values(ids, size)
        place = value & mask
        at = np.flatnonzero(bits[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8) & 1)
        if len(at):
            change += np.bincount(at, minlength=len(change))
            change -= np.bincount(at + size, minlength=len(change))
            seeds.append(value[at])
    if not seeds:
        return None
    inside = np.cumsum(change[:-1]) > 0
    inside = np.append(inside, False)
    last = inside.copy()
    last[1:] |= inside[:-1]  # and the place after each run, for its 0
    places = np.flatnonzero(last)
    kept = np.where(inside, np.append(ids, np.uint64(0)), np.uint64(0))[places]
    return kept, places, np.unique(np.concatenate(seeds))


def tile_runs(item: list[int], least: int, kept: list[int], places: list[int]) -> list[tuple[int, int, int]]:
    """Tiles (item place, document place, length) of an item in a document's runs."""
    names = {x: k + 1 for k, x in enumerate(dict.fromkeys(item))}
    own, at, run = [], [], []
    for x, place in zip([*kept, 0], [*places, -1], strict=True):
        known = names.get(x, 0)
        if known and (not run or place == run[-1][1] + 1):
            run.append((known, place))
            continue
        if len(run) >= least:  # a shorter run of the item's words holds no tile
            own += [*(k for k, _ in run), 0]
            at += [*(p for _, p in run), -1]
        run = [(known, place)] if known else []
    return [(i, at[j], n) for i, j, n in tile([names[x] for x in item], own, least)]


def text_key(text: Column) -> tuple[Column, Column]:
    """128 bits that stand for a text."""
    return F.xxhash64(text), F.xxhash64(F.lit(1), text)


def _benchmark(benchmark: DataFrame, item_col: str, item_text: str, seed_words: int, null_ids: bool, home: str) -> tuple[DataFrame, DataFrame]:
    """The items (key, item_id, least, ids) and their seeds (seed, key, cover): ``cover`` tokens at most are in windows of the seed."""
    rows = benchmark.where((F.lit(null_ids) | F.col(item_col).isNotNull()) & F.col(item_text).isNotNull())
    rows = rows.select(F.col(item_col).cast("long").alias("item_id"), F.col(item_text).cast("string").alias("text")).dropDuplicates(["item_id", "text"])

    def items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            ids = [_ids_of(raw).view(np.int64) if raw else np.empty(0, np.int64) for raw in text_bytes(batch.column(2))]
            least = [min(seed_words, len(x)) for x in ids]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(least, pa.int32()), pa.array(ids, pa.list_(pa.int64()))], names=["key", "item_id", "least", "ids"])

    made = mapped(rows.select(F.monotonically_increasing_id().alias("key"), "item_id", "text"), items, "key long, item_id long, least int, ids array<long>")
    made = written(made.where(F.col("least") > 0), f"{home}/items")

    def seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            for key, least, ids in zip(*(batch[c].to_pylist() for c in ("key", "least", "ids")), strict=True):
                seed, many = np.unique(seed_values(np.array(ids, np.int64).view(np.uint64), least), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(seed.view(np.int64)), pa.array(np.full(len(seed), key)), pa.array(many * least), pa.array(np.full(len(seed), least, np.int32))], names=["seed", "key", "cover", "size"])

    return made, written(mapped(made, seeds, "seed long, key long, cover long, size int"), f"{home}/seeds")


def _filter(seeds: DataFrame, most_bytes: int) -> tuple[np.ndarray, list[int]]:
    """A bit for each seed, about 256 bits a seed up to ``most_bytes`` (4 KiB at least); and the seeds' sizes."""
    shape = seeds.agg(F.count(F.lit(1)).alias("n"), F.collect_set("size").alias("sizes")).first()  # sizes: at most seed_words
    power = max(15, min(int(log2(256 * max(shape.n, 1))) + 1, int(log2(max(1, 8 * most_bytes)))))
    place = F.col("seed").bitwiseAND((1 << power) - 1)
    parts = seeds.groupBy(F.shiftright(place, 15).alias("part")).agg(F.bitmap_construct_agg(place.bitwiseAND(32767)).alias("bits")).collect()  # most_bytes in all
    bits = np.zeros(1 << power - 3, np.uint8)
    for r in parts:
        bits[r.part << 12 : (r.part + 1) << 12] = np.frombuffer(bytes(r.bits), np.uint8)
    return bits, sorted(shape.sizes)


def telling_seeds(item: np.ndarray, least: int, seeds: np.ndarray, texts: np.ndarray, share: float) -> tuple[np.ndarray, int]:
    """The places in ``seeds`` (those of the item that some text has, with the numbers of such texts) of the seeds
    without which no text reaches ``share`` of the item, and how many tokens the others, the commonest, cover."""
    order = np.lexsort((seeds, -texts))
    by_value = np.argsort(seeds)
    rank = np.empty(len(seeds) + 1, np.int64)
    rank[order], rank[-1] = np.arange(len(seeds)), len(seeds)  # the last: in no text
    value = seed_values(item, least)
    at = np.minimum(np.searchsorted(seeds, value, sorter=by_value), len(seeds) - 1)
    window = rank[np.where(seeds[by_value[at]] == value, by_value[at], len(seeds))]
    first = np.full(len(item), len(seeds))  # of the seeds over a token, the commonest
    for k in range(least):
        np.minimum(first[k : k + len(window)], window, out=first[k : k + len(window)])
    covered = np.cumsum(np.bincount(first, minlength=len(seeds) + 1))[:-1]
    aside = int(np.searchsorted(covered, len(item) * share - 1e-6))
    return order[aside:], int(covered[aside - 1]) if aside else 0


def _candidates(texts: DataFrame, seeds: DataFrame, items: DataFrame, least_coverage: float) -> DataFrame:
    """The pairs (h1, h2, key) of texts and items whose shared seeds may cover ``least_coverage`` of the item.

    Of an item's seeds, from the one that most texts have, those are set aside which together cover less than
    that: a text that shares only these can't reach it. So a phrase that very many texts and items share makes no
    pairs, unless it is enough of an item by itself.
    """
    each = texts.select("h1", "h2", F.explode("seeds").alias("seed"))
    common = each.groupBy("seed").agg(F.count(F.lit(1)).alias("n"))
    known = seeds.join(common, "seed").groupBy("key").agg(F.collect_list(F.struct("seed", "n", "cover")).alias("known"))  # the seeds of one item

    def telling(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            for key, least, ids, known in zip(*(batch[c].to_pylist() for c in ("key", "least", "ids", "known")), strict=True):
                seed, texts, cover = (np.array([x[c] for x in known], np.int64) for c in ("seed", "n", "cover"))
                kept, aside = telling_seeds(np.array(ids, np.int64).view(np.uint64), least, seed.view(np.uint64), texts, least_coverage)
                needed = np.full(len(kept), len(ids) * least_coverage - 1e-6 - aside)
                yield pa.RecordBatch.from_arrays([pa.array(seed[kept]), pa.array(np.full(len(kept), key)), pa.array(cover[kept]), pa.array(needed)], names=["seed", "key", "cover", "needed"])

    wanted = mapped(known.join(items, "key").select("key", "least", "ids", "known"), telling, "seed long, key long, cover long, needed double")
    pairs = each.join(wanted, "seed").groupBy("h1", "h2", "key").agg(F.sum("cover").alias("cover"), F.any_value("needed").alias("needed"))
    return pairs.where(F.col("cover") >= F.col("needed")).select("h1", "h2", "key")


def most_covered(item: np.ndarray, kept: np.ndarray, least: int) -> int:
    """How many tokens of the item lie in windows of ``least`` that the runs have too: tiles cover no others."""
    at = np.flatnonzero(np.isin(seed_values(item, least), seed_values(kept, least)))
    change = np.bincount(at, minlength=len(item) + 1) - np.bincount(at + least, minlength=len(item) + 1)
    return int(np.count_nonzero(np.cumsum(change) > 0))


_TILES = "array<struct<item_at:int,doc_at:long,length:int>>"


def _tiled(docs: DataFrame, benchmark: DataFrame, id_col: str | None, text_col: str, item_col: str, item_text: str, seed_words: int, block_bytes: int, least_coverage: float, null_ids: bool) -> tuple[DataFrame, DataFrame]:
    """Coverage of items by texts (h1, h2, item_id, coverage, covered, longest, tiles), and the rows (doc_id, h1, h2) of texts with passing runs."""
    home = shared_dir(docs.sparkSession)
    items, seeds = _benchmark(benchmark, item_col, item_text, seed_words, null_ids, home)
    bits, sizes = _filter(seeds, block_bytes)
    shared = docs.sparkSession.sparkContext.broadcast(bits)  # at most block_bytes

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in slices(batches):
            found = [passing_runs(raw, own, sizes) if raw else None for raw in text_bytes(batch.column(3))]
            some = [x for x in found if x is not None]
            if some:
                part = batch.filter(pa.array([x is not None for x in found], pa.bool_()))
                lists = [pa.array([x[k].view(np.int64) for x in some], pa.list_(pa.int64())) for k in range(3)]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), part.column(2), *lists], names=["doc_id", "h1", "h2", "ids", "places", "seeds"])

    text = F.col(text_col).cast("string")
    key = F.col(id_col).cast("long") if id_col else F.lit(None).cast("long")
    h1, h2 = text_key(text)
    source = docs.where(text.isNotNull()).select(key.alias("doc_id"), h1.alias("h1"), h2.alias("h2"), text.alias("text"))
    rows = written(mapped(source, runs, "doc_id long, h1 long, h2 long, ids array<long>, places array<long>, seeds array<long>"), f"{home}/rows")
    texts = written(rows.drop("doc_id").dropDuplicates(["h1", "h2"]), f"{home}/texts")
    pairs = written(_candidates(texts, seeds, items, least_coverage), f"{home}/pairs")

    def tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.int32(), pa.int32(), pa.list_(pa.struct([("item_at", pa.int32()), ("doc_at", pa.int64()), ("length", pa.int32())])))
        names = ("h1", "h2", "item_id", "coverage", "covered", "longest", "tiles")
        for batch in slices(batches):
            columns: tuple[list, ...] = tuple([] for _ in names)
            for h1, h2, item_id, least, item, kept, places in zip(*(batch[c].to_pylist() for c in ("h1", "h2", "item_id", "least", "item", "ids", "places")), strict=True):
                most = most_covered(np.array(item, np.int64).view(np.uint64), np.array(kept, np.int64).view(np.uint64), least)
                if most < len(item) * least_coverage - 1e-6:
                    continue
                found = tile_runs(item, least, kept, places)
                covered = sum(n for _, _, n in found)
                row = (h1, h2, item_id, covered / len(item), covered, max((n for _, _, n in found), default=0), [{"item_at": i, "doc_at": j, "length": n} for i, j, n in found])
                for column, x in zip(columns, row, strict=True):
                    column.append(x)
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(columns, kinds, strict=True)], names=list(names))

    both = pairs.join(texts.drop("seeds"), ["h1", "h2"]).join(items.select("key", "item_id", "least", F.col("ids").alias("item")), "key")
    made = mapped(both.select("h1", "h2", "item_id", "least", "item", "ids", "places"), tiles, f"h1 long, h2 long, item_id long, coverage double, covered int, longest int, tiles {_TILES}")
    return written(made, f"{home}/tiled"), rows.select("doc_id", "h1", "h2")


def overlaps(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", seed_words: int = 5, block_bytes: int = 32 << 20, least_coverage: float = 0.0) -> DataFrame:
    """Every document's coverage of every test item with which it shares a seed, if it may reach ``least_coverage``.

    Returns doc_id, item_id, coverage (0 to 1), covered, longest, tiles array<struct<item_at, doc_at,
    length>> (in tokens). Items under ``seed_words`` tokens must match whole. Null texts, texts without
    a token and null items or ids of items match nothing; rows with a null id keep their matches; repeated
    rows of documents repeat, repeated items (id and text) count once, and texts that share an id have a row each; empty tables give an empty result.
    """
    tiled, rows = _tiled(docs, benchmark, id_col, text_col, item_col, item_text, seed_words, block_bytes, least_coverage, False)
    return rows.join(tiled, ["h1", "h2"]).select("doc_id", "item_id", "coverage", "covered", "longest", "tiles")


def contaminated(docs: DataFrame, benchmark: DataFrame, threshold: float = 0.6, **columns) -> DataFrame:
    """The pairs whose coverage is ``threshold`` or more; as for ``overlaps``."""
    return overlaps(docs, benchmark, least_coverage=threshold, **columns).where(F.col("coverage") >= threshold)


def without_leaks(docs: DataFrame, benchmark: DataFrame, threshold: float = 0.6, text_col: str = "text", item_col: str = "item_id", item_text: str = "text", seed_words: int = 5, block_bytes: int = 32 << 20) -> DataFrame:
    """The rows and columns of ``docs`` that cover no test item by ``threshold`` or more, test items without an id
    included; nulls and empty texts stay.

    Leaking texts are few rows of two numbers; documents are anti-joined with them by the same numbers.
    """
    names, docs = docs.columns, apart(docs, text=text_col)
    text_col = "text"
    tiled, _ = _tiled(docs, benchmark, None, text_col, item_col, item_text, seed_words, block_bytes, threshold, True)
    leaks = tiled.where(F.col("coverage") >= threshold).select(F.col("h1").alias("__h1"), F.col("h2").alias("__h2")).distinct()
    leaks = written(leaks, f"{shared_dir(docs.sparkSession)}/leaks")
    h1, h2 = text_key(docs[text_col].cast("string"))
    return docs.join(leaks, (h1 == F.col("__h1")) & (h2 == F.col("__h2")), "left_anti").toDF(*names)
