"""Line dedup over levelled sorted runs of line hashes; DataFrame functions only.

A run is a table of (h1, h2, docs, last, fresh): the 128-bit hash of a line key, in how many documents
of its batches the key is, the largest id among them, and whether no earlier run has the key. Runs
are bucketed and sorted by hash, all into the same buckets, so merging them needs no exchange. Every
batch of documents is hashed into those buckets once and merge-anti-joined with each run; what no run
has is fresh. Its own run, of fresh keys and the counts of known ones, becomes one of level 0. When a
level has ``fanout`` runs, they are merged, bucket by bucket, into one run of the next level, so there
are at most fanout - 1 runs a level and levels grow with the logarithm of the batches.

Batches come in descending order of ids: the batch where a key is fresh has its largest document, the
one that keeps the line, and known keys only add to the count. All rows of a document are in one batch.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import apart, shared_dir, written

SPACE = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def line_key(line: Column) -> Column:
    """The line without white space (space, 0x09-0x0D) at its ends, A-Z lower-cased and no other letter."""
    bare = F.btrim(line, F.lit(SPACE))
    ascii_only = F.octet_length(bare) == F.char_length(bare)
    return F.when(ascii_only, F.lower(bare)).otherwise(F.translate(bare, UPPER, LOWER))


def _hash(key: Column) -> Column:
    """128 bits: XXH64 of the key and of the key after a number."""
    return F.struct(F.xxhash64(key).alias("h1"), F.xxhash64(F.lit(1), key).alias("h2"))


def lines_of(text: Column) -> Column:
    """The text cut at line feeds; null and empty texts are one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_hashes(docs: DataFrame, min_chars: int, id_col: str, text_col: str) -> DataFrame:
    """(doc, h1, h2): the distinct keys of ``min_chars`` code points or more in each row of ``docs``."""
    long_lines = F.filter(lines_of(F.col(text_col).cast("string")), lambda x: F.char_length(x) >= min_chars)
    keys = F.array_distinct(F.filter(F.transform(long_lines, line_key), lambda k: F.char_length(k) >= min_chars))  # of strings: by hashing
    rows = docs.select(F.col(id_col).cast("long").alias("doc"), F.explode(F.transform(keys, _hash)).alias("h"))
    return rows.select("doc", "h.h1", "h.h2")


@dataclass
class LineRuns:
    """The levelled runs. ``add`` takes batches of (doc, h1, h2); a doc must not come in two batches.

    Buckets are as many as the session's shuffle partitions when the runs begin.
    """

    spark: SparkSession
    fanout: int = 3
    levels: list[list[DataFrame]] = field(default_factory=list)
    home: str = ""
    made: int = 0
    buckets: int = 0

    def __post_init__(self):
        self.home = self.home or f"{shared_dir(self.spark)}/runs"
        self.buckets = self.buckets or int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        self.spark.conf.set("spark.sql.legacy.bucketedTableScan.outputOrdering", "true")  # one file a bucket: read as sorted

    def _store(self, run: DataFrame) -> DataFrame:
        self.made += 1
        name = f"line_run_{uuid.uuid4().hex}"
        run.write.bucketBy(self.buckets, "h1", "h2").sortBy("h1", "h2").option("path", f"{self.home}/{self.made}").saveAsTable(name)
        out = self.spark.table(name)
        self.spark.sql(f"DROP TABLE {name}")  # the files stay, and the frame knows them
        return out

    def runs(self) -> list[DataFrame]:
        return [r for level in self.levels for r in level]

    def rows(self) -> DataFrame | None:
        """All runs' rows; a hash may be in several runs, and is fresh in one."""
        return _union(self.runs()) if self.runs() else None

    def add(self, batch: DataFrame) -> DataFrame:
        """Merge-anti-join a batch with the runs and add its own run, which is returned.

        ``fresh`` marks the keys that no earlier run has; exactly one run holds each key as fresh, so a
        join's other side has every key once. Known keys add to the counts.
        """
        run = batch.dropDuplicates(["h1", "h2", "doc"]).groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("docs"), F.max("doc").alias("last"))
        known = F.lit(False)
        for k, earlier in enumerate(self.runs()):
            seen = earlier.where("fresh").select("h1", "h2", F.lit(True).alias(f"in{k}"))
            run = run.join(seen.hint("merge"), ["h1", "h2"], "left")
            known = known | F.col(f"in{k}").isNotNull()
        run = self._store(run.select("h1", "h2", "docs", "last", (~known).alias("fresh")))
        self._push(run, 0)
        return run

    def _push(self, run: DataFrame, level: int) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) >= self.fanout:
            merged = _union(self.levels[level])
            self.levels[level] = []
            self._push(self._store(_summed(merged)), level + 1)

    def counts(self) -> DataFrame:
        """(h1, h2, docs, last, fresh) over all batches."""
        return _summed(self.rows())

    def survivors(self, min_docs: int) -> DataFrame:
        """(h1, h2, last): the keys in ``min_docs`` documents or more, and the largest document of the batch where each was fresh."""
        only = F.min(F.when(F.col("fresh"), F.col("last")))  # one row of a key is fresh
        return self.rows().groupBy("h1", "h2").agg(F.sum("docs").alias("docs"), only.alias("last")).where(F.col("docs") >= min_docs).select("h1", "h2", "last")


def _union(runs: list[DataFrame]) -> DataFrame:
    """The runs' rows, bucket by bucket.

    Spark 4.1 puts a union of column batches together by file though it reports the buckets kept, and
    then sums a key in parts; the filter, which all rows pass, makes it a union of rows, where buckets are kept.
    """
    return reduce(DataFrame.unionByName, [r.where(F.col("docs") > 0) for r in runs])


def _summed(rows: DataFrame) -> DataFrame:
    return rows.groupBy("h1", "h2").agg(F.sum("docs").alias("docs"), F.max("last").alias("last"), F.bool_or("fresh").alias("fresh"))


def _batch(doc: Column, bounds: list[int]) -> Column:
    """The batch of an id: 0 has the largest ids, down to the last of ``bounds``, which are ascending."""
    return reduce(lambda a, b: a + (doc < F.lit(b)).cast("int"), bounds, F.lit(0))


#: Into how many parts the dropped hashes of a document are dealt, so that looking one up reads few.
SLOTS = 1024


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 40, min_docs: int = 5, batches: int = 4, fanout: int = 3) -> DataFrame:
    """Drop repeated lines: those whose key has ``min_chars`` code points or more and is in ``min_docs``
    documents or more go, except from the document with the largest id among them.

    Returns the columns of ``docs`` with the text replaced by the kept lines, and n_lines and
    n_dropped (which replace columns of those names; other names are free). Null texts become one empty line. Rows with the
    same id are one document and are treated alike; rows with a null id are kept whole and don't
    count. An empty table gives an empty result. Batches are ranges of ids, in descending order.
    """
    spark = docs.sparkSession
    home = shared_dir(spark)
    names, docs = docs.columns, apart(docs, doc_id=id_col, text=text_col)
    left = [k for k, c in enumerate(names) if c in (id_col, text_col) or c not in ("n_lines", "n_dropped")]
    names, docs = [names[k] for k in left], docs.select(*[docs.columns[k] for k in left])
    id_col, text_col = "doc_id", "text"
    named = docs.where(F.col(id_col).isNotNull())
    cuts = named.agg(F.percentile_approx(F.col(id_col).cast("long"), [k / batches for k in range(1, batches)])).first()[0] if batches > 1 else None
    bounds = sorted(set(cuts or []))
    hashes = line_hashes(named, min_chars, id_col, text_col)
    hashes = hashes.withColumn("batch", _batch(F.col("doc"), bounds))
    hashes = written(hashes.sortWithinPartitions("batch"), f"{home}/hashes")  # a batch is a few pages of each file
    runs = LineRuns(spark, fanout, home=f"{home}/runs")
    for k in range(len(bounds) + 1):
        runs.add(hashes.where(F.col("batch") == k).select("doc", "h1", "h2"))
    # a table of its own: joined with an aggregation in the same stage, a hot line's rows could not be split
    common = written(runs.survivors(min_docs), f"{home}/common")
    gone = hashes.join(common, ["h1", "h2"]).where(F.col("doc") != F.col("last"))
    return apply_drops(docs, gone.select("doc", "h1", "h2"), min_chars, id_col, text_col).toDF(*names, "n_lines", "n_dropped")


def apply_drops(docs: DataFrame, gone: DataFrame, min_chars: int, id_col: str, text_col: str) -> DataFrame:
    """Drop from each text the lines whose hashes ``gone`` (doc, h1, h2) lists for its id; rows with a null id stay as they are. Names are those of ``apart``."""
    own = docs.columns
    slot = F.pmod("h1", F.lit(SLOTS)).cast("int")
    parts = gone.repartition("doc").groupBy("doc", slot.alias("slot")).agg(F.collect_set(F.struct("h1", "h2")).alias("of"))
    listed = parts.groupBy("doc").agg(F.map_from_entries(F.collect_list(F.struct("slot", "of"))).alias("gone"))  # at most the document's own lines
    listed = listed.select(F.col("doc").alias("__doc"), F.col("gone").alias("__gone"))
    # null ids match nothing: apart, so that they don't all meet in one task of the join
    joined = docs.where(F.col(id_col).isNotNull()).select(*own).join(listed, F.col(id_col).cast("long") == F.col("__doc"), "left")
    unnamed = docs.where(F.col(id_col).isNull()).select(*own, F.lit(None).cast("long").alias("__doc"), F.lit(None).cast(listed.schema["__gone"].dataType).alias("__gone"))

    def hit(h: Column) -> Column:
        some = F.try_element_at(F.col("__gone"), F.pmod(h["h1"], F.lit(SLOTS)).cast("int"))
        return F.coalesce(F.array_contains(some, h), F.lit(False))

    def stays(line: Column) -> Column:
        return ~F.when(F.char_length(line) < min_chars, False).otherwise(hit(_hash(line_key(line))))

    lines = lines_of(F.col(text_col).cast("string"))
    kept = F.when(F.col("__gone").isNull(), lines).otherwise(F.filter(lines, stays))
    staged = joined.unionByName(unnamed).withColumn("n_lines", F.size(lines).cast("long")).withColumn("__kept", kept)
    staged = staged.withColumn("n_dropped", F.col("n_lines") - F.size("__kept"))
    return staged.select(*[F.array_join("__kept", "\n").alias(c) if c == text_col else F.col(c) for c in own], "n_lines", "n_dropped")
