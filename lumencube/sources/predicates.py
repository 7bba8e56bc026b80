"""A store of triples by predicate, with terms as integers.

Terms are numbered in their order by a range partition, so numbers are as small as they can be read back: a subject and an object are two
longs. Triples lie in one table that is partitioned by predicate and, within each, bucketed and sorted by subject. So a
pattern with a fixed predicate reads that predicate alone, and a star of patterns about one subject joins bucket by
bucket, without an exchange. Terms are looked up only for what a query returns.

Tasks hold a share of fixed size however many triples there are: buckets and partitions follow the number of rows, and rows of a term
that very many triples have get its number, or its text, from a broadcast and are spread over all partitions.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import scratch
from . import files
from .turtle import XSD

_TERM = ("v", "kind", "datatype", "lang")
#: Predicates that have a partition of their own; all others share one.
MOST_PREDICATES = 10_000
_OTHERS = -1
#: Numbers of terms in more than ``scratch.PART_ROWS`` places are broadcast, so many at most.
MOST_HOT = 100_000


def _term(v: str, kind: Column, datatype: Column | None = None, lang: Column | None = None) -> list[Column]:
    none = F.lit(None).cast("string")
    return [F.col(v).alias("v"), kind.alias("kind"), (none if datatype is None else datatype).alias("datatype"), (none if lang is None else lang).alias("lang")]


def _node_kind(name: str) -> Column:
    return F.when(F.col(name).startswith("_:"), "bnode").otherwise("iri")


def _looked_up(frame: DataFrame, key: Column, terms: DataFrame, value: str, n: int) -> DataFrame:
    """``frame`` with the ``value`` of the term (columns key, value, uses) that has its ``key``, or null.

    Frequent keys are looked up in a broadcast; their rows, and those without a key, are dealt out by all their columns and meet nothing in the join.
    """
    hot = terms.where(F.col("uses") > scratch.PART_ROWS).orderBy(F.desc("uses"), "key").limit(MOST_HOT).select(F.col("key").alias("__hot"), F.struct(F.col(value).alias("v")).alias("__found"))
    plain = [F.col(f.name) for f in frame.schema.fields if isinstance(f.dataType, T.AtomicType)]
    spread = F.pmod(F.xxhash64(*plain), F.lit(n)) + 1
    rows = frame.withColumn("__key", key).join(F.broadcast(hot), F.col("__key") == F.col("__hot"), "left")
    salt = F.when(F.col("__found").isNotNull() | F.col("__key").isNull(), spread).otherwise(F.lit(0).cast("long"))
    # one struct of one type is the whole key of the join, so that the partitions are those of these lines
    whole = f"struct<key:{terms.schema['key'].dataType.simpleString()},salt:bigint>"
    rows = rows.withColumn("__at", F.struct(F.col("__key").alias("key"), salt.alias("salt")).cast(whole)).drop("__key", "__hot").repartition(n, "__at")
    own = terms.select(F.struct(F.col("key").alias("key"), F.lit(0).cast("long").alias("salt")).cast(whole).alias("__own"), F.col(value).alias("__value")).repartition(n, "__own")
    joined = rows.join(own, F.col("__at") == F.col("__own"), "left")
    return joined.select(*frame.columns, F.coalesce(F.col("__found.v"), F.col("__value")).alias(value))


class PredicateStore:
    """Opened with ``build`` or ``open``. The triples are a set; rows with a null subject, predicate or object are left out."""

    def __init__(self, spark: SparkSession, path: str, manifest: dict):
        self.spark, self.path, self.manifest = spark, path, manifest
        self.predicates: dict[str, int] = manifest["predicates"]
        name = f"triples_{uuid.uuid4().hex}"
        spark.sql(f"CREATE TABLE {name} (s BIGINT, q BIGINT, o BIGINT, p INT) USING parquet PARTITIONED BY (p) CLUSTERED BY (s) SORTED BY (s, q, o) INTO {manifest['buckets']} BUCKETS LOCATION '{path}/triples'")
        for p in sorted({*self.predicates.values(), *([_OTHERS] if manifest["others"] else [])}):
            spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS PARTITION (p={p})")
        self._triples = spark.table(name)
        self._name = name
        self.terms = spark.read.parquet(f"{path}/terms")

    @classmethod
    def build(cls, triples: DataFrame, path: str, buckets: int | None = None) -> PredicateStore:
        """Write a store to ``path``, with at least ``buckets`` buckets, and so many that one has about ``scratch.PART_ROWS`` triples."""
        spark = triples.sparkSession
        rows = triples.where(F.col("s").isNotNull() & F.col("p").isNotNull() & F.col("o").isNotNull())
        # a plain literal is a string, however it was written
        datatype = F.when((F.col("o_kind") == "literal") & F.col("lang").isNull(), F.coalesce("datatype", F.lit(XSD + "string")))
        rows = rows.select("s", "p", "o", "o_kind", datatype.alias("datatype"), "lang")
        scratch.distinct(rows, scratch.parts(rows)).write.parquet(f"{path}/raw")
        rows = spark.read.schema(rows.schema).parquet(f"{path}/raw")
        total = rows.count()
        n = -(-total // scratch.PART_ROWS) or 1
        buckets = max(n, buckets or int(spark.conf.get("spark.sql.shuffle.partitions")))
        n = max(n, spark.sparkContext.defaultParallelism)
        predicates = rows.groupBy("p").agg(F.count(F.lit(1)).alias("uses"))
        each = [rows.select(*_term("s", _node_kind("s")), F.lit(1).cast("long").alias("uses")), predicates.select(*_term("p", F.lit("iri")), "uses"), rows.select(*_term("o", F.col("o_kind"), F.col("datatype"), F.col("lang")), F.lit(1).cast("long").alias("uses"))]
        terms = reduce(DataFrame.unionByName, each).repartition(n, *_TERM).groupBy(*_TERM).agg(F.sum("uses").alias("uses"))
        # the number of a row within its range, and the range; fixed once written
        ordered = terms.repartitionByRange(n, *_TERM).sortWithinPartitions(*_TERM)
        ordered.withColumn("id", F.monotonically_increasing_id()).write.parquet(f"{path}/terms")
        terms = spark.read.parquet(f"{path}/terms")
        terms = terms.select(F.struct(*_TERM).alias("key"), "id", "uses")
        counted = predicates.orderBy(F.desc("uses"), "p").limit(MOST_PREDICATES + 1).collect()
        named = {r.p: k for k, r in enumerate(counted[:MOST_PREDICATES])}
        numbers = spark.createDataFrame([*named.items()] or [("", 0)], "p string, number int")
        coded = rows.join(F.broadcast(numbers), "p", "left").withColumn("number", F.coalesce("number", F.lit(_OTHERS)))  # at most MOST_PREDICATES rows
        own = {"s": ("s",), "q": ("p",), "o": ("o", "o_kind", "datatype", "lang")}
        keys = {"s": F.struct(*_term("s", _node_kind("s"))), "q": F.struct(*_term("p", F.lit("iri"))), "o": F.struct(*_term("o", F.col("o_kind"), F.col("datatype"), F.col("lang")))}
        for name, given in own.items():
            coded = _looked_up(coded, keys[name], terms, "id", n).withColumnRenamed("id", f"id_{name}").drop(*given)
        out = coded.select(F.col("id_s").alias("s"), F.col("id_q").alias("q"), F.col("id_o").alias("o"), F.col("number").alias("p"))
        name = f"made_{uuid.uuid4().hex}"
        dealt = out.repartition(buckets, "s")  # the buckets' own hash, so that each predicate has one file a bucket
        dealt.write.partitionBy("p").bucketBy(buckets, "s").sortBy("s", "q", "o").option("path", f"{path}/triples").saveAsTable(name)
        spark.sql(f"DROP TABLE {name}")  # the files stay
        files.remove(spark, f"{path}/raw")
        manifest = {"buckets": buckets, "predicates": named, "others": len(counted) > MOST_PREDICATES}
        files.publish_text(spark, f"{path}/manifest.json", json.dumps(manifest))
        return cls(spark, path, manifest)

    @classmethod
    def open(cls, spark: SparkSession, path: str) -> PredicateStore:
        return cls(spark, path, json.loads(files.read_text(spark, f"{path}/manifest.json")))

    def close(self) -> None:
        """Forget the table's entry in the catalogue; the files stay."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self._name}")

    def pairs(self, predicate: str) -> DataFrame:
        """(s, o) of one predicate, as numbers; reads its partition alone."""
        if predicate in self.predicates:
            return self._triples.where(F.col("p") == self.predicates[predicate]).select("s", "o")
        if not self.manifest["others"]:
            return self._triples.where(F.lit(False)).select("s", "o")
        own = self.number(predicate)
        return self._triples.where((F.col("p") == _OTHERS) & (F.col("q") == (own if own is not None else -1))).select("s", "o")

    def number(self, value: str, kind: str = "iri", datatype: str | None = None, lang: str | None = None) -> int | None:
        """The number of one term, None if there is no such term. Terms are sorted, so few pages of the table are read."""
        datatype = datatype or (XSD + "string" if kind == "literal" and lang is None else None)
        same = (F.col("v") == value) & (F.col("kind") == kind) & F.col("datatype").eqNullSafe(F.lit(datatype).cast("string")) & F.col("lang").eqNullSafe(F.lit(lang).cast("string"))
        row = self.terms.where(same).first()
        return row.id if row else None

    def star(self, patterns: Mapping[str, str], optional: Sequence[str] = ()) -> DataFrame:
        """Subjects with all of ``patterns`` (a name to a predicate): ``subject`` and a column for each name, as numbers.

        A subject with several objects of a predicate has a row for each combination. Names in ``optional`` may lack an object,
        which is null then; the first name may not be optional.
        """
        names = list(patterns)
        if not names or names[0] in optional or set(optional) - set(names):
            raise ValueError("the first pattern can't be optional, and optional ones must be patterns")
        out = self.pairs(patterns[names[0]]).select(F.col("s").alias("subject"), F.col("o").alias(names[0]))
        for name in names[1:]:
            right = self.pairs(patterns[name]).select(F.col("s").alias("__s"), F.col("o").alias(name))
            out = out.join(right.hint("merge"), F.col("subject") == F.col("__s"), "left" if name in optional else "inner").drop("__s")
        return out

    def decoded(self, frame: DataFrame, *columns: str) -> DataFrame:
        """The frame with the numbers in ``columns`` replaced by the terms' lexical forms; null stays null."""
        n = self._parts(frame)
        terms = self.terms.select(F.col("id").alias("key"), F.col("v").alias("__v"), "uses")
        for c in columns:
            others = [F.col("__v").alias(c) if x == c else F.col(x) for x in frame.columns]
            frame = _looked_up(frame, F.col(c), terms, "__v", n).select(*others)
        return frame

    def _parts(self, frame: DataFrame) -> int:
        """Partitions in which neither the frame nor the terms are large."""
        return max(scratch.parts(frame), scratch.parts(self.terms))

    def triples(self) -> DataFrame:
        """All triples as they were given, as a set."""
        out = self._triples.select("s", "q", "o")
        n = self._parts(out)
        for name, columns in (("s", ("v",)), ("q", ("v",)), ("o", _TERM)):
            terms = self.terms.select(F.col("id").alias("key"), F.struct(*columns).alias("term"), "uses")
            out = _looked_up(out, F.col(name), terms, "term", n).withColumnRenamed("term", f"{name}_term")
        o = F.col("o_term")
        return out.select(F.col("s_term.v").alias("s"), F.col("q_term.v").alias("p"), o["v"].alias("o"), o["kind"].alias("o_kind"), o["datatype"].alias("datatype"), o["lang"].alias("lang"))
