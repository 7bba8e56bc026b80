"""N-Triples and N-Quads as a table of triples, and quads back to text.

A line is a triple, so Spark's own text source splits a document at line starts into as many tasks as its bytes need, and
built-in functions take the lines apart; no task holds a document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..scratch import distinct, parts
from .turtle import COLUMNS, XSD, n_triples

_NODE = r"<[^<>\"{}|^`\\\x00-\x20]*(?:\\u[0-9A-Fa-f]{4}[^<>\"{}|^`\\\x00-\x20]*|\\U[0-9A-Fa-f]{8}[^<>\"{}|^`\\\x00-\x20]*)*>"
_BLANK = r"_:[\p{L}\p{N}_](?:[\p{L}\p{N}_.·-]*[\p{L}\p{N}_·-])?"
#: Subject and predicate, and what comes after them.
_HEAD = rf"^[ \t]*({_NODE}|{_BLANK})[ \t]*({_NODE})[ \t]*(.*)$"
#: After the object: a graph or none, the full stop, a comment or none.
_TAIL = rf"^[ \t]*({_NODE}|{_BLANK})?[ \t]*\.[ \t]*(?:#.*)?$"
_OBJECT = rf"^({_NODE}|{_BLANK})(.*)$"
_SUFFIX = rf"^(?:@([A-Za-z]+(?:-[A-Za-z0-9]+)*)|\^\^({_NODE}))?(.*)$"
_PLAIN = {"t": "\t", "b": "\b", "n": "\n", "r": "\r", "f": "\f"}


def unescaped(text: Column) -> Column:
    """The text with ``\\n``, ``\\u00E9``, ``\\U0001F600`` and the like replaced by what they mean."""
    pieces = F.regexp_extract_all(text, F.lit(r"(?s)(\\U[0-9A-Fa-f]{8}|\\u[0-9A-Fa-f]{4}|\\.|[^\\]+)"), F.lit(1))

    def one(piece: Column) -> Column:
        code = F.decode(F.unhex(F.lpad(F.substr(piece, F.lit(3)), 8, "0")), "UTF-32")
        short = F.substr(piece, F.lit(2))
        plain = short
        for letter, meant in _PLAIN.items():
            plain = F.when(short == letter, F.lit(meant)).otherwise(plain)
        long = piece.startswith("\\u") | piece.startswith("\\U")
        return F.when(~piece.startswith("\\"), piece).when(long & (F.char_length(piece) > 2), code).otherwise(plain)

    return F.when(F.contains(text, F.lit("\\")), F.array_join(F.transform(pieces, one), "")).otherwise(text)


def _value(node: Column) -> Column:
    return F.when(node.startswith("<"), unescaped(F.substr(node, F.lit(2), F.char_length(node) - 2))).otherwise(node)


def parsed(lines: DataFrame, on_error: str = "raise") -> DataFrame:
    """The triples of lines (column ``value``), with their graph or null; comments and blank lines are none.

    A line that is no triple is an error when the plan runs, or left out with ``on_error`` skip.
    """
    if on_error not in ("raise", "skip"):
        raise ValueError("on_error must be raise or skip")
    line = F.col("value")
    kept = lines.select("value").where(~line.rlike(r"^[ \t]*(?:#.*)?$"))
    cut = kept.select("value", *[F.regexp_extract("value", _HEAD, k).alias(n) for k, n in ((1, "s"), (2, "p"), (3, "rest"))])
    # with escapes masked, the next quote ends a literal, however many escapes it has
    masked = F.regexp_replace("rest", r"\\.", "__")
    cut = cut.select("*", F.col("rest").startswith('"').alias("quoted"), F.locate('"', masked, 2).alias("end"))
    after = F.when(F.col("quoted"), F.expr("substr(rest, end + 1)"))
    cut = cut.select(
        "*",
        F.when(F.col("quoted"), F.expr("substr(rest, 2, end - 2)")).otherwise(F.regexp_extract("rest", _OBJECT, 1)).alias("object"),
        F.regexp_extract(after, _SUFFIX, 1).alias("tag"),
        F.regexp_extract(after, _SUFFIX, 2).alias("type"),
        F.when(F.col("quoted"), F.regexp_extract(after, _SUFFIX, 3)).otherwise(F.regexp_extract("rest", _OBJECT, 2)).alias("tail"),
    )
    good = (F.col("s") != "") & (F.when(F.col("quoted"), F.col("end") > 1).otherwise(F.col("object") != "")) & F.col("tail").rlike(_TAIL)
    graph = F.regexp_extract("tail", _TAIL, 1)
    literal = F.col("quoted")
    kind = F.when(literal, "literal").when(F.col("object").startswith("_:"), "bnode").otherwise("iri")
    datatype = F.when(literal & (F.col("tag") == ""), F.when(F.col("type") != "", _value(F.col("type"))).otherwise(XSD + "string"))
    rows = cut.where(good) if on_error == "skip" else cut.withColumn("s", F.when(good, F.col("s")).otherwise(F.raise_error(F.concat(F.lit("not a triple: "), F.substr("value", F.lit(1), F.lit(200)))).cast("string")))
    return rows.select(
        _value(F.col("s")).alias("s"),
        _value(F.col("p")).alias("p"),
        F.when(literal, unescaped(F.col("object"))).otherwise(_value(F.col("object"))).alias("o"),
        kind.alias("o_kind"),
        datatype.alias("datatype"),
        F.when(F.col("tag") != "", F.col("tag")).alias("lang"),
        F.when(graph != "", _value(graph)).alias("graph"),
    )


def read_quads(spark: SparkSession, *paths: str, on_error: str = "raise") -> DataFrame:
    """The quads of N-Quads (or N-Triples) files and folders, as they are; graph is null in the default graph.

    All files of one call are one document: a blank node's label means the same node in each of them.
    """
    return parsed(spark.read.text(list(paths), recursiveFileLookup=True), on_error)


def read_ntriples(spark: SparkSession, *paths: str, on_error: str = "raise") -> DataFrame:
    """The set of triples of N-Triples files and folders; see ``read_quads``."""
    return read_quads(spark, *paths, on_error=on_error).select(*COLUMNS).dropDuplicates()


def n_quads(quads: DataFrame) -> DataFrame:
    """One N-Quads line (column ``value``) for each row of the triples' columns and ``graph``, which may be null."""
    node = F.when(F.col("graph").startswith("_:"), F.col("graph")).otherwise(F.concat(F.lit("<"), "graph", F.lit(">")))
    lines = n_triples(quads, "graph")
    return lines.select(F.when(F.col("graph").isNull(), F.col("value")).otherwise(F.concat(F.expr("substr(value, 1, char_length(value) - 1)"), node, F.lit(" ."))).alias("value"))


def write_quads(quads: DataFrame, path: str) -> None:
    """N-Quads text, each quad once."""
    rows = quads.select(*COLUMNS, "graph")
    n_quads(distinct(rows, parts(rows))).write.mode("overwrite").text(path)
