"""Turtle files as a table of triples, and back.

Columns: s, p, o (lexical), o_kind (iri, literal or bnode), datatype, lang, graph.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

XSD = "http://www.w3.org/2001/XMLSchema#"
RDF = "http://www.w3.org/1999/02/22-rdf-syntax-ns#"
SCHEMA = "s string, p string, o string, o_kind string, datatype string, lang string"
COLUMNS = ["s", "p", "o", "o_kind", "datatype", "lang"]

_LEXER = re.compile(
    r"""(?P<space>\s+|\#[^\n]*)
    |(?P<iri><(?:[^<>"{}|^`\\\x00-\x20]|\\u[0-9A-Fa-f]{4}|\\U[0-9A-Fa-f]{8})*>)
    |(?P<long>\"\"\"(?:[^\"\\]|\\.|\"(?!\"\"))*\"\"\"|'''(?:[^'\\]|\\.|'(?!''))*''')
    |(?P<text>"(?:[^"\\\n]|\\.)*"|'(?:[^'\\\n]|\\.)*')
    |(?P<lang>@[A-Za-z]+(?:-[A-Za-z0-9]+)*)
    |(?P<typed>\^\^)
    |(?P<number>[+-]?(?:\d+\.\d*[eE][+-]?\d+|\.?\d+[eE][+-]?\d+|\d*\.\d+|\d+))
    |(?P<bnode>_:[\w][\w.-]*)
    |(?P<name>(?:[A-Za-z_][\w-]*(?:\.[\w-]+)*)?:(?:[\w:%-]|\\.|\.(?=[\w:%\\-]))*)
    |(?P<word>[A-Za-z]+)
    |(?P<mark>[.;,\[\]()])""",
    re.VERBOSE | re.DOTALL,
)
_ESCAPE = re.compile(r"\\(?:u([0-9A-Fa-f]{4})|U([0-9A-Fa-f]{8})|(.))", re.DOTALL)
_PLAIN = {"t": "\t", "n": "\n", "r": "\r", "b": "\b", "f": "\f"}


def _unescape(text: str) -> str:
    return _ESCAPE.sub(lambda m: chr(int(m[1] or m[2], 16)) if m[1] or m[2] else _PLAIN.get(m[3], m[3]), text)


class _Parser:
    """Recursive descent over the tokens of one document."""

    def __init__(self, text: str, label: str, scope: str | None = None):
        self.scope = f"{label}-" if scope is None else scope
        self.label, self.prefixes, self.base, self.blanks, self.out = label, {}, "", 0, []
        self.tokens = self._lex(text)
        self.kind = self.value = None
        self._next()

    def _lex(self, text: str) -> Iterator[tuple[str, str]]:
        at = 0
        while at < len(text):
            m = _LEXER.match(text, at)
            if not m:
                raise ValueError(f"{self.label}: not Turtle at {text[at : at + 40]!r}")
            at = m.end()
            if m.lastgroup != "space":
                yield m.lastgroup, m[0]

    def _next(self) -> tuple[str, str]:
        now = (self.kind, self.value)
        self.kind, self.value = next(self.tokens, (None, None))
        return now

    def _mark(self, value: str) -> None:
        if self.value != value:
            raise ValueError(f"{self.label}: expected {value!r}, got {self.value!r}")
        self._next()

    def triples(self) -> Iterator[tuple]:
        while self.kind is not None:
            if self.value in ("@prefix", "@base") or self.kind == "word" and self.value.lower() in ("prefix", "base"):
                self._directive()
            else:
                self._statement()
                self._mark(".")
            yield from self.out
            self.out = []

    def _directive(self) -> None:
        _, word = self._next()
        if word.lower().endswith("prefix"):
            _, name = self._next()
            self.prefixes[name[:-1]] = self._iri(self._next()[1])
        else:
            self.base = self._next()[1][1:-1]
        if word.startswith("@"):
            self._mark(".")

    def _iri(self, token: str) -> str:
        value = _unescape(token[1:-1])
        return value if ":" in value else self.base + value

    def _blank(self) -> str:
        self.blanks += 1
        return f"_:{self.label}-b{self.blanks}"

    def _statement(self) -> None:
        own = self.value == "["
        subject = self._node()[0]
        if not (own and self.value == "."):
            self._predicates(subject)

    def _predicates(self, subject: str) -> None:
        while True:
            predicate = self._node(verb=True)[0]
            while True:
                self.out.append((subject, predicate, *self._node()))
                if self.value != ",":
                    break
                self._next()
            if self.value != ";":
                return
            while self.value == ";":
                self._next()
            if self.value in (".", "]"):
                return

    def _node(self, verb: bool = False) -> tuple[str, str, str | None, str | None]:
        kind, value = self._next()
        if kind == "iri":
            return self._iri(value), "iri", None, None
        if kind == "name":
            prefix, _, local = value.partition(":")
            if prefix not in self.prefixes:
                raise ValueError(f"{self.label}: unknown prefix {prefix!r}")
            return self.prefixes[prefix] + re.sub(r"\\(.)", r"\1", local), "iri", None, None
        if kind == "word":
            if value == "a" and verb:
                return RDF + "type", "iri", None, None
            if value in ("true", "false"):
                return value, "literal", XSD + "boolean", None
        if kind == "bnode":
            return f"_:{self.scope}{value[2:]}", "bnode", None, None
        if kind == "number":
            whole = "double" if "e" in value.lower() else "decimal" if "." in value else "integer"
            return value, "literal", XSD + whole, None
        if kind in ("text", "long"):
            body = _unescape(value[3:-3] if kind == "long" else value[1:-1])
            if self.kind == "lang":
                return body, "literal", None, self._next()[1][1:]
            if self.kind == "typed":
                self._next()
                return body, "literal", self._node()[0], None
            return body, "literal", XSD + "string", None
        if value == "[":
            blank = self._blank()
            if self.value != "]":
                self._predicates(blank)
            self._mark("]")
            return blank, "bnode", None, None
        if value == "(":
            return self._list(), "iri", None, None
        raise ValueError(f"{self.label}: unexpected {value!r}")

    def _list(self) -> str:
        if self.value == ")":
            self._next()
            return RDF + "nil"
        here = self._blank()
        self.out.append((here, RDF + "first", *self._node()))
        rest = self._list()
        self.out.append((here, RDF + "rest", rest, "iri" if rest == RDF + "nil" else "bnode", None, None))
        return here


def parse(text: str, label: str = "doc", scope: str | None = None) -> Iterator[tuple]:
    """(s, p, o, o_kind, datatype, lang) of a Turtle document; blank nodes are named after ``label``, those with a name after ``scope`` if that is given."""
    return _Parser(text, label, scope).triples()


def read_turtle(spark: SparkSession, *paths: str, one_document: bool = False) -> DataFrame:
    """The union of the files' triples, as a set: files, or folders of ``.ttl`` files.

    Spark reads the files, so any store it reaches will do; each file is parsed in one task. With ``one_document`` a blank node's
    name means the same in all files and stays as it is, as ``write_turtle`` writes them.
    """
    files = spark.read.text(list(paths), wholetext=True, recursiveFileLookup=True).select("value", F.input_file_name().alias("place"))
    files = files.where(F.lower("place").endswith(".ttl"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text, place in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                triples = parse(text.removeprefix("\ufeff"), re.sub(r"\W+", "-", place.rsplit("/", 1)[-1]), "" if one_document else None)
                while rows := list(islice(triples, 10_000)):
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*rows, strict=True)], names=COLUMNS)

    return files.mapInArrow(run, SCHEMA).dropDuplicates(COLUMNS)


def n_triples(triples: DataFrame, *keep: str) -> DataFrame:
    """One N-Triples line (column ``value``) for each triple, beside the columns ``keep``."""

    def escaped(c):
        for a, b in (("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
            c = F.replace(c, F.lit(a), F.lit(b))
        return c

    def node(c):
        return F.when(c.startswith("_:"), c).otherwise(F.concat(F.lit("<"), c, F.lit(">")))

    literal = F.concat(F.lit('"'), escaped(F.col("o")), F.lit('"'))
    typed = F.when(F.col("lang").isNotNull(), F.concat(literal, F.lit("@"), F.col("lang")))
    typed = typed.when(F.col("datatype").isNotNull() & (F.col("datatype") != XSD + "string"), F.concat(literal, F.lit("^^<"), F.col("datatype"), F.lit(">"))).otherwise(literal)
    obj = F.when(F.col("o_kind") == "literal", typed).otherwise(node(F.col("o")))
    return triples.select(F.concat_ws(" ", node(F.col("s")), node(F.col("p")), obj, F.lit(".")).alias("value"), *keep)
