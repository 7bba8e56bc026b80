"""A graph-query front end: SPARQL SELECT and ASK over a table of triples, compiled to DataFrame joins.

Supported: PREFIX, BASE, SELECT [DISTINCT] with expressions, ASK, basic graph patterns with ``;``,
``,``, ``a`` and ``[ ]``, paths ``p+`` and ``^p``, FILTER, FILTER [NOT] EXISTS, OPTIONAL, UNION, MINUS,
VALUES, BIND, GRAPH <iri>, sub-SELECT, GROUP BY, HAVING, COUNT, SUM, AVG, MIN, MAX, SAMPLE,
GROUP_CONCAT, ORDER BY, LIMIT, OFFSET.

A variable is a struct (v, k, d, l): lexical value, kind, datatype, language. Joins compare these
structs; a variable that may be unbound joins only where both sides are bound or one is not. Catalyst
sees plain joins and filters, so constants reach the scan of the triples and small sides are broadcast.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.closure import reachable, transitive_closure
from ..scratch import shared_dir, written
from ..sources.turtle import RDF, XSD

_LEXER = re.compile(
    r"""(?P<space>\s+|\#[^\n]*)|(?P<iri><[^<>"{}|^`\\\s]*>)|(?P<text>"(?:[^"\\\n]|\\.)*"|'(?:[^'\\\n]|\\.)*')
    |(?P<var>[?$]\w+)|(?P<lang>@[A-Za-z]+(?:-[A-Za-z0-9]+)*)|(?P<number>\d+\.\d+(?:[eE][+-]?\d+)?|\d+)
    |(?P<name>(?:[A-Za-z_][\w-]*)?:(?:[\w%-]|\.(?=[\w%-]))*)|(?P<word>[A-Za-z_]\w*)
    |(?P<mark>\^\^|&&|\|\||!=|<=|>=|[{}()\[\].;,*+/=<>!^|-])""",
    re.VERBOSE,
)
NUMERIC = tuple(XSD + x for x in ("integer", "decimal", "double", "float", "nonNegativeInteger", "int", "long", "positiveInteger", "negativeInteger", "short"))
AGGREGATES = ("COUNT", "SUM", "AVG", "MIN", "MAX", "SAMPLE", "GROUP_CONCAT")


def term(v: Column | str | None, k: Column | str = "literal", d: Column | str | None = None, lang: Column | str | None = None) -> Column:
    lit = lambda x: x if isinstance(x, Column) else F.lit(x).cast("string")
    return F.struct(lit(v).alias("v"), lit(k).alias("k"), lit(d).alias("d"), lit(lang).alias("l"))


def number(c: Column) -> Column:
    return c["v"].try_cast("double")


def from_bool(c: Column) -> Column:
    return F.when(c.isNotNull(), term(c.cast("string"), "literal", XSD + "boolean"))


def from_number(c: Column, whole: Column | bool = False) -> Column:
    whole = whole if isinstance(whole, Column) else F.lit(whole)
    text = F.when(whole, c.cast("bigint").cast("string")).otherwise(c.cast("double").cast("string"))
    return F.when(c.isNotNull(), term(text, "literal", F.when(whole, XSD + "integer").otherwise(XSD + "decimal")))


def truth(c: Column) -> Column:
    """Effective boolean value."""
    return F.when(c["d"] == XSD + "boolean", c["v"] == "true").when(c["d"].isin(*NUMERIC), number(c) != 0).otherwise(F.char_length(c["v"]) > 0)


@dataclass
class Solution:
    """Bindings: a frame with one struct column for each variable, and the variables that may be unbound."""

    frame: DataFrame
    variables: list[str]
    maybe: set[str] = field(default_factory=set)


class SparqlError(ValueError):
    pass


#: Of two patterns without a shared variable one may have at most so many rows; it is broadcast.
MOST_UNJOINED = 100_000


class Query:
    def __init__(self, engine: Engine, text: str):
        self.engine, self.spark = engine, engine.spark
        self.tokens = []
        at = 0
        while at < len(text):
            m = _LEXER.match(text, at)
            if not m:
                raise SparqlError(f"cannot read {text[at : at + 30]!r}")
            at = m.end()
            if m.lastgroup != "space":
                self.tokens.append((m.lastgroup, m[0]))
        self.at, self.prefixes, self.base, self.fresh, self.graph = 0, {}, "", 0, None

    # tokens
    def peek(self, k: int = 0) -> tuple[str | None, str]:
        return self.tokens[self.at + k] if self.at + k < len(self.tokens) else (None, "")

    def next(self) -> tuple[str, str]:
        token = self.peek()
        if token[0] is None:
            raise SparqlError("the query ends too early")
        self.at += 1
        return token

    def word(self, *names: str) -> bool:
        kind, value = self.peek()
        if kind == "word" and value.upper() in names:
            self.at += 1
            return True
        return False

    def is_word(self, *names: str) -> bool:
        kind, value = self.peek()
        return kind == "word" and value.upper() in names

    def mark(self, value: str) -> bool:
        if self.peek() == ("mark", value):
            self.at += 1
            return True
        return False

    def expect(self, value: str) -> None:
        if not self.mark(value):
            raise SparqlError(f"expected {value!r}, got {self.peek()[1]!r}")

    def variable(self) -> str:
        kind, value = self.next()
        if kind != "var":
            raise SparqlError(f"expected a variable, got {value!r}")
        return value[1:]

    def new_name(self) -> str:
        self.fresh += 1
        return f"__b{self.fresh}"

    # terms
    def iri(self, token: tuple[str, str]) -> str:
        kind, value = token
        if kind == "iri":
            return value[1:-1] if ":" in value else self.base + value[1:-1]
        prefix, _, local = value.partition(":")
        if prefix not in self.prefixes:
            raise SparqlError(f"unknown prefix {prefix!r}")
        return self.prefixes[prefix] + local

    def constant(self) -> tuple[str, str, str | None, str | None] | None:
        """(v, k, d, l) of a constant term, if one comes next."""
        kind, value = self.peek()
        sign = ""
        if kind == "mark" and value in "+-" and self.peek(1)[0] == "number":
            self.at += 1
            sign = "-" if value == "-" else ""
            kind, value = self.peek()
        if kind in ("iri", "name"):
            self.at += 1
            return self.iri((kind, value)), "iri", None, None
        if kind == "number":
            self.at += 1
            return sign + value, "literal", XSD + ("decimal" if "." in value else "integer"), None
        if kind == "word" and value.lower() in ("true", "false"):
            self.at += 1
            return value.lower(), "literal", XSD + "boolean", None
        if kind == "text":
            self.at += 1
            body = re.sub(r"\\(.)", lambda m: {"n": "\n", "t": "\t", "r": "\r"}.get(m[1], m[1]), value[1:-1])
            if self.peek()[0] == "lang":
                return body, "literal", None, self.next()[1][1:]
            if self.mark("^^"):
                return body, "literal", self.iri(self.next()), None
            return body, "literal", XSD + "string", None
        return None

    # the query
    def parse(self) -> tuple[str, Solution]:
        while True:
            if self.word("PREFIX"):
                _, name = self.next()
                self.prefixes[name[:-1]] = self.iri(self.next())
            elif self.word("BASE"):
                self.base = self.next()[1][1:-1]
            else:
                break
        if self.word("ASK"):
            self.word("WHERE")
            out = "ask", self.group()
        elif self.is_word("SELECT"):
            out = "select", self.select()
        else:
            raise SparqlError("only SELECT and ASK are supported")
        if self.peek()[0] is not None:
            raise SparqlError(f"unexpected {self.peek()[1]!r}")
        return out

    def select(self) -> Solution:
        self.word("SELECT")
        distinct = self.word("DISTINCT", "REDUCED")
        wanted: list[tuple[str, int | None]] = []
        every = self.mark("*")
        while not every:
            if self.peek()[0] == "var":
                wanted.append((self.variable(), None))
            elif self.mark("("):
                at = self.at
                self.skip_expression()
                if not self.word("AS"):
                    raise SparqlError("expected AS")
                wanted.append((self.variable(), at))
                self.expect(")")
            else:
                break
        self.word("WHERE")
        solution = self.group()
        keys: list[str] = []
        grouped = False
        if self.word("GROUP"):
            self.word("BY")
            grouped = True
            while self.peek()[0] == "var" or self.peek() == ("mark", "("):
                if self.mark("("):
                    value, _ = self.expression(solution)
                    name = self.variable() if self.word("AS") else self.new_name()
                    self.expect(")")
                    solution = Solution(solution.frame.withColumn(name, value), [*solution.variables, name], solution.maybe | {name})
                else:
                    name = self.variable()
                keys.append(name)
        having = None
        if self.word("HAVING"):
            having = self.at
            self.expect("(")
            self.skip_expression()
            self.expect(")")
        tail = self.at
        if grouped or any(at is not None and self.has_aggregate(at) for _, at in wanted):
            solution = self.aggregated(solution, keys, wanted, having, tail)
        else:
            for name, at in wanted:
                if at is not None:
                    value, _ = self.at_expression(at, solution)
                    solution = Solution(solution.frame.withColumn(name, value), [*solution.variables, name], solution.maybe | {name})
        self.at = tail
        order = []
        if self.word("ORDER"):
            self.word("BY")
            while self.peek()[0] == "var" or self.peek() == ("mark", "(") or self.is_word("ASC", "DESC"):
                down = self.is_word("DESC")
                self.word("ASC", "DESC")
                value, _ = self.primary(solution)
                for key in (number(value), value["v"]):
                    order.append(F.desc_nulls_last(key) if down else F.asc_nulls_first(key))
        names = [v for v in solution.variables if not v.startswith("__")] if every else [n for n, _ in wanted]
        frame = solution.frame
        for n in names:
            if n not in frame.columns:
                frame = frame.withColumn(n, F.lit(None).cast(_TERM))
        if distinct:
            frame = frame.select(*names).distinct() if not order else frame.dropDuplicates(names)
        if order:
            frame = frame.orderBy(*order)
        limit = offset = None
        while self.is_word("LIMIT", "OFFSET"):
            if self.word("LIMIT"):
                limit = int(self.next()[1])
            elif self.word("OFFSET"):
                offset = int(self.next()[1])
        if offset:
            frame = frame.offset(offset)
        if limit is not None:
            frame = frame.limit(limit)
        return Solution(frame.select(*names), names, solution.maybe & set(names) | {n for n in names if n not in solution.variables})

    def skip_expression(self) -> None:
        depth = 0
        while True:
            kind, value = self.peek()
            if kind is None:
                raise SparqlError("the query ends too early")
            if depth == 0 and (value == ")" or kind == "word" and value.upper() == "AS"):
                return
            depth += (value in ("(", "{")) - (value in (")", "}"))
            self.at += 1

    def has_aggregate(self, at: int) -> bool:
        depth = 0
        for kind, value in self.tokens[at:]:
            if depth == 0 and (value == ")" or kind == "word" and value.upper() == "AS"):
                return False
            depth += (value == "(") - (value == ")")
            if kind == "word" and value.upper() in AGGREGATES:
                return True
        return False

    def at_expression(self, at: int, solution: Solution):
        self.at = at
        return self.expression(solution)

    def aggregated(self, solution: Solution, keys: list[str], wanted, having: int | None, tail: int) -> Solution:
        """One aggregation computes all aggregates; expressions over them follow."""
        self.pending: list[Column] = []
        made = []
        inside = Solution(solution.frame, solution.variables, solution.maybe)
        for name, at in wanted:
            if at is not None:
                made.append((name, self.at_expression(at, inside)[0]))
        check = None
        if having is not None:
            self.at = having
            self.expect("(")
            check = truth(self.expression(inside)[0])
        frame = solution.frame.groupBy(*keys).agg(*(self.pending or [F.count(F.lit(1)).alias("__none")]))
        del self.pending
        if check is not None:
            frame = frame.where(check)
        frame = frame.select(*keys, *[value.alias(name) for name, value in made])
        return Solution(frame, [*keys, *[n for n, _ in made]], (solution.maybe & set(keys)) | {n for n, _ in made})

    # groups
    def unit(self) -> Solution:
        return Solution(self.spark.range(1).select(F.lit(True).alias("__one")), [])

    def group(self) -> Solution:
        self.expect("{")
        if self.is_word("SELECT"):
            found = self.select()
            self.expect("}")
            return found
        solution: Solution | None = None
        filters: list[int] = []
        later: list[tuple[bool, Solution]] = []
        while not self.mark("}"):
            if self.mark("."):
                continue
            if self.is_word("FILTER"):
                self.at += 1
                if self.word("NOT"):
                    self.word("EXISTS")
                    later.append((False, self.group()))
                elif self.word("EXISTS"):
                    later.append((True, self.group()))
                else:
                    filters.append(self.at)
                    self.skip_filter()
            elif self.word("OPTIONAL"):
                solution = self.left_join(solution or self.unit(), *self.optional())
            elif self.word("MINUS"):
                solution = self.semi(solution or self.unit(), self.group(), False)
            elif self.word("BIND"):
                self.expect("(")
                value, _ = self.expression(solution or self.unit())
                self.word("AS")
                name = self.variable()
                self.expect(")")
                base = solution or self.unit()
                solution = Solution(base.frame.withColumn(name, value), [*base.variables, name], base.maybe | {name})
            elif self.word("VALUES"):
                solution = self.join(solution, self.values())
            elif self.word("GRAPH"):
                outer, self.graph = self.graph, self.iri(self.next())
                solution = self.join(solution, self.group())
                self.graph = outer
            elif self.peek() == ("mark", "{"):
                branch = self.group()
                while self.word("UNION"):
                    branch = self.union(branch, self.group())
                solution = self.join(solution, branch)
            else:
                for pattern in self.patterns():
                    solution = self.join(solution, self.match(*pattern))
        solution = solution or self.unit()
        end = self.at
        for at in filters:
            value, _ = self.at_expression(at, solution)
            solution = Solution(solution.frame.where(truth(value)), solution.variables, solution.maybe)
        self.at = end
        for keep, other in later:
            solution = self.semi(solution, other, keep)
        return solution

    def skip_filter(self) -> None:
        if self.peek()[0] in ("word", "name", "iri"):
            self.at += 1
        self.expect("(")
        depth = 1
        while depth:
            value = self.next()[1]
            depth += (value == "(") - (value == ")")

    def optional(self) -> tuple[Solution, None]:
        return self.group(), None

    def values(self) -> Solution:
        names = [self.variable()] if self.peek()[0] == "var" else []
        single = bool(names)
        if not single:
            self.expect("(")
            while not self.mark(")"):
                names.append(self.variable())
        self.expect("{")
        rows = []
        while not self.mark("}"):
            if single:
                rows.append([self.value()])
            else:
                self.expect("(")
                row = []
                while not self.mark(")"):
                    row.append(self.value())
                rows.append(row)
        schema = ", ".join(f"`{n}` {_TERM}" for n in names)
        maybe = {n for k, n in enumerate(names) if any(r[k] is None for r in rows)}
        return Solution(self.spark.createDataFrame([tuple(r) for r in rows], schema), names, maybe)

    def value(self):
        if self.word("UNDEF"):
            return None
        found = self.constant()
        if found is None:
            raise SparqlError(f"expected a value, got {self.peek()[1]!r}")
        return found

    def patterns(self):
        """(subject, predicate, object, path) of one subject with its predicates; ``path`` is "+", "^" or ""."""
        out = []
        subject = self.node(out)
        if self.peek()[1] not in (".", "}"):
            self.predicates(subject, out)
        return out

    def node(self, out):
        if self.peek()[0] == "var":
            return ("var", self.variable())
        if self.mark("["):
            blank = ("var", self.new_name())
            if not self.mark("]"):
                self.predicates(blank, out)
                self.expect("]")
            return blank
        found = self.constant()
        if found is None:
            raise SparqlError(f"expected a term, got {self.peek()[1]!r}")
        return ("term", found)

    def predicates(self, subject, out) -> None:
        while True:
            path = "^" if self.mark("^") else ""
            if self.peek() == ("word", "a"):
                self.at += 1
                predicate = ("term", (RDF + "type", "iri", None, None))
            else:
                predicate = self.node(out)
            if self.mark("+"):
                path += "+"
            while True:
                out.append((subject, predicate, self.node(out), path))
                if not self.mark(","):
                    break
            if not self.mark(";"):
                return
            while self.mark(";"):
                pass
            if self.peek()[1] in (".", "}", "]"):
                return

    def match(self, subject, predicate, obj, path: str) -> Solution:
        rows = self.engine.triples(self.graph)
        if "+" in path:
            if predicate[0] != "term":
                raise SparqlError("a path needs a fixed predicate")
        if "^" in path:
            subject, obj = obj, subject
        if "+" in path:
            ends = [x[1][0] if x[0] == "term" else None for x in (subject, obj)]
            rows = self.engine.closure(self.graph, predicate[1][0], *ends)
        parts = (("s", subject, term(F.col("s"), F.when(F.col("s").startswith("_:"), "bnode").otherwise("iri"))), ("p", predicate, term(F.col("p"), "iri")), ("o", obj, term(F.col("o"), F.col("o_kind"), F.col("datatype"), F.col("lang"))))
        test, made = F.lit(True), {}
        for column, (kind, value), whole in parts:
            if kind == "term":
                v, k, d, lang = value
                test = test & (F.col(column) == v)
                if column == "o":
                    test = test & (F.col("o_kind") == k) & F.col("lang").eqNullSafe(F.lit(lang).cast("string"))
                    if k == "literal" and lang is None:
                        test = test & (F.coalesce("datatype", F.lit(XSD + "string")) == (d or XSD + "string"))
            elif value in made:
                test = test & (made[value] == whole)
            else:
                made[value] = whole
        rows = rows.where(test)
        frame = rows.select(*[c.alias(n) for n, c in made.items()]) if made else rows.select(F.lit(True).alias("__one"))
        return Solution(frame, list(made))

    # algebra
    def on(self, a: Solution, b: Solution, right: DataFrame):
        shared = [v for v in b.variables if v in a.variables]
        tests = []
        for v in shared:
            same = a.frame[v] == right[f"__r_{v}"]
            if v in a.maybe:
                same = same | a.frame[v].isNull()
            if v in b.maybe:
                same = same | right[f"__r_{v}"].isNull()
            tests.append(same)
        return shared, tests

    def renamed(self, b: Solution) -> DataFrame:
        return b.frame.select(*[F.col(f"`{v}`").alias(f"__r_{v}") for v in b.variables]) if b.variables else b.frame.select(F.lit(True).alias("__r"))

    def unjoined(self, left: DataFrame, right: DataFrame, how: str) -> DataFrame:
        """Every row with every row, one side being of a checked size. Two large ones are refused: their product is no result."""

        def small(x: DataFrame) -> bool:
            return x.limit(MOST_UNJOINED + 1).count() <= MOST_UNJOINED

        if small(right):
            return left.join(F.broadcast(right), F.lit(True), how)
        if how == "inner" and small(left):
            return F.broadcast(left).join(right, F.lit(True), how)
        raise SparqlError(f"patterns that share no variable have more than {MOST_UNJOINED} rows on both sides; join them by a variable")

    def combine(self, a: Solution, b: Solution, how: str) -> Solution:
        right = self.renamed(b)
        shared, tests = self.on(a, b, right)
        joined = a.frame.join(right, tests, how) if tests else self.unjoined(a.frame, right, how)
        columns = []
        for v in a.variables:
            c = a.frame[v]
            columns.append((F.coalesce(c, right[f"__r_{v}"]) if v in shared and v in a.maybe else c).alias(v))
        new = [v for v in b.variables if v not in a.variables]
        columns += [right[f"__r_{v}"].alias(v) for v in new]
        maybe = (a.maybe - (set(shared) - b.maybe if how == "inner" else set())) | ({v for v in new if v in b.maybe} if how == "inner" else set(new))
        return Solution(joined.select(*columns) if columns else joined.select(F.lit(True).alias("__one")), [*a.variables, *new], maybe)

    def join(self, a: Solution | None, b: Solution) -> Solution:
        return b if a is None else self.combine(a, b, "inner")

    def left_join(self, a: Solution, b: Solution, _=None) -> Solution:
        return self.combine(a, b, "left")

    def semi(self, a: Solution, b: Solution, keep: bool) -> Solution:
        right = self.renamed(b)
        shared, tests = self.on(a, b, right)
        if not shared:
            some = not b.frame.isEmpty()
            return a if some == keep else Solution(a.frame.limit(0), a.variables, a.maybe)
        return Solution(a.frame.join(right, tests, "left_semi" if keep else "left_anti"), a.variables, a.maybe)

    def union(self, a: Solution, b: Solution) -> Solution:
        names = [*a.variables, *[v for v in b.variables if v not in a.variables]]

        def wide(x: Solution) -> DataFrame:
            return x.frame.select(*[(F.col(f"`{v}`") if v in x.variables else F.lit(None)).cast(_TERM).alias(v) for v in names])

        lacking = {v for v in names if v not in a.variables or v not in b.variables}
        return Solution(wide(a).unionByName(wide(b)), names, a.maybe | b.maybe | lacking)

    # expressions; each returns (term, None)
    def expression(self, s: Solution):
        left = self.conjunction(s)
        while self.mark("||"):
            right = self.conjunction(s)
            left = from_bool(truth(left[0]) | truth(right[0])), None
        return left

    def conjunction(self, s: Solution):
        left = self.comparison(s)
        while self.mark("&&"):
            right = self.comparison(s)
            left = from_bool(truth(left[0]) & truth(right[0])), None
        return left

    def comparison(self, s: Solution):
        left, _ = self.sum(s)
        for op in ("=", "!=", "<=", ">=", "<", ">"):
            if self.mark(op):
                return from_bool(compared(left, self.sum(s)[0], op)), None
        negate = self.is_word("NOT") and self.peek(1)[1].upper() == "IN"
        if negate:
            self.at += 1
        if self.word("IN"):
            self.expect("(")
            hit = F.lit(False)
            while not self.mark(")"):
                hit = hit | compared(left, self.expression(s)[0], "=")
                self.mark(",")
            return from_bool(~hit if negate else hit), None
        return left, None

    def sum(self, s: Solution):
        left, _ = self.product(s)
        while self.peek() in (("mark", "+"), ("mark", "-")):
            op = self.next()[1]
            right, _ = self.product(s)
            a, b = number(left), number(right)
            left = from_number(a + b if op == "+" else a - b, integral(left) & integral(right))
        return left, None

    def product(self, s: Solution):
        left, _ = self.unary(s)
        while self.peek() in (("mark", "*"), ("mark", "/")):
            op = self.next()[1]
            right, _ = self.unary(s)
            a, b = number(left), number(right)
            left = from_number(a * b, integral(left) & integral(right)) if op == "*" else from_number(F.try_divide(a, b))
        return left, None

    def unary(self, s: Solution):
        if self.mark("!"):
            return from_bool(~truth(self.unary(s)[0])), None
        if self.peek() == ("mark", "-") and self.peek(1)[0] != "number":
            self.at += 1
            value = self.unary(s)[0]
            return from_number(-number(value), integral(value)), None
        return self.primary(s)

    def primary(self, s: Solution):
        if self.mark("("):
            value = self.expression(s)
            self.expect(")")
            return value
        kind, value = self.peek()
        if kind == "var":
            name = self.variable()
            return (F.col(f"`{name}`") if name in s.variables else F.lit(None).cast(_TERM)), None
        if kind == "word" and value.upper() in AGGREGATES:
            self.at += 1
            return self.aggregate(value.upper(), s), None
        if kind == "word" and value.lower() not in ("true", "false"):
            self.at += 1
            return self.call(value.upper(), s), None
        if kind in ("name", "iri") and self.peek(1) == ("mark", "("):
            to = self.iri(self.next())
            self.expect("(")
            arg = self.expression(s)[0]
            self.expect(")")
            return cast_to(arg, to), None
        found = self.constant()
        if found is None:
            raise SparqlError(f"unexpected {value!r}")
        return term(*found), None

    def arguments(self, s: Solution) -> list[Column]:
        self.expect("(")
        out = []
        while not self.mark(")"):
            out.append(self.expression(s)[0])
            self.mark(",")
        return out

    def call(self, name: str, s: Solution) -> Column:
        if name not in FUNCTIONS:
            raise SparqlError(f"unknown function {name}")
        return FUNCTIONS[name](*self.arguments(s))

    def aggregate(self, name: str, s: Solution) -> Column:
        self.expect("(")
        distinct = self.word("DISTINCT")
        column = f"__a{len(self.pending)}"
        if self.mark("*"):
            self.expect(")")
            if distinct:
                self.pending.append(F.count_distinct(F.struct(*[F.col(f"`{v}`") for v in s.variables])).alias(column))
            else:
                self.pending.append(F.count(F.lit(1)).alias(column))
            return from_number(F.col(column), True)
        value = self.expression(s)[0]
        separator = " "
        if self.mark(";"):
            self.word("SEPARATOR")
            self.expect("=")
            separator = self.constant()[0]
        self.expect(")")
        if name == "COUNT":
            self.pending.append((F.count_distinct(value) if distinct else F.count(value)).alias(column))
            return from_number(F.col(column), True)
        if name == "SUM":
            n = number(value)
            self.pending.append(F.struct(F.coalesce((F.sum_distinct if distinct else F.sum)(n), F.lit(0.0)).alias("x"), F.coalesce(F.bool_and(integral(value)), F.lit(True)).alias("i")).alias(column))
            return from_number(F.col(column)["x"], F.col(column)["i"])
        if name == "AVG":
            self.pending.append(F.avg(number(value)).alias(column))
            return from_number(F.coalesce(F.col(column), F.lit(0.0)))
        if name in ("MIN", "MAX"):
            key = F.struct(number(value).alias("n"), value["v"].alias("t"), value.alias("x"))
            self.pending.append((F.min if name == "MIN" else F.max)(F.when(value.isNotNull(), key)).alias(column))
            return F.col(column)["x"]
        if name == "SAMPLE":
            self.pending.append(F.min(value).alias(column))
            return F.col(column)
        listed = F.collect_set(value["v"]) if distinct else F.collect_list(value["v"])
        self.pending.append(F.array_join(F.array_sort(listed), separator).alias(column))
        return term(F.col(column), "literal", XSD + "string")


_TERM = "struct<v:string,k:string,d:string,l:string>"


def integral(c: Column) -> Column:
    return c["d"].isin(*[x for x in NUMERIC if not x.endswith(("decimal", "double", "float"))])


def compared(a: Column, b: Column, op: str) -> Column:
    """Numbers by value, other literals by text, equality of all else by identity; null if either is unbound."""
    both = a["d"].isin(*NUMERIC) & b["d"].isin(*NUMERIC)
    x, y = number(a), number(b)
    if op in ("=", "!="):
        text = (a["v"] == b["v"]) & (a["k"] == b["k"]) & a["l"].eqNullSafe(b["l"])
        same = F.when(F.coalesce(both, F.lit(False)), x == y).otherwise(text)
        return same if op == "=" else ~same
    pick = {"<": lambda p, q: p < q, ">": lambda p, q: p > q, "<=": lambda p, q: p <= q, ">=": lambda p, q: p >= q}[op]
    return F.when(F.coalesce(both, F.lit(False)), pick(x, y)).otherwise(pick(a["v"], b["v"]))


def cast_to(c: Column, to: str) -> Column:
    if to in (XSD + "integer", XSD + "int", XSD + "long"):
        return from_number(F.floor(F.abs(number(c))) * F.signum(number(c)), True)
    if to in (XSD + "decimal", XSD + "double", XSD + "float"):
        return F.when(number(c).isNotNull(), term(number(c).cast("string"), "literal", to))
    return F.when(c.isNotNull(), term(c["v"], "literal", to))


def _text(v: Column) -> Column:
    return F.when(v.isNotNull(), term(v, "literal", XSD + "string"))


FUNCTIONS = {
    "STR": lambda x: _text(x["v"]),
    "LANG": lambda x: F.when(x["k"] == "literal", term(F.coalesce(x["l"], F.lit("")), "literal", XSD + "string")),
    "DATATYPE": lambda x: F.when(x["k"] == "literal", term(F.coalesce(x["d"], F.lit(XSD + "string")), "iri")),
    "BOUND": lambda x: from_bool(x.isNotNull()),
    "LCASE": lambda x: _text(F.lower(x["v"])),
    "UCASE": lambda x: _text(F.upper(x["v"])),
    "STRLEN": lambda x: from_number(F.char_length(x["v"]), True),
    "CONTAINS": lambda x, y: from_bool(F.contains(x["v"], y["v"])),
    "STRSTARTS": lambda x, y: from_bool(F.startswith(x["v"], y["v"])),
    "STRENDS": lambda x, y: from_bool(F.endswith(x["v"], y["v"])),
    "STRAFTER": lambda x, y: _text(F.when(F.contains(x["v"], y["v"]), F.substr(x["v"], F.instr(x["v"], y["v"]) + F.char_length(y["v"]))).otherwise("")),
    "STRBEFORE": lambda x, y: _text(F.when(F.contains(x["v"], y["v"]), F.substr(x["v"], F.lit(1), F.instr(x["v"], y["v"]) - 1)).otherwise("")),
    "SUBSTR": lambda x, start, n=None: _text(F.substr(x["v"], number(start).cast("int"), *([number(n).cast("int")] if n is not None else []))),
    "REPLACE": lambda x, y, z: _text(F.regexp_replace(x["v"], y["v"], z["v"])),
    "REGEX": lambda x, y, flags=None: from_bool(F.rlike(x["v"], F.concat(F.lit("(?i)"), y["v"]) if flags is not None else y["v"])),
    "CONCAT": lambda *xs: _text(F.concat(*[x["v"] for x in xs])),
    "IRI": lambda x: F.when(x.isNotNull(), term(x["v"], "iri")),
    "URI": lambda x: F.when(x.isNotNull(), term(x["v"], "iri")),
    "ISIRI": lambda x: from_bool(x["k"] == "iri"),
    "ISLITERAL": lambda x: from_bool(x["k"] == "literal"),
    "ISBLANK": lambda x: from_bool(x["k"] == "bnode"),
    "FLOOR": lambda x: from_number(F.floor(number(x)), True),
    "CEIL": lambda x: from_number(F.ceil(number(x)), True),
    "ROUND": lambda x: from_number(F.floor(number(x) + 0.5), True),
    "ABS": lambda x: from_number(F.abs(number(x)), integral(x)),
    "COALESCE": lambda *xs: F.coalesce(*xs),
    "IF": lambda c, x, y: F.when(truth(c), x).otherwise(y),
    "YEAR": lambda x: from_number(F.substr(x["v"], F.lit(1), F.lit(4)).try_cast("int"), True),
}


class Engine:
    """Queries over one table of triples; ``graph`` picks a named graph where the table has that column.

    Each pattern of a query reads the table, so give a stored one; ``Engine.stored`` writes what is still a plan.
    """

    @classmethod
    def stored(cls, data: DataFrame) -> Engine:
        return cls(written(data, f"{shared_dir(data.sparkSession, 'triples')}/triples"))

    def __init__(self, data: DataFrame):
        self.data, self.spark = data, data.sparkSession
        self._closures: dict[tuple, DataFrame] = {}

    def triples(self, graph: str | None = None) -> DataFrame:
        columns = ["s", "p", "o", "o_kind", "datatype", "lang"]
        if "graph" not in self.data.columns:
            return self.data.select(*columns)
        if graph is not None:
            return self.data.where(F.col("graph") == graph).select(*columns)
        return self.data.select(*columns).dropDuplicates()

    def closure(self, graph: str | None, predicate: str, start: str | None = None, end: str | None = None) -> DataFrame:
        """The pairs of a path, from ``start`` or to ``end`` alone if one is given: then only what it reaches is joined, not all pairs."""
        key = (graph, predicate, start, end)
        if key not in self._closures:
            edges = self.triples(graph).where((F.col("p") == predicate) & (F.col("o_kind") != "literal"))
            edges = edges.select(F.col("s").alias("a"), F.col("o").alias("b"))
            if start is None and end is None:
                pairs = transitive_closure(edges)
            else:
                one = self.spark.createDataFrame([(start if start is not None else end,)], "start string")
                way = ("a", "b") if start is not None else ("b", "a")
                pairs = reachable(edges, one, *way).select(F.col("start").alias(way[0]), F.col("node").alias(way[1]))
            none = F.lit(None).cast("string")
            kind = F.when(F.col("b").startswith("_:"), "bnode").otherwise("iri")
            self._closures[key] = pairs.select(F.col("a").alias("s"), F.lit(predicate).alias("p"), F.col("b").alias("o"), kind.alias("o_kind"), none.alias("datatype"), none.alias("lang"))
        return self._closures[key]

    def query(self, text: str) -> DataFrame | bool:
        """A DataFrame of lexical values, one column for each variable (null if unbound); a bool for ASK."""
        kind, solution = Query(self, text).parse()
        if kind == "ask":
            return not solution.frame.isEmpty()
        return solution.frame.select(*[F.col(f"`{v}`")["v"].alias(v) for v in solution.variables])

    def to_json_result(self, text: str, most: int = 10_000) -> dict:
        """{columns, rows, row_count}, or {error} for a query that can't be run or has more than ``most`` rows, which ``query`` gives as a DataFrame."""
        try:
            found = self.query(text)
            if isinstance(found, bool):
                return {"columns": ["ask"], "rows": [{"ask": found}], "row_count": 1}
            rows = [r.asDict() for r in found.limit(most + 1).collect()]
            if len(rows) > most:
                return {"error": f"more than {most} rows"}
            return {"columns": found.columns, "rows": rows, "row_count": len(rows)}
        except SparqlError as error:
            return {"error": str(error)}

    def summary(self) -> DataFrame:
        """(kind, name, n): triples, observations by dataset, and subjects by class."""
        t = self.triples()
        typed = t.where(F.col("p") == RDF + "type").groupBy(F.col("o").alias("name")).agg(F.count_distinct("s").alias("n")).select(F.lit("class").alias("kind"), "name", "n")
        sets = t.where(F.col("p").endswith("#dataSet")).groupBy(F.col("o").alias("name")).agg(F.count_distinct("s").alias("n")).select(F.lit("dataset").alias("kind"), "name", "n")
        whole = t.agg(F.count(F.lit(1)).alias("n")).select(F.lit("triples").alias("kind"), F.lit("all").alias("name"), "n")
        return whole.unionByName(sets).unionByName(typed)

    def schema_description(self) -> str:
        """The classes, and the predicates with how often they come, as text."""
        t = self.triples()
        classes = t.where(F.col("p") == RDF + "type").groupBy("o").agg(F.count_distinct("s").alias("n")).orderBy("o").collect()
        predicates = t.groupBy("p").agg(F.count(F.lit(1)).alias("n")).orderBy("p").collect()
        return "\n".join(["classes:", *(f"  {r.o} ({r.n})" for r in classes), "predicates:", *(f"  {r.p} ({r.n})" for r in predicates)])
