"""Secret scan: fixed patterns, and guess-cost dynamic programming over values in credential contexts.

A value is cut into common words (those of WORDS, and the whole words of the tokenizer's vocabulary,
which is roughly in order of frequency), dates, repeats, keyboard walks, sequences, separators and brute-force characters so
that the total log10 of guesses is least. A word that stands alone between separators is a piece of a name, a path or a call
(``process.env.TOKEN``, ``your_api_key_here``), of which few are in use, and costs no more than that. Values that stay costly, or wherever a
context names a credential that the fixed patterns miss, become ``guess`` spans, one for each value; cheap ones (placeholders, names, words,
dates) do not.
"""

from __future__ import annotations

import json
import math
import re
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mapped, slices, text_bytes
from .pii import digest as _digest
from .spans import code_points
from .tokens import default_vocabulary

BASE = ("assign", "access", "hex")
KINDS = (*BASE, "guess")

# The patterns whose spans the result must hold.
ASSIGN = re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE)
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
HEX = re.compile(rb"[0-9a-f]{24,}")

#: Names that make what follows a credential; wider than ASSIGN's. A match ends where the value begins,
#: so that a value which is a name itself ("Authorization: Bearer ...") is read as a name next.
CONTEXT = re.compile(
    rb"""(?:password|passwd|passphrase|pwd|passcode|credentials?|secret|token|api[_ -]?key|access[_ -]?key|private[_ -]?key|client[_ -]?secret|auth(?:orization)?|bearer)["']?(?:\x20*(?:[:=]|\bis\b(?:\x20*[:=])?)\x20*|\x20+)(?:basic\x20+)?["']?(?=[^\s"'<>,;]{6})""",
    re.IGNORECASE,
)
_END = re.compile(rb"""[\s"'<>,;]|\Z""")
#: A cheap test that no text with a context fails.
HINT = re.compile(rb"pass|pwd|cred|secret|token|key|auth|bearer", re.IGNORECASE)

#: Common passwords and placeholders, most common first; the rank is the cost.
WORDS = (
    "password 123456 12345678 qwerty letmein welcome admin login master dragon monkey football baseball shadow sunshine princess iloveyou "
    "trustno1 superman batman secret changeme default example test sample guest root user hello freedom whatever computer internet "
    "summer winter spring autumn monday friday january december love money test123 temp token key pass access public private value none null "
    "true false your here string placeholder redacted hidden masked xxx todo the and for with this that from have not are you all can "
    "api env get set var arg cfg config process getpass self str int http https url uuid hash auth oauth jwt ssh rsa aws gcp sdk cli app svc dev prod staging based bearer client server "
    "value values credential credentials passphrase passwd required missing expired invalid removed rotated environ embedding embeddings tokenizer configs param params args kwargs payload"
).split()
#: The rows of the keyboard.
ROWS = ("`1234567890-=", "qwertyuiop[]\\", "asdfghjkl;'", "zxcvbnm,./")
#: Characters that often stand for letters.
SWAPS = str.maketrans("@4831!05$7", "aabeliosst")

_DATE = re.compile(r"(?:19|20)\d\d(?:([-/.]?)(?:0[1-9]|1[0-2])\1(?:0[1-9]|[12]\d|3[01]))?|(?:0[1-9]|[12]\d|3[01])([-/.]?)(?:0[1-9]|1[0-2])\2(?:19|20)\d\d")
_RANK = {w: math.log10(k + 2) for k, w in reversed([*enumerate(WORDS)])}
#: What separates the pieces of names, and its cost; the most that a known word costs as such a piece.
SEPARATORS, SEPARATOR, PIECE = frozenset("-_./:()[]{}"), 0.4, 1.2
#: Shorter runs and repeats than the longest are tried up to this length, or so many times.
SHORTER = 16
#: Letters of the shortest word taken from the vocabulary; shorter ones would be found in random letters.
LEAST_WORD = 4


@cache
def ranks() -> tuple[dict[str, float], int]:
    """log10 of each known word's rank, and the longest word's length; read once for each Python worker."""
    with open(default_vocabulary(), encoding="utf-8") as f:
        vocabulary = json.load(f)["model"]["vocab"]
    out = dict(_RANK)
    for token, k in sorted(vocabulary.items(), key=lambda x: x[1]):
        word = token[1:].lower()
        if token[0] == "Ġ" and len(word) >= LEAST_WORD and word.isascii() and word.isalpha():
            out.setdefault(word, math.log10(k + 2))
    return out, max(map(len, out))


def _adjacent() -> dict[str, str]:
    near: dict[str, set] = {}
    for y, row in enumerate(ROWS):
        for x, c in enumerate(row):
            for yy, xx in ((y, x + 1), (y + 1, x), (y + 1, x - 1)):
                if yy < len(ROWS) and 0 <= xx < len(ROWS[yy]):
                    near.setdefault(c, set()).add(ROWS[yy][xx])
                    near.setdefault(ROWS[yy][xx], set()).add(c)
    return {c: "".join(sorted(x)) for c, x in near.items()}


NEAR = _adjacent()
SEGMENT = math.log10(2)


def _run_ends(text: str, holds) -> list[int]:
    """For each place, where the run of neighbouring pairs that starts there ends."""
    ends = list(range(1, len(text) + 1))
    for k in range(len(text) - 2, -1, -1):
        if holds(text[k], text[k + 1]):
            ends[k] = ends[k + 1]
    return ends


def _same_for(text: str, shift: int) -> list[int]:
    """For each place, how many characters from there on equal those ``shift`` later."""
    out = [0] * (len(text) + 1)
    for k in range(len(text) - shift - 1, -1, -1):
        out[k] = out[k + 1] + 1 if text[k] == text[k + shift] else 0
    return out


def _brute(value: str) -> float:
    """log10 of the guesses for each character of ``value`` by brute force."""
    charset = sum(k for k, test in ((26, str.islower), (26, str.isupper), (10, str.isdigit)) if any(map(test, value))) + (20 if not value.isalnum() else 0)
    return math.log10(max(charset, 10))


def _tail_costs(value: str, brute: float) -> list[float]:
    """For each place, log10 of the guesses that the cheapest segmentation of a value that begins there needs; linear in the length."""
    low = value.lower()
    plain = low.translate(SWAPS)
    n = len(value)
    known, longest = ranks()
    walks = _run_ends(low, lambda a, b: b in NEAR.get(a, ""))
    same = _run_ends(low, lambda a, b: a == b)
    up = _run_ends(low, lambda a, b: ord(b) - ord(a) == 1)
    down = _run_ends(low, lambda a, b: ord(a) - ord(b) == 1)
    again = {size: _same_for(low, size) for size in range(2, min(16, n // 2) + 1)}
    alone = [True, *(c in SEPARATORS for c in value), True]  # of place k, whether k - 1 is a separator or none
    best, first = [0.0] * (n + 1), [0.0] * (n + 1)  # from each place on within the value, and if it began there
    for i in range(n - 1, -1, -1):
        begun = math.inf
        cost = (SEPARATOR if value[i] in SEPARATORS else brute) + best[i + 1]
        for form, extra in ((low, 0.0), (plain, 0.5)):
            for size in range(2, min(longest, n - i) + 1):
                rank = known.get(form[i : i + size])
                if rank is not None:
                    more = SEGMENT + extra + best[i + size] + (0.3 if value[i : i + size] != low[i : i + size] else 0.0)
                    piece = min(rank, PIECE) if alone[i + size + 1] else rank
                    begun = min(begun, piece + more)
                    cost = min(cost, (piece if alone[i] else rank) + more)
        if (m := _DATE.match(value, i)) is not None:
            cost = min(cost, SEGMENT + (2.1 if m.end() - i == 4 else 4.6) + best[m.end()])
        for ends, pattern in ((walks, 2.0), (same, 1.0), (up, 1.2), (down, 1.5)):
            if ends[i] - i > 2:
                for end in {*range(i + 3, min(ends[i], i + SHORTER) + 1), ends[i]}:
                    cost = min(cost, SEGMENT + pattern + math.log10(end - i) * (3 if ends is walks else 1) + best[end])
        for size, same_for in again.items():  # a block said again
            if same_for[i] >= size:
                most = 1 + same_for[i] // size
                for times in {*range(2, min(most, SHORTER) + 1), most}:
                    cost = min(cost, SEGMENT + size * brute + math.log10(times) + best[i + times * size])
        best[i], first[i] = cost, min(cost, begun)
    return first


def guess_cost(value: str) -> float:
    """log10 of the guesses that the cheapest segmentation of ``value`` needs; linear in its length."""
    return _tail_costs(value, _brute(value))[0]


def _costs(value: str, places: list[int]) -> list[float]:
    """The guess cost of ``value`` from each of the ascending places on: few passes, as a brute-force cost holds for many."""
    out, brutes, passes = [], _brutes(value), {}
    for k in places:
        begin, tail = passes.setdefault(brutes[k], (k, None))
        if tail is None:
            passes[brutes[k]] = begin, tail = k, _tail_costs(value[k:], brutes[k])
        out.append(tail[k - begin])
    return out


def _brutes(value: str) -> list[float]:
    """``_brute`` of what follows each place."""
    out, classes = [1.0] * (len(value) + 1), set()
    for k in range(len(value) - 1, -1, -1):
        c = value[k]
        mine = {size for size, test in (("lower", c.islower()), ("upper", c.isupper()), ("digit", c.isdigit()), ("other", not c.isalnum())) if test}
        out[k] = out[k + 1] if mine <= classes else _brute(value[k:])
        classes |= mine
    return out


def find(raw: bytes, least_cost: float = 9.0) -> list[tuple[str, int, int]]:
    """Spans (kind, first byte, end byte) of one UTF-8 text, by start, then kind as in KINDS."""
    out = [("access", *m.span()) for m in ACCESS.finditer(raw) if m.end() - m.start() >= 20]
    out += [("hex", *m.span()) for m in HEX.finditer(raw)]
    if HINT.search(raw):
        ends: dict[int, int] = {}  # where a value begins, and the furthest place where it may end
        for m in ASSIGN.finditer(raw):
            if m.end(2) - m.start(2) >= 6:
                out.append(("assign", *m.span()))
                ends[m.start(2)] = m.end(2)
        end = 0
        for m in CONTEXT.finditer(raw):
            if m.end() >= end:
                end = _END.search(raw, m.end()).start()
            ends[m.end()] = max(end, ends.get(m.end(), 0))
        values: dict[int, list[int]] = {}
        for start in sorted(ends):
            values.setdefault(ends[start], []).append(start)
        for e, starts in values.items():
            text = raw[starts[0] : e].decode(errors="replace").rstrip(".,;:!?)")
            places, at = [0], 0
            for s, t in zip(starts, starts[1:], strict=False):
                at += len(raw[s:t].decode(errors="replace"))
                places.append(min(at, len(text)))
            costly = [s for s, cost in zip(starts, _costs(text, places), strict=True) if cost >= least_cost]
            if costly:  # a value that begins with a cue holds the value after it
                out.append(("guess", costly[-1], e))
    out.sort(key=lambda x: (x[1], KINDS.index(x[0]), x[2]))
    return out


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_cost: float = 9.0) -> DataFrame:
    """Find secrets in every whole text.

    One row for each input row: doc_id, spans array<struct<kind, start, end, text>> in code points by
    start, then kind as in KINDS. ``least_cost`` is the log10 of guesses from which a value in a
    credential context is a secret. Null and empty texts have no spans; a null id stays; repeated
    rows stay; other columns are not read; an empty table gives an empty result.
    """
    kinds = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("text", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = []
            for raw in text_bytes(batch.column(1)):
                found = find(raw, least_cost) if raw else []
                points = code_points(raw, found) if found else []
                rows.append([{"kind": k, "start": s, "end": e, "text": raw[b:c].decode()} for (k, s, e), (_, b, c) in zip(points, found, strict=True)])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, kinds)], names=["doc_id", "spans"])

    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return mapped(source, run, "doc_id long, spans array<struct<kind:string,start:long,end:long,text:string>>")


def digest(found: DataFrame) -> DataFrame:
    return _digest(found, BASE)
