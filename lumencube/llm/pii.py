"""Personal data by anchor expansion.

One Aho-Corasick pass over a text's bytes finds anchors: at-signs, plus signs, digits, schemes and
identifier cues. A deterministic local parser expands each anchor to its span and validates it, so
the work is one pass and a few steps for each anchor. A parser never enters text that an earlier
span of its kind took, so spans of a kind don't overlap and are the leftmost ones.

Kinds with a fixed definition (see PATTERNS) come first: email, ip, card, phone. The method adds:
``url`` (a scheme with user:password@), ``iban`` (mod-97 valid), ``ssn`` and ``account`` (numbers
that follow their cue).
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mapped, slices, text_bytes
from .spans import code_points

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "url", "iban", "ssn", "account")

_DOMAIN = re.compile(rb"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOTTED = re.compile(rb"[0-9]+(?:\.[0-9]+)*")
_CARD = re.compile(rb"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(rb"\+[0-9][ ().0-9-]+[0-9]")
_USERINFO = re.compile(rb"://[^\s/@:]+:[^\s/@]+@[A-Za-z0-9.-]+")
_IBAN = re.compile(rb"[ :#=]*([A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30})(?![A-Za-z0-9])")
_SSN = re.compile(rb"[a-z. ]{0,12}[ :#=]*([0-9]{3}-[0-9]{2}-[0-9]{4})(?![0-9-])", re.IGNORECASE)
_ACCOUNT = re.compile(rb"(?:[ _-]?(?:number|no\.?|nr\.?|id))?[ :#=]+([0-9]{6,17})(?![0-9])", re.IGNORECASE)

#: What the automaton looks for, and the parser each anchor wakes.
ANCHORS = {"@": "at", "+": "plus", "://": "scheme", "iban": "iban", "ssn": "ssn", "social security": "ssn", "account": "account", "acct": "account", **{str(d): "digit" for d in range(10)}}


def _automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for word, kind in ANCHORS.items():
        found.add_word(word, (kind, len(word)))
    found.make_automaton()
    return found


def luhn(digits: bytes) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        x = d - 48
        total += x if k % 2 == 0 else x * 2 - 9 * (x > 4)
    return total % 10 == 0


def iban_valid(value: bytes) -> bool:
    text = value.replace(b" ", b"").decode()
    return int("".join(str(int(c, 36)) for c in text[4:] + text[:4])) % 97 == 1


def find(raw: bytes, automaton: ahocorasick.Automaton) -> list[tuple[str, int, int]]:
    """Spans (kind, first byte, end byte) of one UTF-8 text."""
    out: list[tuple[str, int, int]] = []
    email_end = dotted_end = card_end = iban_end = ssn_end = account_end = url_end = 0
    for last, (kind, n) in automaton.iter(raw.lower().decode("latin-1")):
        at = last - n + 1
        if kind == "digit":
            if at >= dotted_end:
                dotted_end = _DOTTED.match(raw, at).end()
                parts = raw[at:dotted_end].split(b".")
                if len(parts) > 3:
                    begin = at
                    for k in range(0, len(parts) - 3, 4):
                        end = begin + sum(map(len, parts[k : k + 4])) + 3
                        if all(len(x.lstrip(b"0")) < 4 and int(x.lstrip(b"0") or b"0") < 256 for x in parts[k : k + 4]):
                            out.append(("ip", begin, end))
                        begin = end + 1
            if at >= card_end:
                m = _CARD.match(raw, at)
                card_end = m.end() if m else at + 1
                if m and 16 <= len(digits := m[0].translate(None, b" -")) <= 19 and luhn(digits):
                    out.append(("card", at, card_end))
        elif kind == "at":
            begin = at
            while begin > email_end and raw[begin - 1] in _LOCAL:
                begin -= 1
            if begin < at and (m := _DOMAIN.match(raw, at)):
                email_end = m.end()
                out.append(("email", begin, email_end))
        elif kind == "plus":
            if (m := _PHONE.match(raw, at)) and 8 <= sum(48 <= x < 58 for x in m[0]) <= 15:
                out.append(("phone", at, m.end()))
        elif kind == "scheme":
            begin = at
            while begin > url_end and raw[begin - 1 : begin].isalpha():
                begin -= 1
            if begin < at and (m := _USERINFO.match(raw, at)):
                url_end = m.end()
                out.append(("url", begin, url_end))
        elif kind == "iban":
            if at >= iban_end and (m := _IBAN.match(raw, last + 1)) and iban_valid(m[1]):
                iban_end = m.end()
                out.append(("iban", *m.span(1)))
        elif kind == "ssn":
            if at >= ssn_end and (m := _SSN.match(raw, last + 1)) and m[1][:3] not in (b"000", b"666") and m[1][:1] != b"9" and m[1][4:6] != b"00" and m[1][7:] != b"0000":
                ssn_end = m.end()
                out.append(("ssn", *m.span(1)))
        elif at >= account_end and (m := _ACCOUNT.match(raw, last + 1)):
            account_end = m.end()
            out.append(("account", *m.span(1)))
    return out


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Find personal data in every whole text.

    One row for each input row: doc_id, spans array<struct<kind, start, end, text>> in code points,
    ordered by kind as in KINDS, then start. Null and empty texts have no spans; a null id stays;
    repeated rows stay; other columns are not read; an empty table gives an empty result.
    """
    kinds = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("text", pa.string())]))
    order = {k: i for i, k in enumerate(KINDS)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = _automaton()
        for batch in slices(batches):
            rows = []
            for raw in text_bytes(batch.column(1)):
                found = sorted(find(raw, automaton), key=lambda x: (order[x[0]], x[1])) if raw else []
                points = code_points(raw, found) if found else []
                rows.append([{"kind": k, "start": s, "end": e, "text": raw[b:c].decode()} for (k, s, e), (_, b, c) in zip(points, found, strict=True)])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, kinds)], names=["doc_id", "spans"])

    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return mapped(source, run, "doc_id long, spans array<struct<kind:string,start:long,end:long,text:string>>")


def digest(found: DataFrame, kinds: tuple[str, ...] = BASE) -> DataFrame:
    """Counts of each base kind, the SHA-256 of the base spans and all spans as text."""
    text = F.transform("spans", lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"]))
    base = F.transform(F.filter("spans", lambda x: x["kind"].isin(*kinds)), lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"]))
    counts = [F.size(F.filter(F.col("spans.kind"), _same(k))).cast("long").alias(f"n_{k}") for k in kinds]
    return found.select("doc_id", *counts, F.sha2(F.array_join(base, ","), 256).alias("base_sha256"), F.array_join(text, ",").alias("spans"))


def _same(kind: str):
    return lambda x: x == kind
