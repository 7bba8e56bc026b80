"""Text keys as column expressions."""

from __future__ import annotations

import re
import sys
import unicodedata
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

_QUOTES = {"’": "'", "‘": "'", "`": "'"}


@cache
def _folds(keep_other: bool) -> tuple[str, str, dict[str, str]]:
    """What compatibility decomposition and dropping marks do: pairs for translate, and characters that become several.

    Made from the Unicode database by rule. ``keep_other``: leave what has no ASCII form. Hangul syllables stay whole.
    """
    one_from, one_to, many = [], [], {}
    for x in range(0x80, min(sys.maxunicode, 0x1FFFF) + 1):
        c = chr(x)
        if 0xAC00 <= x <= 0xD7A3 or 0xD800 <= x <= 0xDFFF:
            continue
        plain = "".join(p for p in unicodedata.normalize("NFKD", c) if not unicodedata.combining(p))
        if not keep_other:
            plain = plain.encode("ascii", "ignore").decode()
        if plain == c or not plain:
            continue
        if len(plain) == 1:
            one_from.append(c)
            one_to.append(plain)
        else:
            many[c] = plain
    return "".join(one_from), "".join(one_to), many


def _class(characters: str) -> str:
    """The ranges of a character class; the Java regex engine tests one after another, so they are joined."""
    points, spans = sorted(map(ord, characters)), []
    for x in points:
        if spans and x == spans[-1][1] + 1:
            spans[-1][1] = x
        else:
            spans.append([x, x])
    return "".join(f"{chr(a)}-{chr(b)}" for a, b in spans)


def _folded(column: Column, keep_other: bool) -> Column:
    """One pass of translate; texts with a character that becomes several are taken apart there, others are not."""
    source, target, many = _folds(keep_other)
    several = _class("".join(many))
    early = _class("".join(chr(x) for x in [*range(0x250), *range(0x2000, 0x2070)] if chr(x) not in many))
    table = F.map_from_arrays(F.array(*map(F.lit, many)), F.array(*map(F.lit, many.values())))
    runs = F.regexp_extract_all(column, F.lit(f"[{several}]|[^{several}]+"), F.lit(0))
    apart = F.array_join(F.transform(runs, lambda x: F.coalesce(F.element_at(table, x), x)), "")
    some = column.rlike(f"[^{early}]") & column.rlike(f"[{several}]")  # Latin letters and punctuation take the first, short test
    out = F.translate(F.when(some, apart).otherwise(column), source, target)
    out = F.regexp_replace(out, r"\p{Mn}", "")
    return out if keep_other else F.regexp_replace(out, r"[^\x00-\x7F]", "")


def _ascii_or(column: Column, folded: Column) -> Column:
    """Plain ASCII needs no folding."""
    return F.when(F.octet_length(column) == F.char_length(column), column).otherwise(folded)


def squeeze(column: Column) -> Column:
    """Runs of white space become one space; none at the ends."""
    return F.trim(F.regexp_replace(column, r"(?U)\s+", " "))


def strip(column: Column) -> Column:
    return F.regexp_replace(column, r"(?U)^\s+|\s+$", "")


def strip_accents(column: Column) -> Column:
    """Decompose and keep ASCII only."""
    return _ascii_or(column, _folded(column, keep_other=False))


def normalize_text(column: Column) -> Column:
    """Key for joins: ASCII apostrophes, no accents, ASCII only, lower case, single spaces; empty is null."""
    quoted = F.translate(column, "".join(_QUOTES), "".join(_QUOTES.values()))
    return F.nullif(squeeze(F.lower(strip_accents(quoted))), F.lit(""))


def province_key(column: Column) -> Column:
    """Key of a place name: lower case, no accents, hyphens without spaces around them, single spaces."""
    low = F.lower(strip(column))
    bare = _ascii_or(low, _folded(low, keep_other=True))
    return squeeze(F.regexp_replace(bare, r"(?U)\s*-\s*", "-"))


def slugify(column: Column) -> Column:
    """URL-safe slug: white space, hyphens, slashes and apostrophes become hyphens, other characters go."""
    low = F.lower(column)
    bare = _ascii_or(low, _folded(low, keep_other=True))
    hyphens = F.regexp_replace(bare, r"(?U)[\s\-/'’]+", "-")
    clean = F.regexp_replace(F.regexp_replace(hyphens, "[^a-z0-9-]", ""), "-+", "-")
    return F.regexp_replace(clean, "^-+|-+$", "")


def snake_case(name: str) -> str:
    """snake_case of a column name; acronyms stay joined."""
    split = re.sub(r"(?<=[a-z0-9])(?=[A-Z])", "_", name)
    return re.sub(r"[^a-z0-9]+", "_", split.lower()).strip("_")


def is_snake_case(name: str) -> bool:
    return re.fullmatch(r"[a-z0-9]+(_[a-z0-9]+)*", name) is not None


def snake_case_column(column: Column) -> Column:
    split = F.regexp_replace(column, r"(?<=[a-z0-9])(?=[A-Z])", "_")
    return F.regexp_replace(F.regexp_replace(F.lower(split), "[^a-z0-9]+", "_"), "^_+|_+$", "")


def last_segment(uri: Column) -> Column:
    return F.substring_index(uri, "/", -1)


def title_case(column: Column) -> Column:
    """Upper case after any non-letter, lower case elsewhere."""
    words = F.regexp_extract_all(strip(column), F.lit(r"([\p{L}]+|[^\p{L}]+)"))
    return F.array_join(F.transform(words, lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.lower(F.substring(w, 2, 1 << 30)))), "")
