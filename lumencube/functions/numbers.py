"""Numbers and dates in local notations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import strip

#: Cells that mean "no number".
NO_NUMBER = ("-", "", "n.d.", "n/a")

_NUMBER = r"(?i)^[+-]?((\d+(\.\d*)?|\.\d+)(e[+-]?\d+)?|inf(inity)?)$"

#: strftime fields and the patterns of Spark.
FIELDS = {"d": "dd", "m": "MM", "Y": "yyyy", "y": "yy", "H": "HH", "I": "hh", "M": "mm", "S": "ss", "f": "SSSSSS", "p": "a", "b": "MMM", "B": "MMMM", "j": "DDD", "%": "%"}


def to_number(column: Column) -> Column:
    """double of decimal text; anything else, NaN too, is null."""
    bare = strip(column.cast("string"))
    return F.when(bare.rlike(_NUMBER), bare.try_cast("double"))


def italian_number(column: Column, na_values: Sequence[str] = NO_NUMBER) -> Column:
    """double of text with dots between thousands and a decimal comma; sentinels and other text are null."""
    bare = strip(column)
    plain = F.replace(F.replace(bare, F.lit("."), F.lit("")), F.lit(","), F.lit("."))
    return F.when(~bare.isin(*na_values), to_number(plain))


def start_year(label: Column) -> Column:
    """The first year 19xx or 20xx in a label; totals have none."""
    year = F.regexp_extract(label, r"((?:19|20)\d{2})", 1)
    return F.when(~strip(label).isin("Totale"), F.nullif(year, F.lit("")).try_cast("int"))


def java_pattern(strftime: str) -> str:
    """Spark's date pattern for a strftime format; ValueError for fields it lacks."""
    out, k = "", 0
    while k < len(strftime):
        c = strftime[k]
        if c == "%":
            k += 1
            if k == len(strftime) or strftime[k] not in FIELDS:
                raise ValueError(f"unknown field in {strftime!r}")
            out += FIELDS[strftime[k]]
        else:
            out += f"'{c}'" if c.isalpha() else "''" if c == "'" else c
        k += 1
    return out
