"""Text conventions that the semantics rest on: white space and word boundaries as browsers define them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space beyond Java's `\s`: no-break and typographic spaces, line separators, byte order mark.
SPACE = r"\t\n\x0B\f\r\x20   -     　﻿"
S = f"[{SPACE}]"
#: ASCII word boundaries.
LEFT, RIGHT = "(?<![A-Za-z0-9_])", "(?![A-Za-z0-9_])"


def let(value: Column, f: Callable[[Column], Column]) -> Column:
    """f of a value that is worked out once for each row. A Python variable that holds a column is written out wherever it stands; inside lambdas and
    conditions Spark works it out each time, and nested ones multiply."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def trim(c: Column) -> Column:
    """Both ends without white space of any kind."""
    return F.regexp_replace(c, rf"\A{S}+|{S}+\z", "")


def squeeze(c: Column) -> Column:
    """Runs of white space as one space."""
    return F.regexp_replace(c, f"{S}+", " ")


def null_if_empty(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def group(c: Column, pattern: str, i: int = 1) -> Column:
    """A group of the first match; null where there is no match or the group is empty."""
    return let(F.regexp_extract(c, pattern, i), null_if_empty)


def first_not_null(values: Column) -> Column:
    return F.get(F.filter(values, lambda x: x.isNotNull()), F.lit(0))


def starts_with_any(c: Column, values) -> Column:
    out = F.lit(False)
    for v in values:
        out = out | c.startswith(v)
    return out


def contains_any(c: Column, values) -> Column:
    out = F.lit(False)
    for v in values:
        out = out | c.contains(v)
    return out
