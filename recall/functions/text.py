"""Text expressions with the exact semantics that keys and filters need."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: The characters that Python's str.strip removes.
WHITESPACE = "".join(c for c in map(chr, range(0x3001)) if c.isspace())
KEY_CHARS = 500


def strip(c: Column) -> Column:
    """Without Unicode white space at both ends."""
    return F.btrim(c, F.lit(WHITESPACE))


def head(c: Column, n: int) -> Column:
    return F.substring(c, 1, n)


def dedupe_key(c: Column) -> Column:
    """Key that facts are compared by: the first 500 characters, lower-cased, then stripped."""
    return strip(F.lower(head(c, KEY_CHARS)))


def first_truthy(*columns: Column) -> Column:
    """The first value that is neither null nor empty; else null."""
    return F.coalesce(*(F.nullif(c, F.lit("")) for c in columns))


def without_front_matter(c: Column) -> Column:
    """Without a leading ``---`` block: opened by ``---`` and a line feed, closed by the first line feed and ``---`` after it."""
    end = F.locate("\n---", c, 5)
    return F.when(c.startswith("---\n") & (end > 0), F.ltrim(F.substr(c, end + 4), F.lit("\n"))).otherwise(c)


def last_segment(c: Column, by: str = "/") -> Column:
    return F.element_at(F.split(c, by), -1)


def has_marker(path: Column, markers: tuple[str, ...]) -> Column:
    """Whether one of the directories ``markers`` is a component of ``path``."""
    out = F.lit(False)
    for m in markers:
        out = out | path.contains(f"/{m}/") | path.endswith(f"/{m}")
    return out


def decode_ignoring(raw: Column) -> Column:
    """UTF-8 text of binary ``raw`` without its invalid bytes; whole batches at a time, as no built-in drops them."""
    @F.pandas_udf("string")
    def decode(values: pd.Series) -> pd.Series:
        return values.map(lambda b: None if b is None else bytes(b).decode("utf-8", "ignore"))

    return decode(raw)
