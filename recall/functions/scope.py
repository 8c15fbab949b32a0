"""Scopes: JSON objects of strings that name who a fact belongs to."""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def field(scope: Column, name: str) -> Column:
    """Scalar at ``$.name``; objects and arrays give null."""
    got = F.get_json_object(scope, f"$.{name}")
    return F.when(~got.startswith("{") & ~got.startswith("["), got)


def canonical(scope: Column) -> Column:
    """The same text for equal scopes, whatever the order of their keys."""
    entries = F.array_sort(F.map_entries(F.from_json(scope, "map<string,string>")))
    return F.to_json(F.map_from_entries(entries))


def exact(scope: Column, wanted: dict[str, str]) -> Column:
    """Whole-map equality."""
    text = json.dumps(dict(sorted(wanted.items())), separators=(",", ":"), ensure_ascii=False)
    return canonical(scope) == F.lit(text)


def includes(scope: Column, wanted: dict[str, str]) -> Column:
    """Every entry of ``wanted`` is in the scope; an empty one matches all."""
    return reduce(lambda a, b: a & b, (field(scope, k) == F.lit(v) for k, v in sorted(wanted.items())), F.lit(True))
