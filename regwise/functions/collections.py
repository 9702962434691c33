"""Array, map and JSON helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def counted(pairs: Column, k: int | None = None, sep: str = " / ", form: str = "%s:%d") -> Column:
    """Text of ``array<struct<key,n>>``: largest counts first, ties by key."""
    order = lambda a, b: (F.when(a["n"] > b["n"], -1).when(a["n"] < b["n"], 1)
                          .when(a["key"] < b["key"], -1).when(a["key"] > b["key"], 1).otherwise(0))
    ranked = F.array_sort(pairs, order)
    if k is not None:
        ranked = F.slice(ranked, 1, k)
    return F.array_join(F.transform(ranked, lambda p: F.format_string(form, p["key"], p["n"])), sep)


def map_text(histogram: Column, k: int | None = None) -> Column:
    """Histogram map as ``key:n / key:n``."""
    pairs = F.transform(F.map_entries(histogram),
                        lambda e: F.struct(e["key"].alias("key"), e["value"].alias("n")))
    return counted(pairs, k)


def jsonp_body(text: Column, callback: str = "cb") -> Column:
    """JSON inside a JSONP answer, null when the wrapper is missing."""
    return F.nullif(F.regexp_extract(text, r"(?s)\b" + callback + r"\((.*)\)\s*;?\s*$", 1), F.lit(""))


def script_object(text: Column, name: str) -> Column:
    """Object literal assigned to a variable of an inline script."""
    return F.nullif(F.regexp_extract(text, r"var " + name + r"\s*=\s*(\{.*?\})", 1), F.lit(""))


def item(values: Column, i: int) -> Column:
    """The i-th cell of a ragged row, blank when the row is shorter."""
    return F.coalesce(F.get(values, F.lit(i)), F.lit(""))
