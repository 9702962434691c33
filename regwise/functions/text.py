"""String clean-up of agency names, titles and cells."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from regwise import rules as R


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, also inside array lambdas."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def strip(c: Column) -> Column:
    """Trim all Unicode white space (``trim`` would leave U+3000)."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def blank_as_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def first_filled(*cols: Column) -> Column:
    """First value that is neither null nor blank, else blank."""
    return F.coalesce(*[blank_as_null(c) for c in cols], F.lit(""))


def core(place: Column) -> Column:
    """Place name without its administrative suffix."""
    return F.regexp_replace(F.coalesce(place, F.lit("")), R.PLACE_SUFFIX, "")


def normalize(unit: Column) -> Column:
    """Agency name without leading date and trailing section or window."""
    undated = F.regexp_replace(strip(F.coalesce(unit, F.lit(""))), R.DATE_PREFIX, "")
    return F.regexp_replace(strip(undated), R.SECTION, "")


def half_width_brackets(c: Column) -> Column:
    return F.translate(c, "（）", "()")


def split_units(c: Column) -> Column:
    """Parts of a combined cell, trimmed, blanks removed."""
    parts = F.transform(F.split(F.coalesce(c, F.lit("")), R.UNIT_SPLIT), strip)
    return F.filter(parts, lambda p: p != "")


def clean_title(title: Column) -> Column:
    return strip(F.regexp_replace(F.coalesce(title, F.lit("")), "(?U)" + R.TITLE_PREFIX, ""))


def split_badges(name: Column) -> Column:
    """Names listed in the closing bracket, joined with the variant separator."""
    inner = F.regexp_extract(name, r"(?U)[(（]([^()（）]+)[)）]\s*$", 1)
    parts = F.filter(F.transform(F.split(inner, "[、,，]"), strip), lambda p: p != "")
    return F.array_join(parts, R.VARIANT_SEP)


def strip_annotation(org: Column, words=R.ANNOTATION_WORDS) -> Column:
    """Drop a closing bracket that holds an annotation, keep other brackets."""
    pattern = r"[（(](?=[^）)]*(?:" + "|".join(words) + r"))[^）)]*[）)]\s*$"
    return F.regexp_replace(F.regexp_replace(org, pattern, ""), r"(?U)^[\s【】]+|[\s【】]+$", "")


def squash(c: Column, to: str = " ") -> Column:
    """Runs of white space become ``to``."""
    return F.regexp_replace(c, r"(?U)\s+", to)


def sanitize_cell(c: Column) -> Column:
    """Text that is safe inside a tab-separated line."""
    return F.translate(c, "\t\n", "  ")


def notice_date(title: Column) -> Column:
    return F.regexp_extract(title, R.NOTICE_DATE, 0)


def notice_date_value(title: Column) -> Column:
    """The date written in a title, null when there is none or it does not exist."""
    parts = [F.regexp_extract(title, R.NOTICE_DATE, i) for i in (1, 2, 3)]
    return F.try_to_date(F.nullif(F.concat_ws("-", *parts), F.lit("--")), "yyyy-M-d")


def variants_of(joined: Column) -> Column:
    """The list behind a `` / ``-joined cell."""
    return F.filter(F.transform(F.split(F.coalesce(joined, F.lit("")), " / "), strip), lambda v: v != "")


def function_key(city: Column, area: Column, function: Column) -> Column:
    return F.concat_ws("|", city, area, function)


def padded_id(prefix: Column, number: Column, width: int) -> Column:
    """Prefix plus the zero-padded number; longer numbers keep all digits."""
    digits = number.cast("string")
    return F.concat(prefix, F.when(F.length(digits) >= width, digits).otherwise(F.lpad(digits, width, "0")))


def percent(part: Column, whole: Column, digits: int = 1) -> Column:
    """``part / whole`` in percent; 0 over nothing is 0."""
    share = F.try_divide(part * F.lit(100.0), whole)
    return F.coalesce(F.round(share, digits), F.lit(0.0))
