"""Decoding of HTML entities, the one text step without a built-in."""

from __future__ import annotations

import html

import pandas as pd
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import ArrayType, StringType


@pandas_udf(StringType())
def unescape(texts: pd.Series) -> pd.Series:
    """Arrow batches of short texts (titles, links, cells), never whole pages."""
    return texts.map(html.unescape, na_action="ignore")


@pandas_udf(ArrayType(StringType()))
def unescape_all(lists: pd.Series) -> pd.Series:
    return lists.map(lambda items: [None if t is None else html.unescape(t) for t in items], na_action="ignore")
