"""Licence scans: texts are normalised, digested and joined to the digests of known licence texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from regwise.llm import known_licences
from regwise.llm.common import Cut
from regwise.session import small

# Spellings that count as equal, from the public matching guidelines for licence texts (after
# lower-casing and with punctuation as spaces).
EQUIVALENT = {
    "acknowledgement": "acknowledgment", "analogue": "analog", "analyse": "analyze", "artefact": "artifact", "authorisation": "authorization",
    "authorised": "authorized", "calibre": "caliber", "cancelled": "canceled", "capitalisations": "capitalizations", "catalogue": "catalog",
    "categorise": "categorize", "centre": "center", "emphasised": "emphasized", "favour": "favor", "fulfil ": "fulfill ", "fulfilment": "fulfillment",
    "initialise": "initialize", "judgement": "judgment", "labelling": "labeling", "labour": "labor", "licence": "license", "maximise": "maximize",
    "modelled": "modeled", "modelling": "modeling", "offence": "offense", "optimise": "optimize", "organisation": "organization", "organise": "organize",
    "practise": "practice", "programme": "program", "realise": "realize", "recognise": "recognize", "signalling": "signaling", "sub license": "sublicense",
    "sub licence": "sublicense", "utilisation": "utilization", "whilst": "while", "wilful": "willful", "non commercial": "noncommercial",
    "per cent": "percent", "copyright owner": "copyright holder", "http ": "https ",
}
# a notice names a year or a sign; the word alone also begins lines of wrapped terms
COPYRIGHT_LINE = r"(?m)^[^a-z0-9\n]*(?:copyright[ \t:]*(?:\(c\)|©|[0-9\[{<])|\(c\)[ \t]*[0-9\[{<]|©|all rights reserved[^a-z0-9\n]*$)[^\n]*$"
NOT_WORD = r"[^\p{L}\p{N}]+"


def _spelled(words: Column, pairs: dict[str, str]) -> Column:
    words = F.concat(F.lit(" "), words, F.lit(" "))
    for other, form in pairs.items():
        words = F.replace(words, F.lit(other), F.lit(form))
    return F.trim(words)


def normal_lines(text: Column) -> Column:
    """The lines of a text in lower case, punctuation as single spaces, equivalent spellings as one; copyright and empty lines go."""
    line = lambda x: _spelled(F.regexp_replace(F.regexp_replace(x, COPYRIGHT_LINE, ""), NOT_WORD, " "), EQUIVALENT)
    return F.filter(F.transform(F.split(F.lower(text), "\n"), line), lambda x: x != "")


def joined(lines: Column) -> Column:
    """A text of normal lines; spellings of several words may span two of them."""
    return _spelled(F.array_join(lines, " "), {k: v for k, v in EQUIVALENT.items() if " " in k.strip()})


def known_texts(spark: SparkSession) -> DataFrame:
    """``licence, text, digest``: the wordings of ``known_licences``, and the digests of those too long to be listed."""
    rows = [(i, t, None) for i, t in known_licences.texts()] + [(i, None, d) for i, ds in known_licences.DIGESTS.items() for d in ds]
    return spark.createDataFrame(rows, "licence string, text string, digest string")


def digest_of(text: Column) -> Column:
    """The digest of a whole text's normal form; null where nothing is left of it."""
    return F.when(joined(normal_lines(text)) != "", F.sha2(joined(normal_lines(text)), 256))


def scan(docs: DataFrame, known: DataFrame) -> DataFrame:
    """``doc_id, digest, licence, lines``: which known licence a text is, and which ones its lines are.

    Whole texts and whole lines are digested after normalising and joined to
    the digests of ``known (licence, text)``, which may also give them as they
    are (``digest``); nothing is matched in part.
    ``licence`` is null where the whole text is no known one; ``lines`` holds
    the licences of the text's lines, each once, sorted. Of several names for
    one digest the smallest counts. Texts that normalise to nothing match
    nothing; a null text is empty; rows of one doc_id share their ``lines``; a
    null doc_id is an id like any other; other columns are not read.
    The known digests are broadcast only below a checked number.
    """
    given = F.col("digest") if "digest" in known.columns else F.lit(None).cast("string")
    sheet = known.select("licence", F.coalesce(given, digest_of(F.col("text"))).alias("known")).where("known IS NOT NULL")
    sheet = small(sheet.groupBy("known").agg(F.min("licence").alias("licence")))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    # the normal lines are made once, behind a generator, for the text's own digest and for theirs
    read = rows.select("doc_id", F.inline(F.array(F.struct(normal_lines(F.col("text")).alias("lines")))))
    unit = lambda text, whole: F.struct(F.lit(whole).alias("whole"), F.sha2(text, 256).alias("digest"))
    units = read.select("doc_id", F.inline(F.concat(F.array(unit(joined(F.col("lines")), True)), F.transform(F.array_distinct("lines"), lambda x: unit(x, False)))))
    found = Cut(units.join(sheet, units.digest == sheet.known, "left").where("whole OR licence IS NOT NULL").select("doc_id", "whole", "digest", "licence"), "licences").df
    by_doc = found.where("NOT whole").groupBy(F.col("doc_id").alias("__id")).agg(F.sort_array(F.collect_set("licence")).alias("lines"))
    whole = found.where("whole")
    return whole.join(by_doc, whole.doc_id.eqNullSafe(by_doc["__id"]), "left").select(
        "doc_id", "digest", "licence", F.coalesce("lines", F.array().cast("array<string>")).alias("lines"))
