"""Quality rules: a ledger of failure bits and measurements, judged by versioned policies."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regwise.llm.common import lean, passes

SYMBOLS, SPACE = "#*$%&|<>", " \t\n\r\x0b\x0c"
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_shouted")

# A rule is an SQL condition on the measurements under which a text fails; its
# bit is its place. Rules are only ever added at the end, so stored bits stay valid.
RULES = {
    "few_words": "n_words < 50",
    "repeated_words": "100 * n_repeat_words > 50 * n_words",
    "symbols": "10 * n_symbols > n_words",
    "repeated_lines": "10 * n_dup_lines > 3 * n_lines",
    "short_words": "word_chars < 3 * n_words",
    "long_words": "word_chars > 10 * n_words",
    "shouted": "10 * n_shouted > 3 * n_words",
}
BIT = {name: 1 << i for i, name in enumerate(RULES)}
# policy version: the bits that reject a text
POLICIES = {
    "base": BIT["few_words"] | BIT["repeated_words"],
    "v1": BIT["few_words"] | BIT["repeated_words"] | BIT["symbols"] | BIT["repeated_lines"],
    "v2": sum(BIT.values()),
}
CURRENT = "v2"


def repeated_words(words: list[bytes]) -> int:
    """Words inside three-word windows that the text holds twice or more."""
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) == len(windows):
        return 0
    times, covered = Counter(windows), bytearray(len(words))
    for i, w in enumerate(windows):
        if times[w] > 1:
            covered[i:i + 3] = b"\1\1\1"
    return sum(covered)


def measure(text: str) -> tuple[int, ...]:
    raw = text.encode()
    words = raw.split()  # bytes part at \x20 \x09-\x0D only
    lines = [x for x in raw.split(b"\n") if x.strip()]
    return (len(words), len(text) - sum(map(text.count, SPACE)), sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines)),
            repeated_words(words), len(lines), sum(len(w) > 1 and w.isupper() for w in words))


@lean
def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in passes(batches, 0):
        found = [measure(t) for t in batch.column(0).to_pylist()]
        columns = zip(*found) if found else [[]] * len(MEASURES)
        measures = pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in columns], MEASURES)
        yield pa.RecordBatch.from_arrays([batch.column(1), measures], ["row", "m"])


def _judged(docs: DataFrame, text: str, keep: tuple[str, ...]) -> DataFrame:
    """``row`` with the columns of ``keep``, the measurements, and ``bits``."""
    rows = docs.select(F.coalesce(F.col(text).cast("string"), F.lit("")).alias("t"), F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"))
    schema = f"row {rows.schema['row'].dataType.simpleString()}, m struct<{','.join(f'{m}:bigint' for m in MEASURES)}>"
    return rows.mapInArrow(_measured, schema).select("row", "m.*").withColumn("bits", failed_bits())


def ledger(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns of ``keep``, every measurement, and ``bits``: one bit per failed rule.

    Each text is read once, whole; rules that come later are evaluated on the
    stored measurements, and policies on the bits, without the texts. One row
    per row; a null text has no words and no lines; columns that are not kept
    are not read, so their names may clash, and kept ones may not be named like
    a measurement; an empty table gives an empty ledger.
    """
    return _judged(docs, text, keep).select("row.*", *MEASURES, "bits")


def failed_bits() -> Column:
    bits = F.lit(0).cast("long")
    for name, condition in RULES.items():
        bits = bits + F.when(F.expr(condition), F.lit(BIT[name])).otherwise(F.lit(0)).cast("long")
    return bits


def verdict(policy: str = CURRENT) -> Column:
    """Whether a ledger row passes a policy version."""
    return F.col("bits").bitwiseAND(F.lit(POLICIES[policy])) == 0


def ablations(book: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Per policy and rule: texts that the rule fails, and texts that would be kept without it.

    The ledger is first counted per bit pattern (at most two to the number of
    rules, combined before the shuffle); all policies are then bit operations
    on those counts. ``any_failed`` holds the union of the failed bits.
    """
    patterns = book.groupBy(*by, "bits").agg(F.count("*").alias("n"))
    sheet = F.array(*[F.struct(F.lit(p).alias("policy"), F.lit(mask).cast("long").alias("mask"), F.lit(r).alias("rule"), F.lit(BIT[r]).cast("long").alias("bit"))
                      for p, mask in POLICIES.items() for r in RULES if mask & BIT[r]])
    each = patterns.select(*by, "bits", "n", F.inline(sheet))
    hit, others = F.col("bits").bitwiseAND(F.col("bit")) != 0, F.col("bits").bitwiseAND(F.col("mask")) == F.col("bit")
    return each.groupBy(*by, "policy", "rule").agg(
        F.sum("n").alias("n_texts"), F.sum(F.when(hit, F.col("n")).otherwise(0)).alias("n_failed"),
        F.sum(F.when(others, F.col("n")).otherwise(0)).alias("n_only_this"), F.bit_or(F.col("bits").bitwiseAND(F.col("mask"))).alias("any_failed"))


def passing(docs: DataFrame, policy: str = CURRENT) -> DataFrame:
    """The rows of ``docs`` whose text passes the policy, with their columns unchanged, whatever their names."""
    return _judged(docs, "text", tuple(docs.columns)).where(verdict(policy)).select("row.*")
