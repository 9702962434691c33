"""Filter interaction audit: what each of five filters removes in each of their 120 orders."""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from itertools import permutations

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from regwise.llm.common import Cut, lean, passes

FILTERS = "ABCDE"
ORDERS = ["".join(p) for p in permutations(FILTERS)]  # lexicographic: the place is the Lehmer rank
BIT = {name: 1 << i for i, name in enumerate(FILTERS)}
MIN_WORDS = 200
CAPITALS = bytes(range(65, 91))
MARKS = re.compile(rb"[#$%&*|]")
SUMS = ("n", "good", "toxic")


def own_mask(raw: bytes) -> int:
    """Bits of the filters A to D that a text fails; E needs the other texts."""
    words = raw.split()  # bytes part at \x20 \x09-\x0D only
    points = len(raw) - len(raw.translate(None, bytes(range(0x80, 0xC0)))) if not raw.isascii() else 0
    capitals = len(raw) - len(raw.translate(None, CAPITALS))
    return ((len(words) < MIN_WORDS) * BIT["A"] + (100 * len(set(words)) < 50 * len(words)) * BIT["B"]
            + (100 * capitals > 3 * (len(raw) - points)) * BIT["C"] + (MARKS.search(raw) is not None) * BIT["D"])


@lean
def _judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in passes(batches):
        raw = batch.column(1).cast(pa.binary()).to_pylist()
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(2), pa.array([own_mask(t) for t in raw], pa.int32()),
             pa.array([hashlib.sha256(t).digest() for t in raw], pa.binary())], ["doc_id", "part", "mask", "digest"])


def masks(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``part, mask, n, good, toxic``: documents per part and set of failed filters, and how many of them bear each label.

    A text is read once; from then on rows are an id, a digest and a mask.
    Rows of one text have the same first four bits, so for each text it is
    enough to know, per part and labels, how many rows there are and how many
    of them have the smallest id. These counts are combined before every
    shuffle, so that a text that a third of the rows repeat is a few rows.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
                       F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"))
    judged = rows.mapInArrow(_judged, "doc_id long, part string, mask int, digest binary")
    # rows without an id match no label and are spread by their digest
    spread = F.when(F.col("doc_id").isNull(), F.xxhash64("digest")).otherwise(F.lit(0).cast("long"))
    known = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id"), F.lit(0).cast("long").alias("spread")).agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"), F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"))
    marked = judged.withColumn("spread", spread).join(known, ["doc_id", "spread"], "left")
    text, kind = ["digest"], ["part", "mask", "good", "toxic"]
    marked = marked.select(*text, "part", "mask", *[F.coalesce(c, F.lit(False)).alias(c) for c in ("good", "toxic")], "doc_id", "spread")
    by_id = marked.groupBy(*text, *kind, "doc_id", "spread").agg(F.count("*").alias("n"))
    # nulls are not smaller than any id, and no id is smaller than a null
    first = F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "n")))
    kinds = by_id.groupBy(*text, *kind).agg(F.sum("n").alias("n"), first.alias("first"), F.sum(F.when(F.col("doc_id").isNull(), F.col("n"))).alias("nameless"))
    least = F.min("first.doc_id").over(Window.partitionBy(*text))  # at most one row per part and labels
    free = F.coalesce("nameless", F.lit(0)) + F.when(F.col("first.doc_id") == least, F.col("first.n")).otherwise(0)
    passed, failed = F.struct(F.lit(0).alias("e"), F.col("free").alias("c")), F.struct(F.lit(BIT["E"]).alias("e"), (F.col("n") - F.col("free")).alias("c"))
    split = kinds.withColumn("free", free).select(*kind, F.inline(F.array(passed, failed))).where("c > 0")
    count = lambda c: F.sum(F.when(F.col(c), F.col("c")).otherwise(0)).alias(c)
    return split.groupBy("part", (F.col("mask") + F.col("e")).alias("mask")).agg(F.sum("c").alias("n"), count("good"), count("toxic"))


def intervals() -> list[tuple[int, int, int, int]]:
    """``(mask, step, low, high)``: the documents of a mask go at ``step`` in the orders of ranks low to high - 1.

    They go at the first filter that they fail. The orders that open with the
    same letters stand together, so for every run of filters that a mask
    passes, followed by one that it fails, the ranks form one interval.
    """
    rank = {o: i for i, o in enumerate(ORDERS)}
    out = []
    for mask in range(1, 1 << len(FILTERS)):
        passed, failed = ([f for f in FILTERS if bool(mask & BIT[f]) == x] for x in (False, True))
        for k in range(len(passed) + 1):
            for lead in permutations(passed, k):
                for f in failed:
                    head = "".join(lead) + f
                    low = rank[head + "".join(x for x in FILTERS if x not in head)]
                    out.append((mask, k + 1, low, low + math.factorial(len(FILTERS) - k - 1)))
    return out


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, order of the filters and step, with ``kept``, ``removed``, ``redundant``, ``unique_fails``, ``good_lost``, ``toxic_lost`` and ``shapley``.

    Every mask adds its counts where its intervals of ranks begin and takes
    them off where they end; running sums over the 120 ranks then give what
    each step removes in each order, without going through the orders of any
    document. From the counted masks on, all frames hold at most 605 rows a part.

    A null text is empty, a null lang is the part of the empty string. A
    repeated row is a document of its own, and fails E only where a smaller id
    has its text; rows without an id never fail E. Labels of one id that
    differ all count. Other columns are not read; without documents there are
    no rows, without labels nothing is lost.
    """
    spark = docs.sparkSession
    n = len(FILTERS)
    counted = Cut(masks(docs, labels), "masks").df
    # 31 masks at their places in 120 orders: a fixed size
    places = F.broadcast(spark.sql(f"SELECT * FROM VALUES {', '.join(map(str, intervals()))} AS t(mask, step, low, high)"))
    ends = [F.struct(F.col("low").alias("rank"), *[F.col(c).alias(c) for c in SUMS]),
            F.struct(F.col("high").alias("rank"), *[(-F.col(c)).alias(c) for c in SUMS])]
    # every part with all ranks and steps, so that zeros appear
    every = counted.groupBy("part").agg(F.sum("n").alias("total"), *[
        F.sum(F.when(F.col("mask").bitwiseAND(b) != 0, F.col("n")).otherwise(0)).alias(f"fails_{f}") for f, b in BIT.items()], *[
        F.sum(F.when(F.col("mask") == b, F.col("n")).otherwise(0)).alias(f"only_{f}") for f, b in BIT.items()])
    grid = every.select("part", F.explode(F.sequence(F.lit(1), F.lit(n))).alias("step")).select(
        "part", "step", F.explode(F.sequence(F.lit(0), F.lit(len(ORDERS) - 1))).alias("rank"), *[F.lit(0).cast("long").alias(c) for c in SUMS])
    steps = counted.join(places, "mask").select("part", "step", F.inline(F.array(*ends))).where(F.col("rank") < len(ORDERS))
    differences = steps.unionByName(grid).groupBy("part", "step", "rank").agg(*[F.sum(c).alias(c) for c in SUMS])
    along = Window.partitionBy("part", "step").orderBy("rank")
    removed = differences.select("part", "step", "rank", *[F.sum(c).over(along).alias(c) for c in SUMS])
    order = F.element_at(F.array(*map(F.lit, ORDERS)), F.col("rank") + 1)
    removed = removed.withColumn("filter_order", order).withColumn("filter", F.substring("filter_order", F.col("step"), F.lit(1)))
    so_far = F.sum("n").over(Window.partitionBy("part", "rank").orderBy("step"))
    in_all = F.sum("n").over(Window.partitionBy("part", "filter"))
    laid = removed.select("*", so_far.alias("gone"), in_all.alias("shapley")).join(every, "part")
    of = lambda kind: F.coalesce(*[F.when(F.col("filter") == f, F.col(f"{kind}_{f}")) for f in FILTERS])
    return laid.select("part", "filter_order", "step", (F.col("total") - F.col("gone")).alias("kept"), F.col("n").alias("removed"),
                       (of("fails") - F.col("n")).alias("redundant"), of("only").alias("unique_fails"), F.col("good").alias("good_lost"),
                       F.col("toxic").alias("toxic_lost"), "shapley")
