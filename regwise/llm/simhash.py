"""SimHash near-duplicates: fingerprints searched by a Gray-order hierarchical index."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regwise.llm.common import Cut, free, id_and_text, lean, passes, text_bytes
from regwise.llm.components import components, local_roots

SHINGLE, SEED, DISTANCE = 3, 42, 2
# bits of a fingerprint in each routing mask: one more mask than DISTANCE, so
# two fingerprints that link agree on all bits of at least one of them
SEGMENTS = ((0, 22), (22, 21), (43, 21))
BLOCK, NODE = 512, 64


def shingle_hashes(text: bytes) -> list[int]:
    """Unsigned XXH64 of every run of three words of the lower-cased text, repeats included."""
    words = text.lower().split()  # bytes: only A-Z change, only \\x20 \\x09-\\x0D part words
    digest = xxhash.xxh64_intdigest
    if len(words) < SHINGLE:
        return [digest(b" ".join(words), SEED)] if words else []
    return [digest(b"%b %b %b" % t, SEED) for t in zip(words, words[1:], words[2:])]


def majority(hashes: np.ndarray) -> int:
    ones = np.zeros(64, np.int64)
    for part in range(0, len(hashes), 1 << 16):  # long texts in parts
        ones += np.unpackbits(hashes[part:part + (1 << 16)].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big", signed=True)


@lean
def _fingerprint_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in passes(batches):
        found = []
        for text in text_bytes(batch):
            hashes = shingle_hashes(text)
            found.append(majority(np.array(hashes, np.uint64)) if hashes else 0)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(found, pa.int64())], ["doc_id", "version", "fp"])


def _version(doc_id, text):
    """Tells rows of one doc_id apart; null and absent ids are not the same as 0."""
    return F.xxhash64(doc_id.isNull(), text)


def versioned(rows: DataFrame) -> DataFrame:
    return rows.select("doc_id", "text", _version(F.col("doc_id"), F.col("text")).alias("version"))


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id, version, fp``: the 64-bit SimHash of every whole text as a signed long (null or wordless text: 0)."""
    return versioned(id_and_text(docs)).mapInArrow(_fingerprint_rows, "doc_id long, version long, fp long")


def gray_rank(fp: np.ndarray) -> np.ndarray:
    """Position of each 64-bit pattern in Gray order, where neighbours differ in one bit."""
    out = fp.astype(np.uint64)
    for s in (1, 2, 4, 8, 16, 32):
        out ^= out >> np.uint64(s)
    return out


def _routes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        fp = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
        rank = gray_rank(fp).view(np.int64)
        for k, (low, width) in enumerate(SEGMENTS):
            bits = (fp >> np.uint64(low)) & np.uint64((1 << width) - 1)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(fp), k, np.int32)), pa.array(bits.view(np.int64)), pa.array(rank),
                                              pa.array(fp.view(np.int64))], ["mask", "bits", "rank", "fp"])


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of one routing pattern in Gray order, cut every BLOCK rows, with the bits that all or any row sets."""
    for batch in batches:
        if not batch.num_rows:
            continue
        mask, bits, rank, fp = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(4))
        new = np.ones(len(fp), bool)
        new[1:] = (mask[1:] != mask[:-1]) | (bits[1:] != bits[:-1])
        run = np.flatnonzero(new)
        since = np.arange(len(fp)) - np.repeat(run, np.diff(np.append(run, len(fp))))
        at = np.flatnonzero(new | (since % BLOCK == 0))
        members = pa.ListArray.from_arrays(pa.array(np.append(at, len(fp)).astype(np.int32)), pa.array(fp))
        yield pa.RecordBatch.from_arrays(
            [pa.array(mask[at]), pa.array(bits[at]), pa.array(rank[at]), members, pa.array(np.bitwise_and.reduceat(fp, at)),
             pa.array(np.bitwise_or.reduceat(fp, at))], ["mask", "bits", "first", "members", "every", "some"])


def _node_patterns(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.arange(0, len(fp), NODE)
    every, some = np.bitwise_and.reduceat(fp, at), np.bitwise_or.reduceat(fp, at)
    return every, ~(every ^ some)


def linked(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of ``x`` and ``y`` within DISTANCE bits; nodes whose shared bits already differ more are skipped whole."""
    (px, mx), (py, my) = _node_patterns(x), _node_patterns(y)
    near = np.bitwise_count((px[:, None] ^ py) & mx[:, None] & my) <= DISTANCE
    a, b = [], []
    for i in np.flatnonzero(near.any(axis=1)):
        rows = x[i * NODE:(i + 1) * NODE]
        cols = y[np.repeat(near[i], NODE)[:len(y)]]
        r, c = np.nonzero(np.bitwise_count(rows[:, None] ^ cols) <= DISTANCE)
        a.append(rows[r])
        b.append(cols[c])
    empty = np.empty(0, x.dtype)
    return (np.concatenate(a), np.concatenate(b)) if a else (empty, empty)


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for x, y in zip(batch.column(0), batch.column(1), strict=True):
            a, b = linked(x.values.to_numpy().view(np.uint64), y.values.to_numpy().view(np.uint64))
            keep = a != b
            if keep.any():
                out.append(local_roots(a[keep].view(np.int64), b[keep].view(np.int64)))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([o[k] for o in out])) for k in (0, 1)], ["a", "b"])


def links(fps: DataFrame) -> DataFrame:
    """Edges ``a, b`` that connect all distinct fingerprints ``fp`` within DISTANCE bits of each other.

    Three routing masks are the upper nodes: fingerprints that link share all
    bits under one of them. Below a mask the fingerprints stand in Gray order,
    cut into blocks; blocks meet by equality of the routing bits, and a pair
    of blocks whose commonly fixed bits differ by more than DISTANCE is
    pruned. A hot pattern yields many blocks, whose pairs are single rows that
    Spark spreads. Each task reduces its links to a spanning forest.
    """
    routes = fps.mapInArrow(_routes, "mask int, bits long, rank long, fp long")
    order = ["mask", "bits", "rank"]
    blocks = Cut(routes.repartitionByRange(*order).sortWithinPartitions(*order)
                 .mapInArrow(_blocks, "mask int, bits long, first long, members array<long>, every long, some long"), "gray").df
    left, right = blocks.alias("l"), blocks.alias("r")
    c = F.col
    fixed = c("l.every").bitwiseXOR(c("l.some")).bitwiseOR(c("r.every").bitwiseXOR(c("r.some")))
    differ = F.bit_count(c("l.every").bitwiseXOR(c("r.every")).bitwiseAND(F.bitwise_not(fixed)))
    pairs = (left.join(right, (c("l.mask") == c("r.mask")) & (c("l.bits") == c("r.bits")) & (c("l.first") <= c("r.first")))
             .where(((c("l.first") < c("r.first")) | (F.size("l.members") > 1)) & (differ <= DISTANCE))
             .select(c("l.members").alias("x"), c("r.members").alias("y")))
    return pairs.mapInArrow(_search, "a long, b long")


def _grouped(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows with their fingerprints, and ``fp, root`` for each distinct fingerprint."""
    rows = Cut(fingerprints(docs), "simhash").df
    classes = rows.groupBy("fp").agg(F.min("doc_id").alias("least"))
    roots = components(links(classes.select("fp")))
    rooted = classes.join(roots, classes.fp == roots.node, "left")
    return rows, Cut(rooted.select("fp", "least", F.coalesce("root", "fp").alias("root")), "simhash").df


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id, fp, component_id``: the smallest doc_id reachable over fingerprints that link.

    One row per row of ``docs``. Null texts count as empty; texts without a
    word have fingerprint 0 and link like any other; rows with a null doc_id
    take part but never name a group that has another id; repeated rows fall
    together; other columns are not read; an empty table gives no rows.
    Copies meet as one distinct fingerprint, so thousands of them are one node.
    """
    rows, rooted = _grouped(docs)
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(least, "root").select("fp", "component_id")
    return rows.join(named, "fp").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each group of near-duplicates: that of the smallest doc_id.

    Columns and rows stay as they are otherwise. Of several rows of that doc_id
    in the group, the one with the smallest text hash stays, once; a group
    without any doc_id keeps one of its rows in the same way.
    """
    rows, rooted = _grouped(docs)
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "version"))
    return keep_best(docs, rows.groupBy("fp").agg(first.alias("best")).join(rooted, "fp").groupBy("root").agg(F.min("best").alias("best")))


def keep_best(docs: DataFrame, best: DataFrame) -> DataFrame:
    """The rows of ``docs`` that ``best`` names by doc_id and version, each once."""
    place, version = free("__id", docs), free("__version", docs)
    best = best.select(F.coalesce("best.doc_id", F.lit(0)).alias(place), F.col("best.version").alias(version))
    doc_id, text = F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit(""))
    keyed = docs.withColumns({place: F.coalesce(doc_id, F.lit(0)), version: _version(doc_id, text)})
    return keyed.join(best, [place, version], "left_semi").dropDuplicates([place, version]).select(*docs.columns)
