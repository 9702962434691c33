"""Near copies: texts whose sets of five-word shingles have a Jaccard similarity of 0.8 or more.

The SimHash index and MinHash bands propose pairs; every link is confirmed on the whole sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regwise.llm import simhash
from regwise.llm.common import Cut, id_and_text, lean, passes, text_bytes
from regwise.llm.components import components, local_roots
from regwise.llm.simhash import SEED, keep_best, versioned
from regwise.session import small

SHINGLE = 5
# a pair of similarity s shares no band with probability (1 - s**ROWS)**BANDS: 0.04 % at 0.8, less above
BANDS, ROWS = 20, 5
STARS = 2  # rounds in which the members of a band's bucket meet one of them
MEMBERS, SET_BYTES = 256, 4 << 20  # of a block of members that are compared with another block
_draw = np.random.default_rng(SEED)
ADD, TIMES = (_draw.integers(0, 1 << 32, BANDS * ROWS, np.uint64).astype(np.uint32) for _ in range(2))
TIMES |= np.uint32(1)


def shingle_set(words: list[bytes]) -> np.ndarray:
    """Distinct hashes of all runs of five words, sorted; a shorter text is one shingle, a wordless one none."""
    digest = xxhash.xxh64_intdigest
    if len(words) < SHINGLE:
        return np.array([digest(b" ".join(words), SEED)] if words else [], np.uint64)
    return np.unique(np.array([digest(b"%b %b %b %b %b" % t, SEED) for t in zip(*(words[k:] for k in range(SHINGLE)))], np.uint64))


def band_keys(hashes: np.ndarray) -> np.ndarray:
    low = np.full(BANDS * ROWS, 0xFFFFFFFF, np.uint32)
    short = (hashes >> np.uint64(32)).astype(np.uint32)
    for part in range(0, len(short), 1024):  # long texts in parts
        mixed = (short[part:part + 1024, None] ^ ADD) * TIMES
        np.minimum(low, (mixed ^ (mixed >> np.uint32(15))).min(axis=0), out=low)
    return np.array([xxhash.xxh64_intdigest(band.tobytes(), k) for k, band in enumerate(low.reshape(BANDS, ROWS))], np.uint64).view(np.int64)


@lean
def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in passes(batches):
        nodes, sizes, fps, keys = [], [], [], []
        for text in text_bytes(batch):
            words = text.lower().split()  # bytes: only A-Z change, only \\x20 \\x09-\\x0D part words
            nodes.append(xxhash.xxh64_intdigest(b" ".join(words), SEED))
            found = shingle_set(words)
            sizes.append(len(found))
            fps.append(simhash.majority(found) if len(found) else 0)
            keys.append(band_keys(found) if len(found) else found.view(np.int64))
        ends = np.cumsum([0, *map(len, keys)]).astype(np.int32)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(2), pa.array(np.array(nodes, np.uint64).view(np.int64)), pa.array(sizes, pa.int64()), pa.array(fps, pa.int64()),
             pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.empty(0, np.int64), *keys])))], ["doc_id", "version", "node", "n", "fp", "keys"])


@lean
def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in passes(batches):
        sets = [shingle_set(text.lower().split()).view(np.int64) for text in text_bytes(batch)]
        ends = np.cumsum([0, *map(len, sets)]).astype(np.int32)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.empty(0, np.int64), *sets])))],
                                         ["node", "shingles"])


def _alike(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs ``a, b`` whose sets have a similarity of 0.8 or more."""
    x, y = (sets.select(F.col("node").alias(c), F.col("shingles").alias(f"s{c}")) for c in "ab")
    both = F.size(F.array_intersect("sa", "sb"))
    return pairs.join(x, "a").join(y, "b").where(9 * both >= 4 * (F.size("sa") + F.size("sb"))).select("a", "b")


def _sized(pairs: DataFrame) -> DataFrame:
    """The distinct pairs of ``a, na, b, nb`` whose sizes allow the similarity."""
    return pairs.where("a <> b AND 5 * least(na, nb) >= 4 * greatest(na, nb)").select("a", "b").distinct()


def _fingerprint_pairs(nodes: DataFrame) -> DataFrame:
    """Pairs that the SimHash index finds: nodes of one fingerprint meet the first of them, and first ones meet along its links."""
    heads = Cut(nodes.groupBy("fp").agg(F.min(F.struct("node", "n")).alias("head")), "near-heads").df
    same = nodes.join(heads, "fp").select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("head.node").alias("b"), F.col("head.n").alias("nb"))
    side = lambda end: heads.select(F.col("fp").alias(f"fp_{end}"), F.col("head.node").alias(end), F.col("head.n").alias(f"n{end}"))
    near = simhash.links(heads.select("fp")).select(F.col("a").alias("fp_a"), F.col("b").alias("fp_b"))
    return _sized(same.unionByName(near.join(side("a"), "fp_a").join(side("b"), "fp_b").select("a", "na", "b", "nb")))


def _drawn(shared: DataFrame, salt: int) -> DataFrame:
    """``key, b, nb, rb``: one drawn member of each bucket."""
    drawn = F.col("node").bitwiseXOR(F.xxhash64("key", F.lit(salt)))
    heads = shared.groupBy("key").agg(F.min(F.struct(drawn, F.col("node").alias("b"), F.col("n").alias("nb"), F.col("root").alias("rb"))).alias("head"))
    return heads.select("key", "head.b", "head.nb", "head.rb")


def _apart(entries: DataFrame, linked: DataFrame) -> DataFrame:
    """``key, node, n, root`` of the buckets that hold more than one root."""
    rooted = entries.join(linked, "node", "left").select("key", "node", "n", F.coalesce("root", "node").alias("root"))
    split = rooted.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low < high").select("key")
    return Cut(rooted.join(split, "key", "left_semi"), "near-buckets").df


BLOCK = ("key long, block long, low_root long, high_root long, low_n long, high_n long, nodes array<long>, roots array<long>, ns array<long>, shingles binary")


@lean
def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Members of one bucket, at most ``MEMBERS`` of them and about ``SET_BYTES``, with their sets."""
    seq = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        key, root, n, node = (batch.column(c).to_numpy() for c in ("key", "root", "n", "node"))
        sets = batch.column("shingles")
        flat, ends = sets.flatten().to_numpy(), np.cumsum(np.append(0, n))
        start = 0
        for i in range(1, len(key) + 1):
            if i == len(key) or key[i] != key[start] or i - start == MEMBERS or 8 * (ends[i + 1] - ends[start]) > SET_BYTES:
                lists = [pa.ListArray.from_arrays(pa.array([0, i - start], pa.int32()), pa.array(x[start:i])) for x in (node, root, n)]
                numbers = [key[start], (TaskContext.get().partitionId() << 32) + seq, *(f(x[start:i]) for x in (root, n) for f in (np.min, np.max))]
                yield pa.RecordBatch.from_arrays([*(pa.array([x], pa.int64()) for x in numbers), *lists, pa.array([flat[ends[start]:ends[i]].tobytes()], pa.binary())],
                                                 [c.split()[0] for c in BLOCK.split(", ")])
                start, seq = i, seq + 1


def shared_counts(x: np.ndarray, nx: np.ndarray, y: np.ndarray, ny: np.ndarray) -> np.ndarray:
    """How many values each set of ``x`` shares with each of ``y``; sets stand one behind the other, ``nx`` and ``ny`` are their sizes."""
    values, ids = np.unique(np.concatenate([x, y]), return_inverse=True)
    sides = []
    for part, n in ((ids[:len(x)], nx), (ids[len(x):], ny)):
        order = np.argsort(part, kind="stable")
        sides.append((np.repeat(np.arange(len(n)), n)[order], np.bincount(part, minlength=len(values))))
    (of_x, in_x), (of_y, in_y) = sides
    first_x, first_y = np.cumsum(in_x) - in_x, np.cumsum(in_y) - in_y
    out = np.zeros((len(nx), len(ny)), np.int64)
    met = in_x * in_y
    # a rare value names its pairs; frequent ones are multiplied as columns of membership
    rare = np.flatnonzero((met > 0) & (met <= 64))
    pair = np.repeat(rare, met[rare])
    k = np.arange(len(pair)) - np.repeat(np.cumsum(met[rare]) - met[rare], met[rare])
    np.add.at(out, (of_x[first_x[pair] + k // in_y[pair]], of_y[first_y[pair] + k % in_y[pair]]), 1)
    frequent = np.flatnonzero(met > 64)
    for s in range(0, len(frequent), 4096):
        columns = frequent[s:s + 4096]
        member = []
        for of, first, count, size in ((of_x, first_x, in_x, len(nx)), (of_y, first_y, in_y, len(ny))):
            m, at = np.zeros((size, len(columns)), np.float32), count[columns]
            place = np.arange(at.sum()) + np.repeat(first[columns] - np.cumsum(at) + at, at)
            m[of[place], np.repeat(np.arange(len(columns)), at)] = 1
            member.append(m)
        out += (member[0] @ member[1].T).astype(np.int64)
    return out


@lean
def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each pair of blocks a spanning forest of the similar sets."""
    for batch in batches:
        for r in range(batch.num_rows):
            a, b = ([batch.column(f"{c}_{side}")[r] for c in ("nodes", "roots", "ns")] for side in "ab")
            (node_a, root_a, n_a), (node_b, root_b, n_b) = ([x.values.to_numpy() for x in side] for side in (a, b))
            x, y = (np.frombuffer(batch.column(f"shingles_{side}")[r].as_buffer(), np.int64) for side in "ab")
            alike = (9 * shared_counts(x, n_a, y, n_b) >= 4 * (n_a[:, None] + n_b)) & (root_a[:, None] != root_b)
            i, j = np.nonzero(alike)
            if len(i):
                nodes, least = local_roots(node_a[i], node_b[j])
                yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(least)], ["a", "b"])


def _block_links(shared: DataFrame, sets: DataFrame) -> DataFrame:
    """Links ``a, b`` between members of one bucket that are not connected yet: all of them, or a forest that connects the same."""
    order = ["key", "root", "n", "node"]
    rows = shared.join(sets, "node").select(*order, "shingles")
    blocks = Cut(rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_blocks, BLOCK), "near-blocks").df
    meta = ["block", "low_root", "high_root", "low_n", "high_n"]
    l, r = (blocks.select("key", *[F.col(c).alias(f"{c}_{side}") for c in meta]) for side in "ab")
    one_root = "low_root_a = high_root_a AND low_root_b = high_root_b AND low_root_a = low_root_b"
    pairs = l.join(r, "key").where(f"block_a <= block_b AND NOT ({one_root}) AND 5 * high_n_a >= 4 * low_n_b AND 5 * high_n_b >= 4 * low_n_a").select("block_a", "block_b")
    load = lambda side: blocks.select(*[F.col(c).alias(f"{c}_{side}") for c in ("block", "nodes", "roots", "ns", "shingles")])
    return pairs.join(load("a"), "block_a").join(load("b"), "block_b").mapInArrow(_compared, "a long, b long")


def roots(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``doc_id, version, node, ..`` of every row, and ``node, root`` of the distinct texts that have near copies.

    Texts with the same words are one node. The Gray-order index links nodes
    whose fingerprints are near; what it cannot find, since texts of a
    similarity of 0.8 differ in more bits than an index can search, comes from
    buckets of MinHash bands. Members of a bucket first meet a drawn member,
    which links most of a large group in rows that grow with its size. The
    members that were not drawn, where they are still apart, then meet in
    blocks; blocks whose members are connected already are left out. So no
    pair of a bucket that could connect two groups is left unread.
    """
    signed = "doc_id long, version long, node long, n long, fp long, keys array<long>"
    rows = Cut(versioned(id_and_text(docs)).mapInArrow(_signed, signed), "near-rows").df
    nodes = Cut(rows.where("n > 0").select("node", "n", "fp", "keys").dropDuplicates(["node"]), "near-nodes").df
    # texts whose sets are read: those that share a band or a fingerprint's neighbourhood with another one
    proposed = Cut(_fingerprint_pairs(nodes.select("node", "n", "fp")), "near-pairs").df
    entries = nodes.select(F.explode("keys").alias("key"), "node", "n")
    nothing = proposed.select(F.col("a").alias("node"), F.col("b").alias("root")).limit(0)
    shared = _apart(entries, nothing)
    read = shared.select("node").union(proposed.select("a")).union(proposed.select("b")).distinct()
    least = small(rows.join(read, "node", "left_semi").groupBy("node").agg(F.min("version").alias("version")))
    texts = versioned(id_and_text(docs)).join(least, "version").select("node", "text")
    sets = Cut(texts.mapInArrow(_sets, "node long, shingles array<long>").dropDuplicates(["node"]), "near-sets").df
    links = Cut(_alike(proposed, sets), "near-links").df
    linked = Cut(components(links), "near-roots").df
    shared = _apart(shared.drop("root"), linked)
    for salt in range(STARS):
        heads = Cut(_drawn(shared, salt), "near-heads").df
        met = shared.join(heads, "key")
        links = links.union(Cut(_alike(_sized(met.where("root <> rb").select(F.col("node").alias("a"), F.col("n").alias("na"), "b", "nb")), sets), "near-links").df)
        linked = Cut(components(links), "near-roots").df
        # a drawn member has met all others of its bucket
        shared = _apart(met.where("node <> b").select("key", "node", "n"), linked)
    links = links.union(Cut(_block_links(shared, sets), "near-links").df)
    return rows, Cut(components(links), "near-roots").df


def keep_one(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each group of near copies: that of the smallest doc_id.

    Groups are what links reach. Null texts count as empty, and texts without
    a word are copies of each other; everything else is as in
    ``simhash.keep_one``.
    """
    rows, linked = roots(docs)
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "version"))
    best = rows.groupBy("node").agg(first.alias("best")).join(linked, "node", "left")
    return keep_best(docs, best.groupBy(F.coalesce("root", "node")).agg(F.min("best").alias("best")))
