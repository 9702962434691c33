"""Removal of repeated passages with a logarithmic family of sampled suffix arrays.

A suffix is sampled where its first ``STEM`` bytes have the smallest
fingerprint of all stems inside some window of ``LENGTH`` bytes. Every window
so belongs to one sampled suffix, and equal windows to suffixes with equal
stems. A suffix array holds the sampled suffixes of a batch in the order of
their stems' fingerprints. Long matches are found where a new batch's array
and an existing level's array, merged, hold the same stem in two blocks.

Only suffixes with such a stem are looked at byte for byte, in two steps: by
the whole extent of a suffix (all bytes of all its windows), and, where one
stem has several extents, by window. Fingerprints have 64 bits; a removed
window agrees in those of its stem and of its extent or itself.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regwise.llm.common import Cut, lean

LENGTH, STEM = 100, 51
SPAN = LENGTH - STEM + 1  # stems inside a window; neighbouring samples lie at most so far apart
BLOCK_BYTES = 8 << 20  # of text in a block, and of text whose fingerprints meet in a bucket
CHUNK = 1 << 19  # window starts in one numpy pass
BATCHES = 4
BASE = 0x9E3779B97F4A7C15
U = np.uint64


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> U(30))) * U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U(27))) * U(0x94D049BB133111EB)
    return h ^ (h >> U(31))


@lru_cache(maxsize=1)
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A number for every byte, and the powers of BASE and of its inverse modulo 2^64."""
    letters = mix(np.arange(1, 257, dtype=np.uint64) * U(0x9E3779B97F4A7C15))

    def powers(b: int) -> np.ndarray:
        out = np.full(CHUNK + LENGTH + 1, b, np.uint64)
        out[0] = 1
        return np.cumprod(out)
    return letters, powers(BASE), powers(pow(BASE, -1, 1 << 64))


class Chunk:
    """Fingerprints of any substrings of a stretch of bytes."""

    def __init__(self, x: np.ndarray):
        letters, up, self.down = _tables()
        self.sums = np.zeros(len(x) + 1, np.uint64)
        np.cumsum(letters[x] * up[:len(x)], out=self.sums[1:])

    def prints(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.down[start])

    def stems(self) -> np.ndarray:
        n = len(self.sums) - STEM
        return mix((self.sums[STEM:] - self.sums[:n]) * self.down[:n])


class Block:
    """The texts of a block: where windows may start, and the sampled suffixes with their runs of windows."""

    def __init__(self, payload: bytes, lens: list[int]):
        self.bytes = zstandard.ZstdDecompressor().decompress(payload)
        self.x = np.frombuffer(self.bytes, np.uint8)
        self.lens = np.array(lens, np.int64)
        self.ends = np.cumsum(self.lens)

    def chunks(self) -> Iterator[tuple[int, Chunk, np.ndarray]]:
        """Offset, fingerprints and window starts (within the chunk) of each stretch; windows never cross texts."""
        for at in range(0, max(0, len(self.x) - LENGTH + 1), CHUNK):
            stop = min(at + CHUNK, len(self.x) - LENGTH + 1)
            own = np.ones(stop - at, bool)
            first, last = np.searchsorted(self.ends, [at, stop + LENGTH])
            for e in self.ends[first:last + 1].tolist():  # a window may not hold this border inside
                own[max(0, e - LENGTH + 1 - at):max(0, e - at)] = False
            yield at, Chunk(self.x[at:stop + LENGTH - 1]), np.flatnonzero(own)

    def suffixes(self) -> Iterator[tuple[int, Chunk, np.ndarray, np.ndarray, np.ndarray]]:
        """Per chunk: offset, fingerprints, and of each sampled suffix its stem's print and its first and last window start."""
        for at, chunk, starts in self.chunks():
            if not len(starts):
                continue
            stems = chunk.stems()
            n = len(stems)
            # the position rides along, so that the first of equal stems wins
            tagged = (stems & ~U(0x3FFFFF)) | np.arange(n, dtype=np.uint64)
            rows = np.append(tagged, np.full(-n % SPAN, ~U(0))).reshape(-1, SPAN)
            ahead = np.minimum.accumulate(rows, axis=1).ravel()
            behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
            least = np.minimum(behind[starts], ahead[starts + SPAN - 1])
            sample = (least & U(0x3FFFFF)).astype(np.int64)
            new = np.append(True, (sample[1:] != sample[:-1]) | (starts[1:] != starts[:-1] + 1))
            first = np.flatnonzero(new)
            last = np.append(first[1:], len(starts)) - 1
            yield at, chunk, stems[sample[first]], starts[first], starts[last]


def extents(chunk: Chunk, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    return chunk.prints(first, last + LENGTH)


def spread(first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """All window starts of the runs, in order."""
    size = last - first + 1
    return np.arange(size.sum()) + np.repeat(first - (np.cumsum(size) - size), size)


def member(values: np.ndarray, among: np.ndarray) -> np.ndarray:
    """Which values are in the sorted array."""
    if not len(among):
        return np.zeros(len(values), bool)
    order = np.argsort(values)
    ranked = values[order]
    out = np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(among, ranked), len(among) - 1)
    out[order] = among[at] == ranked
    return out


def runs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where runs of equal neighbours begin and end."""
    if not len(values):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    at = np.flatnonzero(np.append(True, values[1:] != values[:-1]))
    return at, np.append(at[1:], len(values))


def _numbers(cells) -> np.ndarray:
    parts = [np.frombuffer(c, np.uint64) for c in cells]
    return np.concatenate(parts) if parts else np.empty(0, np.uint64)


def _bucketed(block: int, buckets: int, *columns: np.ndarray) -> pa.RecordBatch:
    """``bucket, block`` and the columns, packed, of rows dealt by the first column."""
    bucket = (columns[0] >> U(24)) % U(buckets)
    order = np.argsort(bucket, kind="stable")
    bucket = bucket[order]
    at, ends = runs(bucket)
    packed = [pa.array([c[a:b].tobytes() for a, b in zip(at, ends, strict=True)], pa.binary()) for c in (x[order] for x in columns)]
    return pa.RecordBatch.from_arrays([pa.array(bucket[at].astype(np.int64)), pa.array([block] * len(at), pa.int64()), *packed],
                                      ["bucket", "block", *(f"v{i}" for i in range(len(columns)))])


def _by_block(block: np.ndarray, kind: str, values: np.ndarray) -> pa.Table:
    order = np.argsort(block, kind="stable")
    block, values = block[order], values[order]
    at, ends = runs(block)
    return pa.table({"block": pa.array(block[at], pa.int64()), "kind": pa.array([kind] * len(at), pa.string()),
                     "prints": pa.array([values[a:b].tobytes() for a, b in zip(at, ends, strict=True)], pa.binary())})


def _pack(block_bytes: int):
    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq, texts, rows, size = TaskContext.get().partitionId(), 0, [], [], 0

        def out() -> pa.RecordBatch:
            kept = pa.concat_arrays(rows)
            return pa.RecordBatch.from_arrays(
                [pa.array([(part << 32) + seq], pa.int64()), pa.array([part], pa.int32()), pa.ListArray.from_arrays(pa.array([0, len(kept)], pa.int32()), kept),
                 pa.array([[len(t) for t in texts]], pa.list_(pa.int64())), pa.array([zstandard.ZstdCompressor(1).compress(b"".join(texts))], pa.binary())],
                ["block", "part", "rows", "lens", "payload"])

        for batch in batches:
            for i, t in enumerate(batch.column(0).cast(pa.binary()).to_pylist()):
                texts.append(t)
                rows.append(batch.column(1).slice(i, 1))
                size += len(t)
                if size >= block_bytes:
                    yield out()
                    seq, texts, rows, size = seq + 1, [], [], 0
        if texts:
            yield out()
    return run


def blocks(docs: DataFrame, text: str = "text", block_bytes: int = BLOCK_BYTES) -> Cut:
    """The documents in order of doc_id (then text), about ``block_bytes`` of text a row."""
    kept = [c for c in docs.columns if c != text]
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    total = docs.agg(F.sum(F.octet_length(whole) + F.lit(8))).first()[0] or 0
    rows = docs.select(whole.alias("text"), F.struct(*kept).alias("row"), F.col("doc_id").cast("long").alias("place"))
    dealt = rows.repartitionByRange(max(1, math.ceil(total / (2 * block_bytes))), "place").sortWithinPartitions("place", "text").select("text", "row")
    row = dealt.schema["row"].dataType.simpleString()
    return Cut(dealt.mapInArrow(_pack(block_bytes), f"block long, part int, rows array<{row}>, lens array<bigint>, payload binary"), "blocks")


class SuffixFamily:
    """Suffix arrays of batches in levels of doubling size.

    A level is a table of buckets; a bucket holds its stems' fingerprints in
    order, each with its block. ``add`` merge-scans the new array against every
    level and returns the long matches; before the next batch, levels of equal
    size are merged, so a suffix is rewritten a logarithmic number of times.
    """

    def __init__(self, buckets: int):
        self.buckets, self.levels = buckets, []  # (size in batches, table)

    def add(self, batch: DataFrame) -> list[DataFrame]:
        while len(self.levels) > 1 and self.levels[-1][0] == self.levels[-2][0]:
            (a, x), (b, y) = self.levels.pop(), self.levels.pop()
            self.levels.append((a + b, Cut(x.df.union(y.df).groupBy("bucket").applyInArrow(_merge, LEVEL), "level")))
            x.drop()
            y.drop()
        arrays = batch.select("block", "lens", "payload").mapInArrow(_arrays(self.buckets), "bucket long, block long, v0 binary")
        new = Cut(arrays.groupBy("bucket").applyInArrow(_array, LEVEL), "level")
        found = [Cut(new.df.groupBy("bucket").applyInArrow(_matches(False), MATCHES), "matches").df]
        for _, level in self.levels:
            both = new.df.withColumn("side", F.lit(0)).union(level.df.withColumn("side", F.lit(1)))
            found.append(Cut(both.groupBy("bucket").applyInArrow(_matches(True), MATCHES), "matches").df)
        self.levels.append((1, new))
        return found

    def drop(self) -> None:
        for _, level in self.levels:
            level.drop()


LEVEL = "bucket long, v0 binary, blocks binary"
MATCHES = "block long, kind string, prints binary"


def _arrays(buckets: int):
    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                stems = [s for _, _, s, _, _ in Block(row["payload"], row["lens"]).suffixes()]
                if stems:
                    yield _bucketed(row["block"], buckets, np.unique(np.concatenate(stems)))
    return run


@lean
def _array(key: tuple, rows: pa.Table) -> pa.Table:
    stems = _numbers(rows.column("v0").to_pylist())
    sizes = [len(c) // 8 for c in rows.column("v0").to_pylist()]
    return _level(key, stems, np.repeat(np.array(rows.column("block").to_pylist(), np.int64), sizes))


def _level(key: tuple, stems: np.ndarray, block: np.ndarray) -> pa.Table:
    order = np.argsort(stems, kind="stable")
    return pa.table({"bucket": pa.array([key[0].as_py()], pa.int64()), "v0": pa.array([stems[order].tobytes()], pa.binary()),
                     "blocks": pa.array([block[order].tobytes()], pa.binary())})


def _held(rows: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    return _numbers(rows.column("v0").to_pylist()), _numbers(rows.column("blocks").to_pylist()).view(np.int64)


@lean
def _merge(key: tuple, rows: pa.Table) -> pa.Table:
    return _level(key, *_held(rows))


def _matches(across: bool):
    """Blocks and stems of long matches: inside one array, or between the two sides of a merge."""
    @lean
    def run(key: tuple, rows: pa.Table) -> pa.Table:
        stems, block = _held(rows)
        side = block
        if across:
            side = np.repeat(np.array(rows.column("side").to_pylist(), np.int64), [len(c) // 8 for c in rows.column("v0").to_pylist()])
        order = np.argsort(stems, kind="stable")
        stems, block, side = stems[order], block[order], side[order]
        at, ends = runs(stems)
        if not len(at):
            return _by_block(block, "stem", stems)
        both = np.repeat(np.minimum.reduceat(side, at) != np.maximum.reduceat(side, at), ends - at)
        return _by_block(block[both], "stem", stems[both])
    return run


def _replies(rows: pa.Table, kind: str) -> np.ndarray:
    own = rows.filter(pc.equal(rows.column("kind"), kind)) if rows.num_rows else rows
    return np.unique(_numbers(own.column("prints").to_pylist()))


def _asked(step: str, buckets: int):
    """What a block has to say about its suffixes: their extents, or the windows of those extents that are not settled."""
    @lean
    def run(key: tuple, block: pa.Table, replies: pa.Table) -> pa.Table:
        out, number = [], key[0].as_py()
        known = _replies(replies, "stem" if step == "extents" else "open")
        for row in block.select(["lens", "payload"]).to_pylist() if len(known) else []:
            first_column, second_column = [np.empty(0, np.uint64)], [np.empty(0, np.uint64)]
            for _, chunk, stems, first, last in Block(row["payload"], row["lens"]).suffixes():
                if step == "extents":
                    hit = member(stems, known)
                    first_column.append(stems[hit])
                    second_column.append(extents(chunk, first[hit], last[hit]))
                else:
                    hit = member(extents(chunk, first, last), known)
                    starts = spread(first[hit], last[hit])
                    first_column.append(chunk.prints(starts, starts + LENGTH))
            if step == "extents":
                stems, whole = np.concatenate(first_column), np.concatenate(second_column)
                whole, at = np.unique(whole, return_index=True)  # equal extents have equal stems
                out.append(_bucketed(number, buckets, stems[at], whole))
            else:
                out.append(_bucketed(number, buckets, np.unique(np.concatenate(first_column))))
        schema = pa.schema([("bucket", pa.int64()), ("block", pa.int64()), ("v0", pa.binary())] + [("v1", pa.binary())] * (step == "extents"))
        return pa.Table.from_batches(out, schema)
    return run


def _per_row(rows: pa.Table) -> np.ndarray:
    return np.repeat(np.array(rows.column("block").to_pylist(), np.int64), [len(c) // 8 for c in rows.column("v0").to_pylist()])


@lean
def _settle_extents(key: tuple, rows: pa.Table) -> pa.Table:
    """An extent that an earlier block holds is gone; its first block answers for it, window by window if the stem has other extents."""
    stems, whole, block = _numbers(rows.column("v0").to_pylist()), _numbers(rows.column("v1").to_pylist()), _per_row(rows)
    order = np.lexsort((block, whole, stems))
    stems, whole, block = stems[order], whole[order], block[order]
    at, ends = runs(stems)
    new = np.append(True, whole[1:] != whole[:-1])[:len(whole)]
    new[at] = True
    several = np.repeat(np.add.reduceat(new.astype(np.int64), at) > 1, ends - at) if len(at) else new
    return pa.concat_tables([_by_block(block[~new], "gone", whole[~new]), _by_block(block[new & several], "open", whole[new & several])])


@lean
def _settle_windows(key: tuple, rows: pa.Table) -> pa.Table:
    prints, block = _numbers(rows.column("v0").to_pylist()), _per_row(rows)
    order = np.lexsort((block, prints))
    prints, block = prints[order], block[order]
    later = np.append(False, prints[1:] == prints[:-1])[:len(prints)]
    return _by_block(block[later], "window", prints[later])


def covered(block: Block, replies: pa.Table) -> np.ndarray:
    """The bytes of a block that a repeated window covers."""
    gone, open_, windows = (_replies(replies, k) for k in ("gone", "open", "window"))
    at, stems, first, last, whole = [], [], [], [], []
    for offset, chunk, s, a, b in block.suffixes():
        at.append(np.full(len(s), offset))
        stems.append(s)
        first.append(a + offset)
        last.append(b + offset)
        whole.append(extents(chunk, a, b))
    edges = np.zeros(len(block.x) + 1, np.int32)
    if not at:
        return edges[:-1] > 0
    at, stems, first, last, whole = (np.concatenate(v) for v in (at, stems, first, last, whole))
    lost = member(whole, gone)
    np.add.at(edges, first[lost], 1)
    np.add.at(edges, last[lost] + LENGTH, -1)
    # repeats inside the block, and windows that the settled extents leave open
    ranked = np.sort(stems)
    twice = member(stems, np.unique(ranked[1:][ranked[1:] == ranked[:-1]]))
    look = twice | (member(whole, open_) & ~lost)
    starts, prints, ask = [], [], []
    for offset, chunk, _ in block.chunks():
        here = look & (at == offset)
        if here.any():
            p = spread(first[here], last[here])
            starts.append(p)
            prints.append(chunk.prints(p - offset, p - offset + LENGTH))
            ask.append(np.repeat(~lost[here], last[here] - first[here] + 1))
    if starts:
        starts, prints, ask = np.concatenate(starts), np.concatenate(prints), np.concatenate(ask)
        order = np.argsort(prints, kind="stable")  # starts ascend, so the first of equal windows leads
        later = np.zeros(len(prints), bool)
        later[order[1:]] = prints[order[1:]] == prints[order[:-1]]
        p = starts[later | (ask & member(prints, windows))]
        np.add.at(edges, p, 1)
        np.add.at(edges, p + LENGTH, -1)
    return np.cumsum(edges[:-1], dtype=np.int32) > 0


@lean
def _without(key: tuple, rows: pa.Table, replies: pa.Table) -> pa.Table:
    out: list[pa.Table] = []
    for i in range(rows.num_rows):
        block = Block(rows.column("payload")[i].as_py(), rows.column("lens")[i].as_py())
        drop = covered(block, replies)
        starts = block.ends - block.lens
        turn = drop & ~np.append(False, drop[:-1])
        border = starts[(block.lens > 0) & (starts < len(drop))]
        turn[border] = drop[border]  # runs end with their text
        runs_before, gone_before = (np.append(0, np.cumsum(x, dtype=np.int32)) for x in (turn, drop))
        removed, spans = (x[block.ends].astype(np.int64) - x[starts] for x in (gone_before, runs_before))
        kept = []
        for a, b, n in zip(starts.tolist(), block.ends.tolist(), removed.tolist(), strict=True):
            kept.append(block.bytes[a:b] if not n else block.x[a:b][~drop[a:b]].tobytes())
        out.append(pa.table({"row": rows.column("rows")[i].values, "n_bytes": pa.array(block.lens), "n_removed": pa.array(removed),
                             "n_spans": pa.array(spans), "kept": pa.array(kept, pa.binary())}))
    return pa.concat_tables(out)


def without_repeats(docs: DataFrame, text: str = "text", batches: int = BATCHES, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``row, n_bytes, n_removed, n_spans, kept`` for every document; ``row`` has its columns but ``text``.

    A byte goes if a window of 100 bytes that covers it also starts earlier:
    in a document of smaller doc_id, or earlier in its own. Windows never cross
    documents, may overlap, and are judged on the input. ``kept`` holds the
    remaining bytes, ``n_spans`` counts maximal removed runs.

    Documents stand in blocks in order of doc_id; rows of one doc_id (null is
    smaller than all) are taken in order of their text, so of repeated rows one
    stays whole. Blocks arrive in ``batches`` batches and enter the
    SuffixFamily. Blocks, not documents, are named in the arrays: copies inside
    a block say everything once, and a passage that is everywhere has one entry
    a block. Null text: empty. An empty table gives no rows. All columns are
    carried in ``row``, whatever their names.
    """
    cut = blocks(docs, text, block_bytes)
    all_blocks = cut.df
    parts, total = all_blocks.agg(F.max("part"), F.sum(F.aggregate("lens", F.lit(0).cast("long"), lambda a, x: a + x))).first()
    buckets = max(1, math.ceil((total or 0) / block_bytes))
    family, matches = SuffixFamily(buckets), []
    for i in range(batches):
        batch = all_blocks.where(F.floor(F.col("part") * batches / ((parts or 0) + 1)) == i)
        matches += family.add(batch)
    family.drop()
    stems = matches[0]
    for m in matches[1:]:
        stems = stems.union(m)
    by_block = all_blocks.groupBy("block")

    def exchange(replies: DataFrame, step: str, schema: str, settle: Callable) -> DataFrame:
        asked = by_block.cogroup(replies.groupBy("block")).applyInArrow(_asked(step, buckets), schema)
        return Cut(asked.groupBy("bucket").applyInArrow(settle, MATCHES), step).df
    settled = exchange(stems, "extents", "bucket long, block long, v0 binary, v1 binary", _settle_extents)
    windows = exchange(settled.where("kind = 'open'"), "windows", "bucket long, block long, v0 binary", _settle_windows)
    row = all_blocks.schema["rows"].dataType.elementType.simpleString()
    return by_block.cogroup(settled.union(windows).groupBy("block")).applyInArrow(
        _without, f"row {row}, n_bytes long, n_removed long, n_spans long, kept binary")


@lean
def _readable(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [b.decode("utf-8", "ignore") for b in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["row", "text"])


def remove_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with repeated bytes gone from ``text`` and ``n_chars`` (where there is one) counted anew; rows stay.

    Characters of which only some bytes are left go whole. Null texts become empty.
    """
    found = without_repeats(docs).select("row", "kept")
    row = found.schema["row"].dataType.simpleString()
    kept = found.mapInArrow(_readable, f"row {row}, text string")
    columns = [F.col("text") if c == "text" else F.length("text").cast(dict(docs.dtypes)[c]).alias(c) if c == "n_chars" else F.col("row")[c].alias(c)
               for c in docs.columns]
    return kept.select(*columns)
