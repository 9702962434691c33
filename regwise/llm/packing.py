"""Packing: first-fit decreasing with a tournament tree, in randomised groups of documents."""

from __future__ import annotations

import math
from array import array
from collections.abc import Callable
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regwise.llm.bpe import LATIN_WORDS, Codec, vocabulary
from regwise.llm.common import forgets, lean, passes

LENGTH, END = 2048, 1
GROUP_BYTES = 4 << 20  # of text in a group: about 600 sequences
ENCODE_BYTES = 1 << 20
RUNS_KEPT = 100_000  # new entries of a memory of encoded runs, before those not asked for since the last turn go

Piece = tuple[int, int, int]  # item, start, length


class Runs(dict):
    """Ids of runs of text without inner white space, made by a compiled library when they are first asked for."""

    def __init__(self, lead: str, merger: tiktoken.Encoding):
        super().__init__()
        self.lead, self.merger, self.older = lead, merger, {}

    def __missing__(self, run: str) -> bytes:
        if len(self) >= RUNS_KEPT:
            self.older = dict(self)
            self.clear()
        ids = self.older.get(run)
        if ids is None:
            ids = array("I", self.merger.encode_ordinary(self.lead + run)).tobytes()
        self[run] = ids
        return ids


class Encoder(Codec):
    """The same ids, where a compiled library merges what is new in even texts."""

    def __init__(self, path: str):
        super().__init__(path)
        made = np.flatnonzero(self.rank >= 0)
        # the library merges by id, so ids must follow the order of the merges
        by_id = bool((np.diff(self.rank[made]) > 0).all() and (not len(made) or (self.rank[:made[0]] < 0).all()))
        self.merger = tiktoken.Encoding("words", pat_str=LATIN_WORDS.pattern, mergeable_ranks=self.ids, special_tokens={}) if by_id else None
        # the first run of a line, and those behind a space
        self.first, self.inner = (Runs(lead, self.merger) for lead in ("", " "))
        self.line_break = np.array(self.merge(b"\n"), "<u4").tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        even = [self.merger is not None and self.is_even(t) for t in texts]
        rest = iter(super().encode([t for t, e in zip(texts, even, strict=True) if not e]))
        first, inner = self.first.__getitem__, self.inner.__getitem__

        def line(text: str) -> bytes:
            start, *more = text.split(" ")
            return first(start) + b"".join(map(inner, more))
        return [self.line_break.join(map(line, t.split("\n"))) if e else next(rest) for t, e in zip(texts, even, strict=True)]


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


forgets(__name__, encoder.cache_clear)


class Capacities:
    """Tournament tree over bins in order of opening; a node holds the larger room of its two sides."""

    def __init__(self, bins: int, room: int):
        self.half = 1 << max(0, (bins - 1).bit_length())
        self.room = [room] * (2 * self.half)

    def first_fit(self, size: int) -> int:
        """The first bin with room for ``size``, which is taken from it."""
        room, k = self.room, 1
        while k < self.half:
            k *= 2
            if room[k] < size:
                k += 1
        found = k - self.half
        room[k] -= size
        while k > 1:
            k //= 2
            room[k] = max(room[2 * k], room[2 * k + 1])
        return found


def pack(sizes: list[int], cap: int = LENGTH) -> list[list[Piece]]:
    """Sequences of pieces of items of the given sizes.

    Full lengths are cut off the front of long items. The rests go first-fit
    decreasing into bins; then pieces of the emptiest bin are cut to fill the
    gaps of the fullest, so that one bin at most is left short. That one is
    cut at powers of two, which need no padding.
    """
    out: list[list[Piece]] = [[(i, s, cap)] for i, n in enumerate(sizes) for s in range(0, n - cap + 1, cap)]
    rests = sorted(((n % cap, i) for i, n in enumerate(sizes) if n % cap), key=lambda x: (-x[0], x[1]))
    tree, bins = Capacities(len(rests), cap), []
    for size, i in rests:
        k = tree.first_fit(size)
        if k == len(bins):
            bins.append([])
        bins[k].append((i, sizes[i] - size, size))
    load = lambda b: sum(p[2] for p in b)
    bins.sort(key=load, reverse=True)
    low, high = 0, len(bins) - 1
    while low < high:
        gap = cap - load(bins[low])
        if not gap:
            low += 1
        elif not bins[high]:
            bins.pop()
            high -= 1
        else:
            i, start, n = bins[high].pop()
            if n > gap:
                bins[high].append((i, start, n - gap))
            bins[low].append((i, start + max(0, n - gap), min(n, gap)))
    short = bins.pop() if bins and load(bins[-1]) < cap else []
    left = load(short)
    while left:
        size = 1 << (left.bit_length() - 1)
        left, part = left - size, []
        while size:
            i, start, n = short.pop()
            if n > size:
                short.append((i, start + size, n - size))
            part.append((i, start, min(n, size)))
            size -= min(n, size)
        bins.append(part)
    return out + bins


def _group(path: str) -> Callable[[tuple, pa.Table], pa.Table]:
    @lean
    def run(key: tuple, rows: pa.Table) -> pa.Table:
        doc_ids = rows.column("doc_id")
        encoded: list[bytes] = []
        for batch in passes(rows.select(["text"]).to_batches(), 0, ENCODE_BYTES):
            encoded += encoder(path).encode(batch.column(0).to_pylist())
        end = np.array([END], "<u4").tobytes()
        encoded = [x + end for x in encoded]
        item, start, size, number, offset = [], [], [], [], []
        for k, sequence in enumerate(pack([len(x) // 4 for x in encoded])):
            at = 0
            for i, s, n in sequence:
                item.append(i)
                start.append(s)
                size.append(n)
                number.append((int(key[0].as_py()) << 32) + k)
                offset.append(at)
                at += n
        ids = [encoded[i][4 * s:4 * (s + n)] for i, s, n in zip(item, start, size, strict=True)]
        return pa.table({"doc_id": doc_ids.take(pa.array(item, pa.int64())), "start": pa.array(start, pa.int64()), "length": pa.array(size, pa.int64()),
                         "ids": pa.array(ids, pa.binary()), "doc_tokens": pa.array([len(encoded[i]) // 4 for i in item], pa.int64()),
                         "sequence_id": pa.array(number, pa.int64()), "offset": pa.array(offset, pa.int64())})
    return run


def sequences(docs: DataFrame, path: str | None = None, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """Pieces of packed sequences: ``doc_id, start, length, ids, doc_tokens, sequence_id, offset``.

    Every text is encoded whole and ends with one end id; a null text has the
    end id alone. Groups are drawn at random with a fixed seed, so that neither
    copies nor repeated ids gather; their number follows the bytes of text, so
    that a group has a bounded size (one text at least). Repeated rows are
    packed each for itself; a null doc_id stays null; other columns are not
    read; an empty table gives no rows. ``ids`` holds the piece's ids as
    little-endian unsigned 32-bit integers.
    """
    path = path or vocabulary()
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    total = rows.agg(F.sum(F.octet_length("text") + F.lit(8))).first()[0] or 0
    groups = max(1, math.ceil(total / group_bytes))
    dealt = rows.withColumn("g", F.floor(F.rand(2048) * groups).cast("long"))
    return dealt.groupBy("g").applyInArrow(
        _group(path), "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long")
