"""Cross-tokenizer alignment: windows between white-space anchors, aligned once per pair of id tuples."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regwise.llm.bpe import vocabulary
from regwise.llm.common import Cut, forgets, id_and_text, lean, passes
from regwise.llm.packing import Encoder

BLOCK_BYTES = 1 << 20  # of text whose distinct id pairs are counted together; a longer text is a block of its own
IDS_KEPT = 1_000_000  # in memorised windows, before the memory starts anew
WIDE = 4096  # links of a group beyond which its ids are counted before they are paired
PAIR = np.int64(1) << np.int64(32)


class PlainEncoder(Encoder):
    """Byte-level ids in which strings of special tokens are ordinary text."""

    def __init__(self, path: str):
        super().__init__(path)
        self.added, self.find_added = {}, None


def piece_bytes(model: sentencepiece.SentencePieceProcessor) -> list[bytes]:
    """The bytes each piece stands for: U+2581 is a space, <0xHH> one byte."""
    out = []
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        out.append(bytes([int(piece[3:5], 16)]) if model.is_byte(i) else piece.replace("▁", " ").encode())
    return out


class Windows:
    """Alignments of windows, one for each pair of id tuples, and what all texts share of them."""

    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = PlainEncoder(path_a), sentencepiece.SentencePieceProcessor(model_file=path_b)
        tables = self.a.bytes, piece_bytes(self.b)
        self.size_a, self.size_b = (np.array([len(t) for t in table], np.int64) for table in tables)
        # all bytes of a vocabulary, where each token begins, and its length
        self.table_a, self.table_b = ((np.frombuffer(b"".join(table), np.uint8), np.cumsum(size) - size, size)
                                      for table, size in zip(tables, (self.size_a, self.size_b), strict=True))
        self.written = [f"{i}{mark}" for i in range(max(map(len, tables))) for mark in ",|;"]
        self.marked_a, self.marked_b = (np.array([t[:1] == b" " for t in table]) for table in tables)
        self.forget()

    def forget(self) -> None:
        self.known: dict[tuple[bytes, bytes], int] = {}
        self.groups: list[str] = []
        self.n_groups: list[int] = []
        self.ends, self.pairs, self.times = (np.zeros(n, np.int64) for n in (1, 0, 0))
        self.ids = 0

    def learn(self, keys: list[tuple[bytes, bytes]]) -> None:
        """Aligns new windows from their ids alone and keeps their groups, and their linked id pairs with how often each is linked."""
        a, b = (np.frombuffer(b"".join([k[side] for k in keys]), "<i4").astype(np.int64) for side in (0, 1))
        ends_a, ends_b = np.cumsum(self.size_a[a]), np.cumsum(self.size_b[b])
        shared = np.intersect1d(ends_a, ends_b, assume_unique=True)
        of_a, of_b = np.searchsorted(shared, ends_a), np.searchsorted(shared, ends_b)
        close_a, close_b = (np.searchsorted(of, np.arange(len(shared)), "right") for of in (of_a, of_b))
        n_a, n_b = np.diff(close_a, prepend=0), np.diff(close_b, prepend=0)
        last = np.searchsorted(close_a, np.cumsum([len(k[0]) // 4 for k in keys])) + 1  # group behind each window
        window = np.repeat(np.arange(len(keys)), np.diff(last, prepend=0))
        # written in order: the A ids of a group, then its B ids, each with the mark behind it
        at_a, at_b = np.arange(len(a)) + (close_b - n_b)[of_a], np.arange(len(b)) + close_a[of_b]
        written = np.empty(len(a) + len(b), np.int64)
        written[at_a], written[at_b] = 3 * a, 3 * b
        written[at_a[close_a - 1]] += 1
        written[at_b[close_b - 1]] += 2
        text = [*map(self.written.__getitem__, written.tolist())]
        stop = (close_a + close_b)[last - 1].tolist()
        self.groups += ["".join(text[s:e])[:-1] for s, e in zip([0, *stop], stop)]
        self.n_groups += np.diff(last, prepend=0).tolist()
        # every A id of a group with every B id; a long group by its distinct ids
        wide = np.flatnonzero(n_a * n_b > WIDE)
        n_pairs = n_a * n_b
        n_pairs[wide] = 0
        group = np.repeat(np.arange(len(shared)), n_pairs)
        k = np.arange(len(group)) - np.repeat(np.cumsum(n_pairs) - n_pairs, n_pairs)
        x, y = a[(close_a - n_a)[group] + k // n_b[group]], b[(close_b - n_b)[group] + k % n_b[group]]
        held, pairs, times = [window[group]], [x * PAIR + y], [np.ones(len(group), np.int64)]
        for g in wide.tolist():
            (u, n), (v, m) = (np.unique(ids[end - size:end], return_counts=True) for ids, end, size in ((a, close_a[g], n_a[g]), (b, close_b[g], n_b[g])))
            held.append(np.full(len(u) * len(v), window[g]))
            pairs.append((u[:, None] * PAIR + v).ravel())
            times.append((n[:, None] * m).ravel())
        held, pairs, times = map(np.concatenate, (held, pairs, times))
        order = np.lexsort((pairs, held))
        held, pairs, times = held[order], pairs[order], times[order]
        first = np.flatnonzero(np.append(True, (np.diff(held) != 0) | (np.diff(pairs) != 0)))
        self.pairs = np.concatenate([self.pairs, pairs[first]])
        self.times = np.concatenate([self.times, np.add.reduceat(times, first)])
        self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(np.bincount(held[first], minlength=len(keys)))])
        self.ids += len(a) + len(b) + len(first)

    def tokens(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """For both vocabularies all ids and the ids of each text; a text has none where either does not give it back behind a space."""
        full = [" " + t for t in texts]
        raw = [t.encode() for t in full]
        size = np.array([len(r) for r in raw], np.int64)
        sides = []
        for ids, table in (([np.frombuffer(x, "<i4") for x in self.a.encode(full)], self.table_a),
                           ([np.array(x, np.int32) for x in self.b.encode(texts, num_threads=1)], self.table_b)):
            ids = [x if t else x[:0] for x, t in zip(ids, texts, strict=True)]
            sides.append((np.concatenate([np.empty(0, np.int32), *ids]), np.array([len(x) for x in ids], np.int64), table))
        same = np.array([bool(t) for t in texts])
        for ids, n, (flat, at, length) in sides:
            of = np.repeat(np.arange(len(texts)), n)
            same &= np.bincount(of, length[ids], len(texts)).astype(np.int64) == size
            ids = ids[same[of]]  # of one size with their text, so bytes can be compared one by one
            ends = np.cumsum(length[ids])
            given = flat[np.repeat(at[ids] - ends + length[ids], length[ids]) + np.arange(ends[-1] if len(ends) else 0)]
            want = np.frombuffer(b"".join([r for r, s in zip(raw, same) if s]), np.uint8)
            differ = np.repeat(np.flatnonzero(same), size[same])[given != want]
            same[differ] = False
        return [(ids[same[np.repeat(np.arange(len(texts)), n)]], np.where(same, n, 0)) for ids, n, _ in sides]

    def numbers(self, a: np.ndarray, b: np.ndarray, at_a: np.ndarray, at_b: np.ndarray) -> np.ndarray:
        """The number of each window, from ids ``a`` and ``b`` and the windows' first places; new ones are aligned.

        Equal windows are found by a hash of their ids and compared id by id
        with the first of them, which alone is looked up by its two tuples.
        """
        if not len(at_a):
            return np.empty(0, np.int64)
        sides, key, equal = [], np.zeros(len(at_a), np.uint64), np.ones(len(at_a), bool)
        for ids, at, odd in ((a, at_a, 0x9E3779B97F4A7C15), (b, at_b, 0xC2B2AE3D27D4EB4F)):
            n = np.diff(np.append(at, len(ids)))
            within = np.arange(len(ids)) - np.repeat(at, n)
            powers = np.multiply.accumulate(np.full(int(n.max()), odd, np.uint64))
            key ^= np.add.reduceat((ids.astype(np.uint64) + np.uint64(1)) * powers[within], at) * np.uint64(odd)
            sides.append((ids, at, n, within))
        _, first, group = np.unique(key, return_index=True, return_inverse=True)
        model = first[group]
        for ids, at, n, within in sides:
            equal &= n == n[model]
            checked = np.repeat(equal, n)
            differ = ids[checked] != ids[(np.repeat(at[model], n) + within)[checked]]
            equal[np.repeat(np.arange(len(at)), n)[checked][differ]] = False
        # windows that share a hash only are looked up one by one
        asked = np.append(first, np.flatnonzero(~equal))
        (raw_a, cut_a, end_a), (raw_b, cut_b, end_b) = ((ids.tobytes(), (4 * at[asked]).tolist(), (4 * (at + n)[asked]).tolist()) for ids, at, n, _ in sides)
        known, found, new = self.known, [], []
        for s, e, t, u in zip(cut_a, end_a, cut_b, end_b, strict=True):
            window = raw_a[s:e], raw_b[t:u]
            number = known.get(window)
            if number is None:
                number = known[window] = len(known)
                new.append(window)
            found.append(number)
        if new:
            self.learn(new)
        found = np.array(found, np.int64)
        out = found[:len(first)][group]
        out[~equal] = found[len(first):]
        return out

    def aligned(self, texts: list[str]) -> dict:
        """Per text its counts and groups, and the distinct linked pairs of all texts with the texts that hold them."""
        if self.ids > IDS_KEPT:
            self.forget()
        (a, n_a), (b, n_b) = self.tokens(texts)
        start_a, start_b = (np.cumsum(size[ids]) - size[ids] for size, ids in ((self.size_a, a), (self.size_b, b)))
        # a text opens with a space in both, so its start is an anchor
        anchors = np.intersect1d(start_a[self.marked_a[a]], start_b[self.marked_b[b]], assume_unique=True)
        at_a, at_b = np.searchsorted(start_a, anchors), np.searchsorted(start_b, anchors)
        w = self.numbers(a, b, at_a, at_b)
        windows = w.tolist()
        opens = np.searchsorted(at_a, np.cumsum(n_a) - n_a)
        closes = np.searchsorted(at_a, np.cumsum(n_a))
        text_of = np.repeat(np.arange(len(texts)), closes - opens)
        n_groups = np.bincount(text_of, np.array(self.n_groups, np.int64)[w] if len(w) else None, len(texts)).astype(np.int64)
        groups = [";".join(map(self.groups.__getitem__, windows[s:e])) for s, e in zip(opens.tolist(), closes.tolist())]
        # windows of a text, then pairs of a text, each with its number of times
        cells, often = np.unique(text_of * max(1, len(self.groups)) + w, return_counts=True)
        cell_text, cell_window = np.divmod(cells, max(1, len(self.groups)))
        ends = self.ends
        width = np.diff(ends)[cell_window] if len(cells) else np.empty(0, np.int64)
        at = np.arange(width.sum()) + np.repeat(ends[cell_window] - np.cumsum(width) + width, width)
        pairs, index = np.unique(self.pairs[at], return_inverse=True)
        n = max(1, len(pairs))
        held, which = np.unique(np.repeat(cell_text, width) * n + index, return_inverse=True)
        times = np.zeros(len(held), np.int64)
        np.add.at(times, which, self.times[at] * np.repeat(often, width))
        held_text, held_pair = np.divmod(held, n)
        n_links = np.zeros(len(texts), np.int64)
        np.add.at(n_links, held_text, times)
        return {"n_a": n_a, "n_b": n_b, "n_groups": n_groups, "n_links": n_links, "groups": groups, "pairs": pairs,
                "holders": np.bincount(held_pair, minlength=len(pairs)).astype(np.int64), "held_text": held_text, "held_pair": held_pair, "times": times}


@lru_cache(maxsize=1)
def windows(path_a: str, path_b: str) -> Windows:
    return Windows(path_a, path_b)


forgets(__name__, windows.cache_clear)


COUNTS = ("n_a", "n_b", "n_groups", "n_links")
BLOCK = ("block long, pairs array<long>, holders array<long>, doc_id array<long>, " + ", ".join(f"{c} array<long>" for c in COUNTS)
         + ", digest array<string>, groups array<string>, held_text binary, held_pair binary, times binary")


def _blocks(path_a: str, path_b: str, block_bytes: int, spans: bool) -> Callable:
    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seq = 0
        for batch in passes(batches, most=block_bytes):
            found = windows(path_a, path_b).aligned(batch.column(1).to_pylist())
            digest = [hashlib.sha256(g.encode()).hexdigest() if g else "" for g in found["groups"]]
            lists = [found["pairs"], found["holders"], batch.column(0), *(found[c] for c in COUNTS), digest, found["groups"] if spans else [None] * len(digest)]
            types = [pa.int64()] * 7 + [pa.string()] * 2
            columns = [pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x if isinstance(x, pa.Array) else pa.array(x, t)) for x, t in zip(lists, types, strict=True)]
            packed = [found["held_text"].astype("<i4"), found["held_pair"].astype("<i4"), found["times"].astype("<i8")]
            yield pa.RecordBatch.from_arrays(
                [pa.array([(TaskContext.get().partitionId() << 32) + seq]), *columns, *(pa.array([x.tobytes()], pa.binary()) for x in packed)],
                [c.split()[0] for c in BLOCK.split(", ")])
            seq += 1
    return run


@lean
def _told(key: tuple, block: pa.Table, counts: pa.Table) -> pa.Table:
    """The texts of a block with the sums over their links, from the counts of the block's pairs."""
    row = block.to_pylist()[0]
    n, best = np.zeros(len(row["pairs"]), np.int64), np.zeros(len(row["pairs"]), np.int64)
    place = counts.column("place").to_numpy()
    n[place], best[place] = counts.column("n").to_numpy(), counts.column("best").to_numpy()
    text, pair, times = (np.frombuffer(row[c], t) for c, t in (("held_text", "<i4"), ("held_pair", "<i4"), ("times", "<i8")))
    sums = []
    for value in (best, n):
        total = np.zeros(len(row["doc_id"]), np.int64)
        np.add.at(total, text, times * value[pair])
        sums.append(pa.array(total))
    return pa.table([pa.array(row["doc_id"], pa.int64()), *(pa.array(row[c], pa.int64()) for c in COUNTS), *sums,
                     pa.array(row["digest"], pa.string()), pa.array(row["groups"], pa.string())],
                    ["doc_id", *COUNTS, "n_best", "count_sum", "groups_sha256", "groups"])


def counted_pairs(blocks: DataFrame) -> DataFrame:
    """``pair, n, best``: texts that hold an id pair linked, and whether no pair of its A id is held by more."""
    pairs = blocks.select(F.inline(F.arrays_zip("pairs", "holders"))).groupBy(F.col("pairs").alias("pair")).agg(F.sum("holders").alias("n"))
    pairs = Cut(pairs, "pairs").df.withColumn("a", F.shiftright("pair", 32))
    top = pairs.groupBy("a").agg(F.max("n").alias("top"))
    return pairs.join(top, "a").select("pair", "n", (F.col("n") == F.col("top")).cast("long").alias("best"))


def align(docs: DataFrame, path_a: str | None = None, path_b: str | None = None, block_bytes: int = BLOCK_BYTES, spans: bool = False) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256``, and ``groups`` with ``spans``, of every text.

    A text is tokenised whole by both vocabularies. Places where both end a
    token and both begin the next one with a space are anchors; the windows of
    ids between anchors are aligned once and remembered by their two id
    tuples. Blocks of texts count their distinct id pairs; blocks meet the
    counts of the whole corpus pair by pair, so a pair that every text holds
    is one row per block, and what comes back to a block is bounded by its own
    pairs.

    One row per row. Null and empty texts, and those that either vocabulary
    does not give back byte by byte (other white space, say), have zeros and
    an empty digest. A repeated row is a document of its own; a null doc_id
    stays null; other columns are not read; an empty table gives no rows. A
    text without anchors is one window, whatever its length.
    """
    import public_tokenizers
    path_a, path_b = path_a or vocabulary(), path_b or public_tokenizers.path("piece_bpe_32k.model")
    blocks = Cut(id_and_text(docs).mapInArrow(_blocks(path_a, path_b, block_bytes, spans), BLOCK), "aligned").df
    judged = Cut(counted_pairs(blocks), "pairs").df
    asked = blocks.select(F.col("block").alias("asker"), F.posexplode("pairs").alias("place", "pair"))
    counts = asked.join(judged, "pair").select("asker", "place", "n", "best")
    told = blocks.drop("holders").groupBy("block").cogroup(counts.groupBy("asker")).applyInArrow(
        _told, "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS) + ", n_best long, count_sum long, groups_sha256 string, groups string")
    return told if spans else told.drop("groups")
