"""Byte-level BPE: longest matches are proposed, neighbours are checked, only failing words are merged."""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Iterator
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from regwise.llm.common import forgets, id_and_text, passes

WORDS_KEPT = 150_000  # of a memory of encoded words, before those not asked for since the last turn go
PASS_BYTES = 1 << 20  # of text that is cut into words at once
NEVER = np.int64(1 << 60)
# The pre-tokenizer's classes within Latin-1 (space, letters, numbers); beyond
# Latin-1 the library cuts the text, so that its Unicode tables hold.
_S, _L, _N = "\\t-\\r \\x85\\xa0", "A-Za-z\\xaa\\xb5\\xba\\xc0-\\xd6\\xd8-\\xf6\\xf8-\\xff", "0-9\\xb2\\xb3\\xb9\\xbc-\\xbe"
LATIN_WORDS = re.compile(f"'(?:s|t|re|ve|m|ll|d)| ?[{_L}]+| ?[{_N}]+| ?[^{_S}{_L}{_N}]+|[{_S}]+(?![^{_S}])|[{_S}]+")
BEYOND_LATIN = re.compile("[^\\x00-\\xff]")
# white space other than single spaces and line breaks between words
UNEVEN = ("  ", " \n", "\n ", "\n\n", "\t", "\r", "\x0b", "\x0c", "\x85", "\xa0")


def byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in byte-level vocabularies: printable ones for themselves, the rest from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Codec:
    """Vocabulary and merges of a byte-level BPE file of the tokenizers library."""

    def __init__(self, path: str):
        spec = json.load(open(path, encoding="utf-8"))
        letters = byte_letters()
        raw = {t: bytes(letters[c] for c in t) for t in spec["model"]["vocab"]}
        ids = {raw[t]: i for t, i in spec["model"]["vocab"].items()}
        size = 1 + max([*ids.values(), *(a["id"] for a in spec["added_tokens"])])
        self.size, self.ids = size, ids
        self.bytes = [b""] * size
        for t, i in ids.items():
            self.bytes[i] = t
        self.rank = np.full(size, -1, np.int64)  # when the token is made; -1 for single bytes
        self.left, self.right = np.zeros(size, np.int64), np.zeros(size, np.int64)
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            a, b = (raw[x] for x in (pair if isinstance(pair, list) else pair.split(" ")))
            made = ids[a + b]
            self.merges[ids[a], ids[b]] = (rank, made)
            self.rank[made], self.left[made], self.right[made] = rank, ids[a], ids[b]
        pairs = np.array([(a * size + b, r) for (a, b), (r, _) in self.merges.items()], np.int64).reshape(-1, 2)
        pairs = pairs[np.argsort(pairs[:, 0])]
        self._pairs, self._ranks = np.append(pairs[:, 0], NEVER), np.append(pairs[:, 1], NEVER)
        made = np.flatnonzero(self.rank >= 0)
        steady = self._apart(self.left[made], self.right[made], inside=True)
        unsteady = {self.bytes[i] for i in made[~steady]}
        self.propose = {t: i for t, i in ids.items() if t not in unsteady}
        self.longest = [0] * 256
        for t in self.propose:
            self.longest[t[0]] = max(self.longest[t[0]], len(t))
        self.added = {a["content"]: a["id"] for a in spec["added_tokens"]}
        for t, i in self.added.items():
            self.bytes[i] = t.encode()
        self.find_added = re.compile("(" + "|".join(map(re.escape, self.added)) + ")") if self.added else None
        self.path = path
        self.words: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    @cached_property
    def library(self) -> Tokenizer:
        return Tokenizer.from_file(self.path)

    def _apart(self, a: np.ndarray, b: np.ndarray, inside: bool = False) -> np.ndarray:
        """For each pair of neighbours: no merge ever joins bytes across their border.

        Both tokens are taken apart along the border, the one that was made
        later first. While two parts lie side by side, their merge happens if
        its rank comes before the merge that uses up either part; equal ranks
        go to the left. ``inside`` skips the whole pair itself: then the
        question is whether nothing else crosses before it is merged.
        """
        good, at = np.ones(len(a), bool), np.arange(len(a))
        x, y = a.astype(np.int64), b.astype(np.int64)
        x_ends, y_ends = np.full(len(a), NEVER), np.full(len(a), NEVER)
        first = inside
        while len(at):
            key = x * self.size + y
            k = np.searchsorted(self._pairs, key)
            rank = np.where(self._pairs[k] == key, self._ranks[k], NEVER)
            crossed = (rank < x_ends) & (rank <= y_ends) & (rank < NEVER)
            if first:
                crossed[:], first = False, False
            good[at[crossed]] = False
            rx, ry = self.rank[x], self.rank[y]
            go = ~crossed & ((rx >= 0) | (ry >= 0))
            at, x, y, x_ends, y_ends, rx, ry = (v[go] for v in (at, x, y, x_ends, y_ends, rx, ry))
            take_x = rx > ry
            x_ends, y_ends = np.where(take_x, rx, x_ends), np.where(take_x, y_ends, ry)
            x, y = np.where(take_x, self.right[x], x), np.where(take_x, y, self.left[y])
        return good

    def longest_matches(self, word: bytes) -> list[int]:
        out, at, end = [], 0, len(word)
        propose, longest = self.propose, self.longest
        while at < end:
            for stop in range(min(end, at + longest[word[at]]), at, -1):
                i = propose.get(word[at:stop])
                if i is not None:
                    out.append(i)
                    at = stop
                    break
            else:
                raise ValueError("a byte without a token")
        return out

    def merge(self, word: bytes) -> list[int]:
        """Exact merging: the lowest rank first, from the left among equals."""
        ids: list[int] = [self.ids[word[i:i + 1]] for i in range(len(word))]
        n, merges = len(ids), self.merges
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(m[0], i, ids[i], ids[i + 1], m[1]) for i in range(n - 1) if (m := merges.get((ids[i], ids[i + 1])))]
        heapq.heapify(heap)
        while heap:
            _, i, a, b, made = heapq.heappop(heap)
            j = after[i]
            if j >= n or ids[i] != a or ids[j] != b:
                continue
            ids[i], ids[j] = made, -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if m := merges.get((made, ids[k])):
                    heapq.heappush(heap, (m[0], i, made, ids[k], m[1]))
            if (h := before[i]) >= 0 and (m := merges.get((ids[h], made))):
                heapq.heappush(heap, (m[0], h, ids[h], made, m[1]))
        return [i for i in ids if i >= 0]

    def learn(self, words: list[str]) -> int:
        """Encode words into the memory; returns how many needed exact merging."""
        raw = [w.encode() for w in words]
        proposed = [self.longest_matches(w) for w in raw]
        flat = np.array([i for p in proposed for i in p], np.int64)
        ends = np.cumsum([len(p) for p in proposed])
        inner = np.ones(len(flat), bool)
        inner[ends - 1] = False  # the last token of a word has no neighbour
        at = np.flatnonzero(inner)
        pairs, where = np.unique(flat[at] * self.size + flat[at + 1], return_inverse=True)
        apart = self._apart(pairs // self.size, pairs % self.size)
        failing = np.unique(np.searchsorted(ends, at[~apart[where]], side="right"))
        for k in failing.tolist():
            proposed[k] = self.merge(raw[k])
        for w, p in zip(words, proposed, strict=True):
            self.words[w] = np.array(p, "<u4").tobytes()
        return len(failing)

    def split(self, text: str) -> list[str]:
        if BEYOND_LATIN.search(text):
            return [text[a:b] for _, (a, b) in self.library.pre_tokenizer.pre_tokenize_str(text)]
        return LATIN_WORDS.findall(text)

    def is_even(self, text: str) -> bool:
        """Latin-1 text in which single spaces or line breaks part the words, without strings of added tokens.

        A space before a word always opens that word's first token, and a line
        break between two words is a token, so the runs between them can be
        encoded one by one, whatever stands around them.
        """
        if any(u in text for u in UNEVEN) or text[-1:] == " " or any(a in text for a in self.added):
            return False
        return text.isascii() or not BEYOND_LATIN.search(text)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers; strings of added tokens become their ids."""
        cut: list[list[tuple[str, list[str]]]] = []
        for text in texts:
            parts = self.find_added.split(text) if self.find_added else [text]
            cut.append([(p, []) if k % 2 else ("", self.split(p)) for k, p in enumerate(parts)])
        asked = {w for parts in cut for _, words in parts for w in words}
        if len(self.words) > WORDS_KEPT:
            self.older, self.words = self.words, {}
        new = asked - self.words.keys()
        again = new & self.older.keys()
        self.words.update((w, self.older[w]) for w in again)
        if len(again) < len(new):
            self.learn(list(new - again))
        known = self.words.__getitem__
        added = {t: np.array([i], "<u4").tobytes() for t, i in self.added.items()}
        return [b"".join(added[a] if a else b"".join(map(known, words)) for a, words in parts) for parts in cut]

    def decode(self, ids: bytes) -> str:
        """The text of ids, with the replacement character for bytes that are not UTF-8; unknown ids give nothing."""
        table, top = self.bytes, self.size
        return b"".join([table[i] for i in np.frombuffer(ids, "<u4").tolist() if i < top]).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    return Codec(path)


forgets(__name__, codec.cache_clear)


def vocabulary() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def encode(docs: DataFrame, path: str | None = None) -> DataFrame:
    """``doc_id, ids``: the ids of every whole text, packed as little-endian unsigned 32-bit integers.

    One row per row, in no order; a null text is empty and has no ids; only
    doc_id and text are read, so clashing columns play no part; an empty table
    gives no rows. Work is per text and grows with it; nothing is shuffled.
    """
    path = path or vocabulary()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in passes(batches, most=PASS_BYTES):
            ids = codec(path).encode(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.binary())], ["doc_id", "ids"])

    return id_and_text(docs).mapInArrow(run, "doc_id long, ids binary")


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """``doc_id, ids, text`` from ``doc_id, ids``; null ids give an empty text."""
    path = path or vocabulary()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in passes(batches, most=PASS_BYTES):
            texts = [codec(path).decode(x) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], ["doc_id", "ids", "text"])

    rows = encoded.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("ids", F.lit(b"")).alias("ids"))
    return rows.mapInArrow(run, "doc_id long, ids binary, text string")
