"""Language-model scoring by context-tree weighting over bytes, next to a unigram base."""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regwise.llm.common import Cut, lean

DEPTH = 5  # bytes of context; with the next byte and a row number they fill 64 bits
STEM = 2  # bytes of context that all windows of one subtree share
BLOCK_BYTES = 24 << 20  # of text that ask for a probability once
BUCKET_BYTES = 16 << 20  # of text whose windows, and whose tokens, meet in one bucket
PASS_BYTES, PASS_ROWS = 4 << 20, 1 << 16
END = b"\n"  # no word holds it
SMOOTH = 0.1
U = np.uint64


def stream(words: list[bytes]) -> bytes:
    """The tokens as bytes: words end with a space, the text with a line break."""
    return b" ".join(words) + b" \n" if words else END


def windows(streams: list[bytes], depth: int = DEPTH) -> tuple[np.ndarray, np.ndarray]:
    """Every byte with the ``depth`` bytes before it (line breaks before the first) as one integer, and its stream's number."""
    lead = b"\n" * depth
    joined = np.frombuffer(b"".join(x for s in streams for x in (lead, s)), np.uint8)
    size = np.array([len(s) for s in streams], np.int64)
    keys = np.zeros(max(0, len(joined) - depth), np.uint64)
    for j in range(depth + 1):
        keys <<= np.uint64(8)
        keys |= joined[j:len(keys) + j]
    # a window that starts in the lead of the next stream belongs to none
    starts = np.cumsum(size + depth) - (size + depth)
    own = np.ones(len(keys), bool)
    for j in range(depth):
        at = starts[1:] - 1 - j
        own[at] = False
    return keys[own], np.repeat(np.arange(len(streams)), size)


def _passes(texts: pa.ChunkedArray) -> Iterator[tuple[int, list[list[bytes]]]]:
    """Row numbers and words of about PASS_BYTES of text at a time."""
    start, size, held = 0, 0, []
    for i, t in enumerate(texts):
        raw = t.as_py().encode()
        held.append(raw.lower().split())  # bytes: only A-Z change, only \\x20 \\x09-\\x0D part words
        size += len(raw)
        if size >= PASS_BYTES or len(held) == PASS_ROWS:
            yield start, held
            start, size, held = i + 1, 0, []
    if held:
        yield start, held


def runs(values: np.ndarray) -> np.ndarray:
    """Where runs of equal neighbours begin."""
    return np.flatnonzero(np.append(True, values[1:] != values[:-1])) if len(values) else np.empty(0, np.int64)


def summed(keys: np.ndarray, *counts: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct keys in order and the sums of their counts."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    at = runs(keys)
    return (keys[at], *(np.add.reduceat(c[order], at) if len(at) else c[:0] for c in counts))


def subtree(windows_: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket of each window: windows with the same last STEM bytes of context go together."""
    stem = (windows_ >> U(8)) & U((1 << 8 * STEM) - 1)
    return ((stem * U(0x9E3779B97F4A7C15)) >> U(33)) % U(buckets)


def _packed(x: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(1).compress(x.tobytes())


def _unpacked(b: bytes, kind) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(b), kind)


def _differences(x: np.ndarray) -> np.ndarray:
    return np.diff(x, prepend=x[:1] * 0)


class Wanted:
    """What a block asks for: its distinct windows and tokens by bucket, in a fixed order, and their training counts."""

    def __init__(self, rows: pa.Table, depth: int, buckets: int):
        held = np.array(rows.column("held_out").to_pylist(), bool)
        trained, seen, found = Counter(), {END}, []
        for start, words in _passes(rows.column("text")):
            for w, h in zip(words, held[start:start + len(words)], strict=True):
                if h:
                    seen.update(w)
                else:
                    trained.update(w)
                    trained[END] += 1
            keys, number = windows([stream(w) for w in words], depth)
            both = np.sort((keys << U(1)) | held[start:start + len(words)][number])
            at = runs(both >> U(1))
            found.append((both[at] >> U(1), np.add.reduceat(1 - (both & U(1)).astype(np.int64), at)))
        keys, n = (np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.empty(0, np.uint64), np.empty(0, np.int64))
        keys, n = summed(keys, n)
        bucket = subtree(keys, buckets)
        order = np.argsort(bucket, kind="stable")
        self.windows, self.n, self.bucket = keys[order], n[order], bucket[order].astype(np.int64)
        by_bucket: list[list[bytes]] = [[] for _ in range(buckets)]
        seen |= trained.keys()
        for t in seen:
            by_bucket[zlib.crc32(t) % buckets].append(t)
        for part in by_bucket:
            part.sort()
        self.tokens = [t for part in by_bucket for t in part]
        self.token_n = np.array([trained[t] for t in self.tokens], np.int64)
        self.token_bucket = np.repeat(np.arange(buckets), [len(part) for part in by_bucket])

    def parts(self) -> Iterator[tuple[int, str, int, int]]:
        for kind, bucket in (("window", self.bucket), ("token", self.token_bucket)):
            at = runs(bucket)
            for a, b in zip(at.tolist(), [*at[1:].tolist(), len(bucket)], strict=True) if len(at) else []:
                yield int(bucket[a]), kind, a, b


ASKED = "bucket long, kind string, block long, keys binary, n binary"


def _asked(depth: int, buckets: int):
    @lean
    def run(key: tuple, rows: pa.Table) -> pa.Table:
        own = Wanted(rows, depth, buckets)
        out = [(bucket, kind, key[0].as_py(), _packed(_differences(own.windows[a:b])) if kind == "window" else zstandard.ZstdCompressor(1).compress(b" ".join(own.tokens[a:b])),
                _packed((own.n if kind == "window" else own.token_n)[a:b])) for bucket, kind, a, b in own.parts()]
        types = (pa.int64(), pa.string(), pa.int64(), pa.binary(), pa.binary())
        return pa.table([pa.array(c, t) for c, t in zip(zip(*out, strict=True) if out else [[]] * 5, types, strict=True)], ["bucket", "kind", "block", "keys", "n"])
    return run


def _windows_of(row: dict) -> np.ndarray:
    return np.cumsum(_unpacked(row["keys"], np.uint64), dtype=np.uint64)


def _tokens_of(row: dict) -> list[bytes]:
    return zstandard.ZstdDecompressor().decompress(row["keys"]).split(b" ")


def _all_windows(rows: list[dict]) -> tuple[np.ndarray, np.ndarray]:
    return summed(np.concatenate([_windows_of(r) for r in rows]), np.concatenate([_unpacked(r["n"], np.int64) for r in rows]))


def _all_tokens(rows: list[dict]) -> Counter:
    c: Counter = Counter()
    for r in rows:
        for t, n in zip(_tokens_of(r), _unpacked(r["n"], np.int64).tolist(), strict=True):
            c[t] += n
    return c


def estimates(n0: np.ndarray, n1: np.ndarray) -> np.ndarray:
    """Log of the Krichevsky-Trofimov probability of ``n0`` zeros and ``n1`` ones, in any order."""
    a, b = n0.astype(np.float64), n1.astype(np.float64)
    return _log_gamma(a + 0.5) + _log_gamma(b + 0.5) - _log_gamma(a + b + 1.0) - math.log(math.pi)


def _log_gamma(x: np.ndarray) -> np.ndarray:
    """Stirling's series at ``x + 8``, brought back by the recurrence; exact to about 14 digits for x > 0."""
    z, below = x + 8.0, x.copy()
    for i in range(1, 8):
        below *= x + i
    q = 1 / (z * z)
    tail = (1 / 12 - q * (1 / 360 - q * (1 / 1260 - q * (1 / 1680 - q / 1188)))) / z
    return (z - 0.5) * np.log(z) - z + 0.5 * math.log(2 * math.pi) + tail - np.log(below)


def _below(keys: np.ndarray, depth: int) -> np.ndarray:
    """Keys of the ancestors that know ``depth`` bytes of context."""
    return keys & U((1 << 8 * (depth + 1)) - 1)


def _bit_keys(windows_: np.ndarray, i: int) -> tuple[np.ndarray, np.ndarray]:
    """A node per window: its context and the byte's first ``i`` bits (behind a leading 1); and the next bit."""
    byte = windows_ & U(255)
    return ((windows_ >> U(8)) << U(8)) | U(1 << i) | (byte >> U(8 - i)), (byte >> U(7 - i)) & U(1)


class Tree:
    """Context trees of all bits, from depth STEM down, over the trained windows.

    Upward, a node's weight for its own estimate comes from that estimate and
    from the product of its children's weighted probabilities; leaves have
    weight 1. Each level holds keys in order, counts, weights and the log of
    the weighted probability.
    """

    def __init__(self, windows_: np.ndarray, n: np.ndarray, depth: int):
        keys, bits = zip(*(_bit_keys(windows_, i) for i in range(8)), strict=True)
        bit, n = np.concatenate(bits).astype(np.int64), np.tile(n, 8)
        keys, n0, n1 = summed(np.concatenate(keys), n * (1 - bit), n * bit)
        weighted = estimates(n0, n1)
        self.levels = {depth: (keys, n0, n1, np.ones(len(keys)), weighted)}
        for d in range(depth - 1, STEM - 1, -1):
            keys, n0, n1, children = summed(_below(keys, d), n0, n1, weighted)
            own = estimates(n0, n1)
            both = np.logaddexp(own, children)
            weighted = both - math.log(2)
            self.levels[d] = (keys, n0, n1, np.exp(own - both), weighted)
        self.depth = depth

    def mixed(self, so_far: np.ndarray, rest: np.ndarray) -> dict[int, np.ndarray]:
        """Per depth the probability of a 1 where the known context ends there, given the mixture above depth STEM."""
        out = {}
        for d in range(STEM, self.depth + 1):
            keys, n0, n1, weight, _ = self.levels[d]
            if d > STEM:
                up = np.searchsorted(self.levels[d - 1][0], _below(keys, d - 1))
                so_far, rest = so_far[up], rest[up]
            part = rest * (n1 + 0.5) / (n0 + n1 + 1.0)
            out[d] = so_far + part
            so_far, rest = so_far + part * weight, rest * (1 - weight)
        return out


def _gathered(depth: int):
    """Of a bucket: the nodes at depth STEM, with what is weighted below them, or the sums over its tokens."""
    @lean
    def run(key: tuple, rows: pa.Table) -> pa.Table:
        rows, out = rows.to_pylist(), []
        own = [r for r in rows if r["kind"] == "window"]
        if own:
            w, n = _all_windows(own)
            top = Tree(w[n > 0], n[n > 0], depth).levels[STEM]
            # nodes that are only asked for have no counts
            asked = np.unique(np.concatenate([_below(_bit_keys(w[n == 0], i)[0], STEM) for i in range(8)]))
            new = asked[~np.isin(asked, top[0])]
            none = np.zeros(len(new), np.int64)
            out.append(("node", np.append(top[0], new), np.append(top[1], none), np.append(top[2], none), np.append(top[4], none.astype(float))))
        own = [r for r in rows if r["kind"] == "token"]
        if own:
            c = _all_tokens(own)
            one = lambda x: np.array([x])
            out.append(("total", one(0).astype(np.uint64), one(sum(c.values())), one(sum(x > 0 for x in c.values())), one(0.0)))
        return pa.concat_tables([pa.table({"bucket": pa.array([key[0].as_py()] * len(k), pa.int64()), "kind": pa.array([kind] * len(k), pa.string()),
                                           "key": pa.array(k.view(np.int64)), "n0": pa.array(a), "n1": pa.array(b), "weighted": pa.array(x)})
                                 for kind, k, a, b, x in out])
    return run


def _answered(depth: int, n: int, v: int):
    """For each block's part of a bucket: log10 of its windows' last bytes, or the base scores of its tokens."""
    @lean
    def run(key: tuple, rows: pa.Table, heads: pa.Table) -> pa.Table:
        rows, out = rows.to_pylist(), []
        own = [r for r in rows if r["kind"] == "window"]
        if own:
            w, c = _all_windows(own)
            tree = Tree(w[c > 0], c[c > 0], depth)
            order = np.argsort(heads.column("key").to_numpy())
            top, so_far, rest, stop = (heads.column(x).to_numpy()[order] for x in ("key", "so_far", "rest", "stop"))
            at = np.searchsorted(top.view(np.uint64), tree.levels[STEM][0])
            p_at = tree.mixed(so_far[at], rest[at])
            value = np.zeros(len(w))
            for i in range(8):
                keys, bit = _bit_keys(w, i)
                p = stop[np.searchsorted(top.view(np.uint64), _below(keys, STEM))]
                for d in range(STEM, depth + 1):  # the deepest known context answers
                    known = tree.levels[d][0]
                    if len(known):
                        k = np.minimum(np.searchsorted(known, _below(keys, d)), len(known) - 1)
                        p = np.where(known[k] == _below(keys, d), p_at[d][k], p)
                value += np.log10(np.where(bit == 1, p, 1 - p))
            out += [(r["block"], "window", key[0].as_py(), _packed(value[np.searchsorted(w, _windows_of(r))])) for r in own]
        own = [r for r in rows if r["kind"] == "token"]
        if own:
            c = _all_tokens(own)
            out += [(r["block"], "token", key[0].as_py(), _packed(np.array([c[t] for t in _tokens_of(r)], np.int64))) for r in own]
        types = (pa.int64(), pa.string(), pa.int64(), pa.binary())
        return pa.table([pa.array(x, t) for x, t in zip(zip(*out, strict=True) if out else [[]] * 4, types, strict=True)], ["block", "kind", "bucket", "answers"])
    return run


def _scores(depth: int, buckets: int, n: int, v: int):
    @lean
    def run(key: tuple, rows: pa.Table, answers: pa.Table) -> pa.Table:
        own = Wanted(rows, depth, buckets)
        got = {(r["bucket"], r["kind"]): r["answers"] for r in answers.to_pylist()}
        value, count = np.zeros(len(own.windows)), np.zeros(len(own.tokens), np.int64)
        for bucket, kind, a, b in own.parts():
            if kind == "window":
                value[a:b] = _unpacked(got[bucket, kind], np.float64)
            else:
                count[a:b] = _unpacked(got[bucket, kind], np.int64)
        order = np.argsort(own.windows)
        keys, value = own.windows[order], value[order]
        logs = np.log10((count + SMOOTH) / (n + SMOOTH * (v + 1)))
        unknown = math.log10(SMOOTH / (n + SMOOTH * (v + 1)))
        logs[count == 0] = unknown
        base = dict(zip(own.tokens, logs.tolist(), strict=True))
        out: list[tuple] = []
        for _, words in _passes(rows.column("text")):
            streams = [stream(w) for w in words]
            window, number = windows(streams, depth)
            # in order of windows, so that each distinct one is looked up once
            both = np.sort((window << U(16)) | number.astype(np.uint64))
            window, number = both >> U(16), (both & U(0xFFFF)).astype(np.int64)
            at = runs(window)
            each = value[np.searchsorted(keys, window[at])]
            score = np.bincount(number, np.repeat(each, np.diff(np.append(at, len(window)))), len(words))
            for w, s, x in zip(words, streams, score.tolist(), strict=True):
                found = [*map(base.__getitem__, w), base[END]]
                out.append((len(found), len(found) - found.count(unknown), math.fsum(found), x, len(s)))
        types = (pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.int64())
        columns = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)]
        return pa.table([rows.column("doc_id"), rows.column("held_out"), *columns], ["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score", "n_bytes"])
    return run


def log_gamma(x: Column) -> Column:
    """Stirling's series at ``x + 8``, brought back by the recurrence; exact to about 14 digits for x > 0."""
    z, below = x + 8.0, x
    for i in range(1, 8):
        below = below * (x + float(i))
    q = 1 / (z * z)
    tail = (1 / 12 - q * (1 / 360 - q * (1 / 1260 - q * (1 / 1680 - q / 1188)))) / z
    return (z - 0.5) * F.log(z) - z + F.lit(0.5 * math.log(2 * math.pi)) + tail - F.log(below)


def log_estimate(n0: Column, n1: Column) -> Column:
    """Log of the Krichevsky-Trofimov probability of ``n0`` zeros and ``n1`` ones, in any order."""
    a, b = n0.cast("double"), n1.cast("double")
    return log_gamma(a + 0.5) + log_gamma(b + 0.5) - log_gamma(a + b + 1.0) - F.lit(math.log(math.pi))


def _heads(nodes: DataFrame) -> DataFrame:
    """``bucket, key, so_far, rest, stop`` for each node at depth STEM: the mixture of the shallower nodes on its path.

    These levels have at most 255 nodes for each context of one byte and of
    none, so the sums are small whatever the corpus; the same recursion as in
    ``Tree`` runs on them as aggregations and joins.
    """
    below = lambda depth: F.col("key").bitwiseAND(F.lit((1 << 8 * (depth + 1)) - 1))
    level, levels = nodes.where("n0 + n1 > 0").select("key", "n0", "n1", "weighted"), []
    for d in reversed(range(STEM)):
        up = level.groupBy(below(d).alias("key")).agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"), F.sum("weighted").alias("children"))
        up = up.withColumn("own", log_estimate(F.col("n0"), F.col("n1")))
        larger = F.greatest("own", "children")
        both = larger + F.log(F.exp(F.col("own") - larger) + F.exp(F.col("children") - larger))
        level = Cut(up.select("key", "n0", "n1", F.exp(F.col("own") - both).alias("weight"), (both - math.log(2)).alias("weighted")), "nodes").df
        levels.append(level)
    estimate = F.col("rest") * (F.col("n1") + 0.5) / (F.col("n0") + F.col("n1") + 1.0)
    out = nodes.select("bucket", "key", F.lit(0.0).alias("so_far"), F.lit(1.0).alias("rest"), F.lit(0.5).alias("stop"))
    for d, level in enumerate(reversed(levels)):
        here = level.select(F.col("key").alias("k"), "n0", "n1", "weight")
        part = F.coalesce(estimate, F.lit(0.0))
        out = out.join(here, below(d) == F.col("k"), "left").select(
            "bucket", "key", (F.col("so_far") + part * F.coalesce("weight", F.lit(0.0))).alias("so_far"),
            (F.col("rest") * (1 - F.coalesce("weight", F.lit(0.0)))).alias("rest"),
            F.when(F.col("k").isNull(), F.col("stop")).otherwise(F.col("so_far") + part).alias("stop"))
    return out


def scores(docs: DataFrame, depth: int = DEPTH, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, n_bytes`` for every text.

    ``score`` is the log10 probability of the lower-cased token stream (words
    closed by a space, the text by a line break) under a context tree for each
    bit of a byte, with up to ``depth`` bytes of context across word borders,
    learnt from the texts that are not held out; ``-score / n_bytes`` is the
    code length per byte. A context that no training text holds ends at its
    longest known part. ``base_score`` is that of a smoothed unigram model.

    Texts are dealt into blocks by hash. A block asks for each of its distinct
    windows (a byte and its context) and tokens once, packed by bucket; in the
    buckets, counts of all blocks meet and the trees are built, a subtree for
    each last ``STEM`` bytes of context, and the answers go back to the blocks.
    So a frequent window or word is one entry a block, and a subtree holds
    distinct windows, not occurrences. Nothing is broadcast by hint, capped or
    sampled; the counts of all training texts enter.

    One row per row. Null text: empty, one token. The id of a null doc_id is
    the empty text (held out). Repeated rows count as often as they stand
    there. Other columns are not read; an empty table gives no rows; without
    training texts every bit has even odds.
    """
    if not STEM <= depth <= DEPTH:
        raise ValueError(f"depth must lie between {STEM} and {DEPTH}")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    total = rows.agg(F.sum(F.octet_length("text") + F.lit(8))).first()[0] or 0
    blocks, buckets = max(1, math.ceil(total / block_bytes)), max(1, math.ceil(total / min(BUCKET_BYTES, block_bytes)))
    held = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 10 == 0
    dealt = rows.select("doc_id", "text", held.alias("held_out"), F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)).alias("block"))
    asked = Cut(dealt.groupBy("block").applyInArrow(_asked(depth, buckets), ASKED), "asked").df
    gathered = Cut(asked.groupBy("bucket").applyInArrow(_gathered(depth), "bucket long, kind string, key long, n0 long, n1 long, weighted double"), "nodes").df
    n, v = gathered.where("kind = 'total'").agg(F.coalesce(F.sum("n0"), F.lit(0)), F.coalesce(F.sum("n1"), F.lit(0))).first()
    heads = _heads(gathered.where("kind = 'node'"))
    answers = Cut(asked.groupBy("bucket").cogroup(heads.groupBy("bucket")).applyInArrow(
        _answered(depth, n, v), "block long, kind string, bucket long, answers binary"), "answers").df
    scored = dealt.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        _scores(depth, buckets, n, v), "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double, n_bytes long")
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"), "base_score", "score", "n_bytes")
