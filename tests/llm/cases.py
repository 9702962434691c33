"""Rows that every text operator must take, and brute-force versions to compare with."""

import hashlib
import re
from collections import Counter

import numpy as np
import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
# columns named like those that operators add
CLASHES = ["fp", "component_id", "block", "row", "version", "bits", "n_words", "ids", "g", "kinds", "value", "licence", "__id", "__found"]
SCHEMA = "doc_id long, text string, lang string, n_chars long, " + ", ".join(f"`{c}` string" for c in CLASHES)
LONG = " ".join(f"w{i % 977}x{i}" for i in range(40_000))
SAID = "The quick brown fox jumps over the lazy dog while seven wizards boil twelve pots of very old soup near the river bend"
TEXTS = [
    (1, SAID), (2, SAID.upper()), (3, SAID + " again and again"), (4, None), (5, ""), (6, " \t\n\r\x0b\x0c "), (None, SAID), (None, None), (7, LONG),
    (8, "a b a b a b a b\na b a b a b a b\n\n \na b a b a b a b"), (8, "a b a b a b a b\na b a b a b a b\n\n \na b a b a b a b"), (1, SAID),
    (9, "naïve Ünïcode 日本語 “quotes” 😀 \x00   x"), (10, "<|endoftext|> ### </turn> \\h \\\\ # * $ % & | < >"), (11, "one two"),
    (12, "É" * 120 + " " + "É" * 120), (0, "zero " * 30), (-3, LONG[:5000] + SAID),
]
ROWS = [(i, t, "en", -1, *["x"] * len(CLASHES)) for i, t in TEXTS]


def frame(spark, rows=ROWS):
    return spark.createDataFrame(rows, SCHEMA)


def order(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: tuple((x is not None, x) if not isinstance(x, dict) else repr(x) for x in r))


def repeats(rows, n=100):
    """(doc_id, n_bytes, n_removed, n_spans, sha256) by a set of all windows seen so far."""
    seen, out = set(), []
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, (r[1] or "").encode())):
        b = (t or "").encode()
        drop, end = bytearray(len(b)), 0
        for p in range(len(b) - n + 1):
            if b[p:p + n] in seen:
                for q in range(max(p, end), p + n):
                    drop[q] = 1
                end = p + n
            else:
                seen.add(b[p:p + n])
        spans = sum(1 for q in range(len(b)) if drop[q] and (q == 0 or not drop[q - 1]))
        out.append((i, b, bytes(c for c, x in zip(b, drop) if not x), spans))
    return out


def repeat_digests(rows):
    return [(i, len(b), len(b) - len(k), s, hashlib.sha256(k).hexdigest()) for i, b, k, s in repeats(rows)]


def fingerprint(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[k:k + 3]) for k in range(len(words) - 2)] if len(words) >= 3 else [" ".join(words)] if words else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def reach(n, pairs):
    """The smallest index reachable from each."""
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def near_groups(rows):
    """[(doc_id, fingerprint, component_id)] by comparing all pairs."""
    fps = np.array([fingerprint(t) for _, t in rows], np.uint64)
    pairs = [(i, int(j)) for i in range(len(fps)) for j in np.flatnonzero(np.bitwise_count(fps[i] ^ fps) <= 2)]
    root = reach(len(rows), pairs)
    least = {}
    for r, (i, _) in zip(root, rows):
        least[r] = min((x for x in (least.get(r), i) if x is not None), default=None)
    return [(i, f"{int(f):016x}", least[r]) for (i, _), f, r in zip(rows, fps, root)]


def measures(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, n_shouted."""
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
    inside = {i + k for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    shouted = sum(len(w.encode()) > 1 and bool(re.search("[A-Z]", w)) and not re.search("[a-z]", w) for w in words)
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(inside), len(lines), shouted)
