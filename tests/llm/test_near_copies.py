"""The near-duplicate stage against all pairs of five-word shingle sets."""

import random

from cases import TEXTS, WORD, frame, order, reach

import corpus_pipeline
from regwise.llm import near_copies


def _shingles(text):
    words = WORD.findall((text or "").lower())
    return {tuple(words[k:k + 5]) for k in range(max(1, len(words) - 4))} if words else set()


def _changed(draw, words, n):
    words = list(words)
    for k in draw.sample(range(len(words)), n):
        words[k] = f"new{draw.randrange(10**9)}"
    return words


def _near(rows):
    sets = [_shingles(t) for _, t in rows]
    pairs = [(i, j) for i in range(len(rows)) for j in range(i) if sets[i] == sets[j] or 9 * len(sets[i] & sets[j]) >= 4 * (len(sets[i]) + len(sets[j]))]
    return reach(len(rows), pairs), len(pairs)


def test_stage_finds_near_copies(spark):
    draw, rows = random.Random(5), []
    for length, n in ((100, 1), (200, 2), (200, 4), (1000, 20), (5000, 25), (200, 6), (200, 10)):
        for _ in range(12):
            words = [f"w{draw.randrange(5000)}" for _ in range(length)]
            rows += [(len(rows), " ".join(words)), (len(rows) + 1, " ".join(_changed(draw, words, n)))]
    source = [f"w{draw.randrange(5000)}" for _ in range(150)]
    rows += [(1000 + i, " ".join(_changed(draw, source, draw.randrange(9)))) for i in range(150)]  # a large group, of all similarities
    root, n_pairs = _near(rows)
    assert n_pairs > 500
    out = corpus_pipeline.near_duplicates(spark, frame(spark, [(i, t, "en", 1, *["x"] * 14) for i, t in rows]), "")
    assert sorted(r["doc_id"] for r in out.collect()) == sorted({rows[r][0] for r in root})


def test_stage_on_odd_rows(spark):
    rows = [(i, t) for i, t in TEXTS if i is not None]
    out = near_copies.keep_one(frame(spark, [(i, t, "en", 1, *["x"] * 14) for i, t in rows]))
    root, least = _near(rows)[0], {}
    for r, (i, _) in zip(root, rows):
        least[r] = min(i, least.get(r, i))
    assert order(r[:1] for r in out.collect()) == order((i,) for i in least.values())
    assert near_copies.keep_one(frame(spark, [])).count() == 0
