"""Vectors, conversations and the pipeline against brute force."""

import math
import random
import re
from collections import defaultdict

import numpy as np
from cases import SAID, frame, measures, near_groups, order, reach, repeats
from pyspark.sql import functions as F

import corpus_pipeline
from regwise.llm import chat, grid_join, pseudonyms, quality


def _linked(rows):
    ok = [v is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v) and any(v) for _, v in rows]
    unit = [np.array(v, float) / np.linalg.norm(np.array(v, float) / np.abs(v).max()) / np.abs(v).max() if o else None for (_, v), o in zip(rows, ok)]
    pairs = [(i, j) for i in range(len(rows)) for j in range(len(rows)) if i != j and ok[i] and ok[j] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= 0.9]
    root, least = reach(len(rows), pairs), {}
    for r, (i, _) in zip(root, rows):
        least[r] = min((x for x in (least.get(r), i) if x is not None), default=None)
    degree = defaultdict(int)
    for i, _ in pairs:
        degree[i] += 1
    return [(v, degree[i], least[root[i]], v == least[root[i]]) for i, (v, _) in enumerate(rows)]


def _vectors():
    draw = np.random.default_rng(7)
    centres = draw.normal(size=(12, 16))
    rows = [(i, (centres[i % 12] + draw.normal(size=16) * draw.choice([.05, .3, .6])).astype(np.float32).astype(float).tolist()) for i in range(240)]
    rows += [(300 + i, rows[0][1]) for i in range(40)] + [(350, [2 * x for x in rows[0][1]])]
    rows += [(400, None), (401, []), (402, [0.0] * 16), (403, [float("nan")] * 16), (404, [float("inf")] + [1.0] * 15), (405, [None] + [1.0] * 15),
             (406, [1.0, 2.0]), (407, [2.0, 4.1]), (408, [-0.0, 1.0]), (409, [0.0, 1.0]), (None, [5.0, 0.1]), (5, rows[5][1]), (410, [3e300] * 16), (411, [2e-300] * 16)]
    return rows


def test_grid_join(spark):
    rows = _vectors()
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], "vec_id long, embedding array<double>, k string, n int")
    for block_bytes in (1 << 20, 1500):
        got = grid_join.linked_vectors(df, block_bytes=block_bytes)
        assert order(got.collect()) == order(_linked(rows))
    assert grid_join.linked_vectors(df.where("false")).count() == 0
    assert order(grid_join.linked_vectors(df.where("vec_id between 400 and 403")).collect()) == [(i, 0, i, True) for i in range(400, 404)]


def test_grid_join_in_groups(spark, monkeypatch):
    """Several groups and jobs, links summed between them, single and double precision: the same answer."""
    rows = [(i, v if i == 405 or v is None else np.float32(v).tolist()) for i, v in _vectors() if i not in (410, 411)]
    monkeypatch.setattr(grid_join, "MERGE", 0)
    monkeypatch.setattr(grid_join, "ROUNDS", 3)
    monkeypatch.setattr(grid_join, "FILTER", 9)
    monkeypatch.setattr(grid_join, "EDGES", 50)
    for kind in ("float", "double"):
        df = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>").repartition(3)
        assert order(grid_join.linked_vectors(df, block_bytes=2000, group=4).collect()) == order(_linked(rows))


def test_grid_join_sends_no_blocks(spark, monkeypatch):
    """Each meeting of blocks once carried both through a shuffle, so that disk grew with the square of the vectors."""
    plans, cut = [], grid_join.Cut

    def seen(df, label, *by):
        if label == "links" and "MapInArrow" in (plan := df._jdf.queryExecution().executedPlan().toString()):
            plans.append(plan)
        return cut(df, label, *by)
    monkeypatch.setattr(grid_join, "Cut", seen)
    rows = _vectors()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert order(grid_join.linked_vectors(df, block_bytes=4000).collect()) == order(_linked(rows))
    assert plans and not any("Exchange" in plan for plan in plans)


def test_chat_escapes():
    assert chat.ESCAPE not in "".join(chat.CODES) and len({*chat.CODES.values(), chat.NEWLINE}) == 3


def _unescaped(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    return df.select("t", chat.escape(F.col("t")).alias("e"), chat.escape(F.col("t"), line=True).alias("l")).select(
        "t", "e", "l", chat.unescape(F.col("e")).alias("a"), chat.unescape(F.col("l")).alias("b")).collect()


def test_chat_escapes_are_reversible(spark):
    draw = random.Random(1)
    parts = ["#", "##", "###", "\\", "h", "t", "n", "</turn>", "</", "turn>", "\n", " ", "é😀", "### assistant:\n", "$1"]
    for r in _unescaped(spark, ["".join(draw.choice(parts) for _ in range(draw.randint(0, 14))) for _ in range(600)]):
        assert r["t"] == r["a"] == r["b"]
        assert "###" not in r["e"] and "</turn>" not in r["e"] and "\n" not in r["l"]


LOG = "conv_id long, message long, seq long, turn long, kind string, role string, text string, piece string, e string"


def test_chat_fold_and_render(spark):
    say = [  # conv, message, seq, turn, kind, role, text
        (1, 1, 1, 0, "message", "user", "hel"), (1, 1, 2, None, "delta", None, "lo ###"), (1, 2, 3, 1, "message", "assistant", "bad"),
        (1, 2, 4, 1, "delta", None, " draft"), (1, 2, 5, 1, "regenerate", None, None), (1, 2, 6, 1, "delta", None, "good"), (1, 2, 7, 1, "delta", None, " </turn>"),
        (1, 1, 8, 0, "edit", None, "hello \\"), (1, 1, 9, 0, "like", None, "!"), (1, 3, 10, 2, "delta", "user", "only delta"), (1, 4, 11, 3, "message", "assistant", ""),
        (2, 1, 1, 0, "message", None, None), (None, 1, 1, 5, "message", "odd\nrole:", "x"), (3, 1, 1, 1, "message", "assistant", "a"),
        (3, 2, 2, 0, "message", "assistant", "b"), (3, 3, 3, 0, "message", "assistant", "b"),
    ]
    log = spark.createDataFrame([(*s, "x", "x") for s in random.Random(2).sample(say, len(say))], LOG)
    got = {r["conv_id"]: r for r in chat.formatted(log).select("conv_id", "formatted", "loss", chat.parse(F.col("formatted")).alias("turns"),
                                                               chat.under_mask(F.col("formatted"), F.col("loss")).alias("said")).collect()}
    turns = {c: [tuple(t) for t in r["turns"]] for c, r in got.items()}
    assert turns == {1: [("user", "hello \\"), ("assistant", "good </turn>"), ("user", "only delta"), ("assistant", "")], 2: [("", "")],
                     None: [("odd\nrole:", "x")], 3: [("assistant", "b"), ("assistant", "b"), ("assistant", "a")]}
    assert {c: r["said"] for c, r in got.items()} == {1: ["good </turn>", ""], 2: [], None: [], 3: ["b", "b", "a"]}
    for r in got.values():
        for start, length in r["loss"]:
            assert r["formatted"][:start].endswith("### assistant:\n") and r["formatted"][start + length:].startswith("\n</turn>\n")
    assert chat.formatted(log.where("false")).count() == 0


def test_chat_stays_in_the_jvm(spark):
    rows = spark.createDataFrame([(1, 0, "user", "x")], "conv_id long, turn long, role string, text string")
    plan = chat.formatted(chat.as_log(rows))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def _documents():
    draw = random.Random(9)
    words = [f"{a}{b}" for a in ("re", "con", "tri", "mo", "lum", "das") for b in ("port", "tain", "gon", "ber", "sel", "tin", "a", "o")]
    text = lambda n: " ".join(draw.choice(words) for _ in range(n))
    passage = text(60)
    rows = [(i, text(draw.randint(60, 160))) for i in range(40)]
    rows += [(40 + i, rows[i][1]) for i in range(6)] + [(50 + i, rows[i][1].replace(" ", "  ", 3)) for i in range(4)]
    rows += [(60 + i, f"{text(70)} {passage} {text(70)}") for i in range(5)]
    rows += [(70, text(10)), (71, "spam spam " * 80), (72, " | ".join(text(80).split())), (73, None), (74, text(100).upper()), (None, text(90)), (None, text(95)),
             (75, text(60) + " mail a.b9@x.org from 10.20.30.40 " + text(20)), (76, text(60) + " card 4417744280351547"), (3, rows[3][1])]
    return rows


def test_pipeline_stage_by_stage(spark):
    rows = _documents()
    docs = frame(spark, [(i, t, "en", len(t or ""), *["x"] * 14) for i, t in rows])
    stages = dict(corpus_pipeline.STAGES)
    names = [n for n, _ in corpus_pipeline.STAGES]

    def passes(t):
        m = dict(zip(quality.MEASURES, measures(t)))
        return not any(eval(c, {}, m) for c in quality.RULES.values())
    kept = [(i, t) for i, t in rows if passes(t)]
    out = stages[names[0]](spark, docs, "")
    assert out.dtypes == docs.dtypes and order(r[:2] for r in out.collect()) == order(kept)
    assert {70, 71, 72, 73, 74}.isdisjoint(i for i, _ in kept) and len(kept) == len(rows) - 5

    groups = defaultdict(list)
    for (i, f, c), (_, t) in zip(near_groups(kept), kept):
        groups[c if c is not None else t].append((i, t))
    out = stages[names[1]](spark, out, "")
    one = [tuple(r[:2]) for r in out.collect()]
    assert out.dtypes == docs.dtypes and len(one) == len(groups)
    for c, members in groups.items():
        assert sum(r in members and (r[0] == c or r[0] is None) for r in one) == 1

    out = stages[names[2]](spark, out, "")
    assert out.dtypes == docs.dtypes
    want = [(i, k.decode("utf-8", "ignore")) for i, _, k, _ in repeats(one)]
    assert order((r["doc_id"], r["text"], r["n_chars"]) for r in out.collect()) == order((i, t, len(t)) for i, t in want)
    assert any(len(a) != len(b) for a, b in zip(sorted(t for _, t in want), sorted(t for _, t in one)))

    out = stages[names[3]](spark, out, "")
    texts = [(r["doc_id"], r["text"]) for r in out.collect()]
    assert out.dtypes == docs.dtypes and not any(re.search(r"a\.b9@|10\.20\.30\.40|4417744280351547", t) for _, t in texts)
    assert len(texts) == len(want)

    out = stages[names[4]](spark, out, "")
    whole = defaultdict(int)
    for r in out.collect():
        whole[r["sequence_id"]] += r["length"]
    assert all(n == 2048 or n & (n - 1) == 0 for n in whole.values())
    from regwise.llm.bpe import Codec, vocabulary
    codec = Codec(vocabulary())
    assert sum(whole.values()) == sum(len(x) // 4 + 1 for x in codec.encode([t for _, t in texts]))


def test_pipeline_takes_no_documents(spark):
    docs = frame(spark, [])
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, "")
        assert docs.count() == 0


def test_pipeline_runs_whole(spark):
    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert out.count() > 0 and out.agg(F.count_distinct("sequence_id")).first()[0] > 0


def test_spoken_words_are_long_enough():
    assert len(SAID.split()) < 50 and pseudonyms.ROUNDS % 2 == 0
