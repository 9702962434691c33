"""Operators on texts against brute force, on rows with nulls, ties, copies and clashing columns."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from cases import CLASHES, LONG, ROWS, SAID, TEXTS, fingerprint, frame, measures, near_groups, order, repeat_digests
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from regwise.llm import bpe, components, ctw, licences, packing, pseudonyms, quality, queries, repeats, simhash
from tools.check import compare, connect

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return frame(spark).cache()


@pytest.fixture(scope="module")
def none(spark):
    return frame(spark, [])


@pytest.mark.parametrize("name", sorted(queries.CHECKS))
def test_query_against_sql(spark, name):
    ok, note = compare(spark, connect(SF), name, queries.QUERIES[name], queries.CHECKS[name], SF)
    assert ok, note


def test_quality_measures(docs, none):
    got = quality.ledger(docs)
    want = [(i, *measures(t)) for i, t in TEXTS]
    assert order(got.select("doc_id", *quality.MEASURES).collect()) == order(want)
    assert quality.ledger(none).count() == 0
    assert quality.passing(none).columns == none.columns


def test_quality_verdicts_and_ablations(docs):
    book = [r.asDict() for r in quality.ledger(docs).collect()]
    for row in book:
        assert bool(row["bits"] & quality.BIT["few_words"]) == (row["n_words"] < 50)
        assert bool(row["bits"] & quality.BIT["repeated_words"]) == (100 * row["n_repeat_words"] > 50 * row["n_words"])
    kept = [r for r in book if not r["bits"] & quality.POLICIES[quality.CURRENT]]
    assert order(r[:2] for r in quality.passing(docs).collect()) == order((i, t) for i, t in TEXTS if any(k["doc_id"] == i and k["n_words"] == measures(t)[0] for k in kept))
    sheet = {(r["policy"], r["rule"]): r for r in quality.ablations(quality.ledger(docs)).collect()}
    for (policy, rule), r in sheet.items():
        mask, bit = quality.POLICIES[policy], quality.BIT[rule]
        assert (r["n_texts"], r["n_failed"], r["n_only_this"]) == (
            len(book), sum(bool(b["bits"] & bit) for b in book), sum(b["bits"] & mask == bit for b in book))


def _digests(found):
    return [(r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], hashlib.sha256(r["kept"]).hexdigest()) for r in
            found.select("row.doc_id", "n_bytes", "n_removed", "n_spans", "kept").collect()]


@pytest.mark.parametrize("block_bytes,batches", [(1 << 24, 1), (3000, 4)])
def test_repeats(docs, block_bytes, batches):
    assert order(_digests(repeats.without_repeats(docs, batches=batches, block_bytes=block_bytes))) == order(repeat_digests(TEXTS))


def test_repeats_query(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert order(queries.QUERIES["op2_repeats"](spark, SF).collect()) == order(repeat_digests(rows))


def test_repeats_many_small_blocks(spark):
    draw = random.Random(4)
    words = ["ab", "abc", "é", "xy z", "\n", "the ", "日本"]
    passages = ["".join(draw.choice(words) for _ in range(draw.randint(30, 200))) for _ in range(6)] + ["a" * 150, "ab" * 90]
    rows = [(i, "".join(draw.choice(passages)[draw.randint(0, 40):draw.randint(100, 300)] + "".join(draw.choice(words) for _ in range(draw.randint(0, 30)))
                        for _ in range(draw.randint(0, 4)))) for i in range(150)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert order(_digests(repeats.without_repeats(df, block_bytes=1500, batches=5))) == order(repeat_digests(rows))


def test_repeats_across_chunks(monkeypatch):
    import pyarrow as pa
    import zstandard
    monkeypatch.setattr(repeats, "CHUNK", 500)
    repeats._tables.cache_clear()
    rows = sorted(((i, t or "") for i, t in TEXTS if i is not None and t != LONG), key=lambda r: (r[0], r[1].encode()))
    texts = [t.encode() for _, t in rows]
    block = repeats.Block(zstandard.ZstdCompressor(1).compress(b"".join(texts)), [len(t) for t in texts])
    drop = repeats.covered(block, pa.table({"block": pa.array([], pa.int64()), "kind": pa.array([], pa.string()), "prints": pa.array([], pa.binary())}))
    repeats._tables.cache_clear()
    ends = np.cumsum([len(t) for t in texts])
    assert [int(drop[e - len(t):e].sum()) for e, t in zip(ends, texts)] == [r[2] for r in repeat_digests(rows)]


def test_repeats_stage_columns(docs, none):
    out = repeats.remove_repeats(docs)
    assert out.dtypes == docs.dtypes and out.count() == len(ROWS)
    assert all(r["n_chars"] == len(r["text"]) for r in out.select("n_chars", "text").collect())
    assert repeats.remove_repeats(none).collect() == []


def _context_tree(rows, depth=ctw.DEPTH):
    """(doc_id, held out, tokens, known, base, score) with plain dictionaries and lgamma."""
    texts = [(i, zlib.crc32(("" if i is None else str(i)).encode()) % 10 == 0, (t or "").encode().lower().split()) for i, t in rows]
    counts, nodes = Counter(), [defaultdict(lambda: [0, 0]) for _ in range(depth + 1)]

    def steps(words):
        s = b"\n" * depth + ctw.stream(words)
        for p in range(depth, len(s)):
            for b in range(7, -1, -1):
                yield s[p - depth:p], (s[p] | 256) >> (b + 1), s[p] >> b & 1
    for _, held, words in texts:
        if not held:
            counts.update([*words, ctw.END])
            for c, m, bit in steps(words):
                for d in range(depth + 1):
                    nodes[d][c[depth - d:], m][bit] += 1

    def estimate(a, b):
        return math.lgamma(a + .5) + math.lgamma(b + .5) - math.lgamma(a + b + 1) - math.log(math.pi)
    weight, below = [{k: 1.0 for k in nodes[depth]}], {k: estimate(*n) for k, n in nodes[depth].items()}
    for d in range(depth - 1, -1, -1):
        children, here = defaultdict(float), {}
        for (c, m), x in below.items():
            children[c[1:], m] += x
        weight.insert(0, {})
        for k, n in nodes[d].items():
            own, top = estimate(*n), max(estimate(*n), children[k])
            both = top + math.log(math.exp(own - top) + math.exp(children[k] - top))
            weight[0][k], here[k] = math.exp(own - both), both - math.log(2)
        below = here
    total, kinds = sum(counts.values()), len(counts)
    cache = {}

    def one(c, m):
        if (c, m) not in cache:
            so_far, rest, p = 0.0, 1.0, .5
            for d in range(depth + 1):
                k = (c[depth - d:], m)
                if k not in nodes[d]:
                    break
                a, b = nodes[d][k]
                kt = (b + .5) / (a + b + 1)
                p, so_far, rest = so_far + rest * kt, so_far + rest * weight[d][k] * kt, rest * (1 - weight[d][k])
            cache[c, m] = p
        return cache[c, m]
    out = []
    for i, held, words in texts:
        tokens = [*words, ctw.END]
        base = sum(math.log10((counts[t] + .1) / (total + .1 * (kinds + 1))) for t in tokens)
        score = sum(math.log10(one(c, m) if bit else 1 - one(c, m)) for c, m, bit in steps(words))
        out.append((i, held, len(tokens), sum(counts[t] > 0 for t in tokens), total, base, score))
    return out


@pytest.mark.parametrize("block_bytes", [1 << 25, 300])
def test_context_tree(spark, block_bytes):
    rows = [(i, t if t != LONG else t[:3000]) for i, t in TEXTS] + [(100 + k, f"{SAID} {k} times {k % 7}") for k in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("block", F.lit("clash"))
    got = order(r[:7] for r in ctw.scores(df, block_bytes=block_bytes).collect())
    for a, b in zip(got, order(_context_tree(rows)), strict=True):
        assert a[:5] == b[:5] and a[5:] == pytest.approx(b[5:], rel=1e-9, abs=1e-7)


def test_context_tree_beats_unigrams_on_held_out_texts(spark):
    found = queries.QUERIES["op3_context_tree"](spark, "/root/testdata/sf0.01").where("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert found[0] > found[1]


def test_context_tree_without_training(spark, none):
    assert ctw.scores(none).count() == 0
    held = next(i for i in range(1000) if zlib.crc32(str(i).encode()) % 10 == 0)
    row = ctw.scores(spark.createDataFrame([(held, "ab")], "doc_id long, text string")).first()
    assert (row["train_tokens"], row["n_known"]) == (0, 0) and row["score"] == pytest.approx(-32 * math.log10(2))


VALUES = ("mail a.b9@x.org, B_7%z@sub.mail.example. (017) 555-7713 and +1 (017) 555-7713 or +49 171 555 1234; 1.2.3.4 300.1.1.1 9.9.9.9. on 2020-02-29 29.02.2020 "
          "02/29/2020 31/12/1999 2021-02-30 1850-01-01 card 4417744280351547 4417-7442-8035-1547 4417744280351548 12345 ssn 123-45-6789 000-12-3456 "
          'token = "04dbebab91ab85687d33eeaaf9ac699e1188" 0123456789012345678901234567890123456789 v1.2.3.4.5 x')


def test_pseudonyms_change_values_and_nothing_else(spark, docs, none):
    rows = [(20, VALUES), (21, VALUES[::-1]), (22, "4417744280351547"), (23, "x" * 200_000 + " a@b.co"), *TEXTS]
    df = frame(spark, [(i, t, "en", 1, *["x"] * len(CLASHES)) for i, t in rows])
    out = pseudonyms.pseudonymise(df, "k", kinds="kinds")
    assert out.columns == df.columns
    got = out.collect()
    assert order((r["doc_id"],) for r in got) == order((i,) for i, _ in rows)
    text, kinds = next((r["text"], r["kinds"]) for r in got if r["doc_id"] == 20)
    assert Counter(kinds) == {"email": 2, "phone": 3, "address": 2, "date": 4, "card": 2, "social": 1, "secret": 1}
    old, new = (t.replace("(", " ").replace(")", " ").split() for t in (VALUES, text))
    stay = {"mail", "and", "or", "300.1.1.1", "on", "2021-02-30", "1850-01-01", "card", "4417744280351548", "12345", "ssn", "000-12-3456", "token", "=",
            "0123456789012345678901234567890123456789", "v1.2.3.4.5", "x", "+1", "+49"}
    assert len(old) == len(new) and {a for a, b in zip(old, new) if a == b} == stay
    assert sorted(r["text"] or "" for r in got if not r["kinds"]) == sorted(t or "" for i, t in rows if i not in (20, 21, 22, 23))
    assert next(r["text"] for r in got if r["doc_id"] == 23).startswith("x" * 200_000 + " ")
    assert pseudonyms.pseudonymise(docs, "k").dtypes == docs.dtypes and pseudonyms.pseudonymise(none, "k").count() == 0


# written apart from the operator: what must be found in the given documents, and how it may look afterwards
MAIL = re.compile(r"[A-Za-z0-9._%+-]+@([A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+)")
GIVEN = re.compile(MAIL.pattern + r"|(?:\+1 )?\(\d{3}\) \d{3}-\d{4}|(?<![\d.])(?:\d{1,3}\.){3}\d{1,3}(?![\d.])")


def test_pseudonyms_query(spark):
    """In the given documents: the same gaps, values of the same look, one pseudonym a value and one value a pseudonym."""
    rows = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}
    got = queries.QUERIES["op5_pseudonyms"](spark, SF).select("doc_id", "text", "n_values").collect()
    assert len(got) == len(rows)
    known, back, found = {}, {}, 0
    for i, text, n in got:
        old, new = rows[i] or "", text or ""
        values, there = GIVEN.findall(old), GIVEN.findall(new)
        if n == 0:
            assert old == new
        assert len(values) == len(there)
        for a, b in zip(GIVEN.finditer(old), GIVEN.finditer(new)):
            found += 1
            if "@" in a[0]:
                assert a[1] == b[1] and len(a[0]) == len(b[0])
            elif "(" in a[0]:
                assert re.sub("[0-9]", "0", a[0]) == re.sub("[0-9]", "0", b[0])
            digits = lambda v: re.sub("[^0-9]", "", v)[-10:] if "(" in v else v
            assert known.setdefault(digits(a[0]), digits(b[0])) == digits(b[0]) and back.setdefault(digits(b[0]), digits(a[0])) == digits(a[0])
    assert found > 10 and all(a != b for a, b in known.items())


def test_permutation_is_one_to_one(spark):
    all_dates = spark.range(73050).select(F.date_format(F.date_add(F.lit(pseudonyms.FIRST_DAY).cast("date"), F.col("id").cast("int")), "yyyy-MM-dd").alias("text"))
    assert pseudonyms.pseudonymise(all_dates, "k").distinct().count() == 73050


def test_pseudonyms_stay_in_the_jvm(docs):
    plan = pseudonyms.pseudonymise(docs, "k")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan.replace("ArrowToRow", "")


def test_licences(spark, docs, none):
    loud = "Copyright (c) 2020 Somebody\n\n" + licences.MIT.upper().replace(",", " ,").replace("SUBLICENSE", "SUB-LICENCE")
    rows = [(30, loud), (31, licences.MIT + " more"), (32, "text\n  RELEASED under the MIT licence!  \nmore\nLicensed under CC BY 4.0"), (33, "© 2020 x"), *TEXTS]
    df = frame(spark, [(i, t, "en", 1, *["x"] * len(CLASHES)) for i, t in rows])
    known = licences.known_texts(spark)
    found = {r["doc_id"]: (r["licence"], r["lines"]) for r in licences.scan(df, known).collect() if r["doc_id"] in (30, 31, 32, 33)}
    assert found == {30: ("MIT", []), 31: (None, []), 32: (None, ["CC-BY-4.0", "MIT"]), 33: (None, [])}
    assert licences.scan(df, known).count() == len(rows) and licences.scan(none, known).count() == 0


def _ids(texts):
    library = Tokenizer.from_file(bpe.vocabulary())
    return [e.ids for e in library.encode_batch(texts, add_special_tokens=False)], library


def test_bpe(spark, docs, none):
    got = bpe.decode(bpe.encode(docs)).collect()
    want, library = _ids([t or "" for _, t in TEXTS])
    assert order((r["doc_id"], list(np.frombuffer(r["ids"], "<u4")), r["text"]) for r in got) == order(
        (i, w, library.decode(w, skip_special_tokens=False)) for (i, _), w in zip(TEXTS, want))
    assert bpe.encode(none).count() == 0


def test_bpe_query(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    ids, library = _ids([r["text"] or "" for r in rows])
    want = [(r["doc_id"], len(w), hashlib.sha256(np.array(w, "<u4").tobytes()).hexdigest(),
             hashlib.sha256(library.decode(w, skip_special_tokens=False).encode()).hexdigest()) for r, w in zip(rows, ids)]
    assert order(queries.QUERIES["op9_bpe"](spark, SF).collect()) == order(want)


@pytest.mark.parametrize("make", [bpe.Codec, packing.Encoder])
def test_bpe_on_odd_texts(make):
    draw = random.Random(1)
    parts = ["a", "b", "the", " ", "  ", "\n", "\t", "'s", "'ll", "é", "ß", "—", "“", "日本", "😀", "<|endoftext|>", "1", "²", "!!!", "\x85", "\xa0", "aaaa",
             "\r\n", "́", "\x00", "ing", "Ġ", "​", "İ", "'"]
    texts = ["".join(draw.choice(parts) for _ in range(draw.randint(0, 25))) for _ in range(1500)]
    codec, (want, library) = make(bpe.vocabulary()), _ids(texts)
    ids = codec.encode(texts)
    assert [np.frombuffer(x, "<u4").tolist() for x in ids] == want
    assert [codec.decode(x) for x in ids] == texts
    cut = [[200, 201, 1000, 50256], [255], []]
    assert [codec.decode(np.array(x, "<u4").tobytes()) for x in cut] == [library.decode(x, skip_special_tokens=False) for x in cut]


def test_pack_sizes():
    draw = random.Random(2)
    for n in (0, 1, 5, 700):
        sizes = [draw.choice([1, 3, 100, 700, 1500, 2048, 2049, 5000, draw.randint(1, 4000)]) for _ in range(n)]
        held = defaultdict(list)
        for sequence in packing.pack(sizes):
            full = sum(p[2] for p in sequence)
            assert full == 2048 or full & (full - 1) == 0
            for i, start, length in sequence:
                held[i].append((start, length))
        for i, size in enumerate(sizes):
            at = 0
            for start, length in sorted(held[i]):
                assert start == at and length > 0
                at += length
            assert at == size


@pytest.mark.parametrize("group_bytes", [packing.GROUP_BYTES, 2000])
def test_packing(docs, none, group_bytes):
    pieces = packing.sequences(docs, group_bytes=group_bytes).collect()
    ids = {repr(i): [] for i, _ in TEXTS}
    for (i, _), w in zip(TEXTS, _ids([t or "" for _, t in TEXTS])[0]):
        ids[repr(i)].append([*w, packing.END])
    whole = Counter()
    for p in pieces:
        part = np.frombuffer(p["ids"], "<u4").tolist()
        assert len(part) == p["length"] and any(len(w) == p["doc_tokens"] and w[p["start"]:p["start"] + p["length"]] == part for w in ids[repr(p["doc_id"])])
        whole[repr(p["doc_id"])] += p["length"]
    assert whole == {i: sum(map(len, w)) for i, w in ids.items()}
    sequences = defaultdict(list)
    for p in pieces:
        sequences[p["sequence_id"]].append((p["offset"], p["length"]))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at == 2048 or at & (at - 1) == 0
    assert packing.sequences(none).count() == 0


def test_simhash(spark, docs, none):
    got = simhash.near_duplicates(docs).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")), "component_id").collect()
    assert order(got) == order(near_groups(TEXTS))
    assert simhash.near_duplicates(none).count() == 0 and simhash.keep_one(none).count() == 0
    kept = simhash.keep_one(docs)
    assert kept.dtypes == docs.dtypes
    groups = defaultdict(list)
    for i, f, c in near_groups(TEXTS):
        groups[c].append(i)
    assert order([r[:1] for r in kept.collect()]) == order([(c,) for c in groups])


def test_simhash_query(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert order(queries.QUERIES["op10_simhash"](spark, SF).collect()) == order(near_groups(rows))


def test_fingerprints_that_differ_in_few_bits(spark):
    draw = random.Random(3)
    base = [draw.getrandbits(64) for _ in range(60)] + [0, (1 << 64) - 1]
    fps = sorted({b ^ sum(1 << k for k in draw.sample(range(64), draw.randint(0, 4))) for b in base for _ in range(30)})
    x = np.array(fps, np.uint64)
    df = spark.createDataFrame([(int(v),) for v in x.view(np.int64)], "fp long")
    roots = {r["node"]: r["root"] for r in components.components(simhash.links(df)).collect()}
    signed = x.view(np.int64).tolist()
    pairs = [(i, int(j)) for i in range(len(x)) for j in np.flatnonzero(np.bitwise_count(x[i] ^ x) <= 2)]
    root = list(range(len(x)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    want, got = defaultdict(set), defaultdict(set)
    for i, v in enumerate(signed):
        want[find(i)].add(v)
        got[roots.get(v, v)].add(v)
    assert sorted(map(sorted, want.values())) == sorted(map(sorted, got.values()))


def test_blocks_of_fingerprints_are_searched_whole():
    draw = np.random.default_rng(1)
    x = draw.integers(0, 1 << 20, 700, dtype=np.uint64) << np.uint64(3)
    a, b = simhash.linked(x, x)
    assert len(a) == int((np.bitwise_count(x[:, None] ^ x) <= 2).sum())


def test_components(spark):
    draw = random.Random(5)
    edges = [(draw.randint(-200, 200), draw.randint(-200, 200)) for _ in range(180)] + [(1000 + i, 1001 + i) for i in range(70)] + [(None, 3), (4, 4)]
    got = {r["node"]: r["root"] for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    root = {v: v for e in edges for v in e if None not in e}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v
    for a, b in edges:
        if a is not None:
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    assert got == {v: find(v) for v in root if any(v in e and e[0] != e[1] and None not in e for e in edges)}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_fingerprint_of_words():
    assert simhash.shingle_hashes(b"") == [] and fingerprint("  ") == 0
