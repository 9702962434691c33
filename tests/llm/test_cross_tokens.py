"""Cross-tokenizer alignment against both libraries and a walk over all bytes."""

import hashlib
import random
from collections import Counter, defaultdict

import public_tokenizers
import sentencepiece
from cases import TEXTS, frame, order
from tokenizers import Tokenizer

from regwise.llm import cross_tokens
from regwise.llm.bpe import byte_letters

A = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
A.encode_special_tokens = True
B = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
LETTERS = byte_letters()


def _bytes_a(i):
    return bytes(LETTERS[c] for c in A.id_to_token(i))


def _bytes_b(i):
    piece = B.id_to_piece(i)
    return bytes([int(piece[3:5], 16)]) if B.is_byte(i) else piece.replace("▁", " ").encode()


def _groups(text):
    if not text:
        return []
    a, b = A.encode(" " + text, add_special_tokens=False).ids, B.encode(text)
    raw = (" " + text).encode()
    if b"".join(map(_bytes_a, a)) != raw or b"".join(map(_bytes_b, b)) != raw:
        return []
    owner_a, owner_b = ([i for i, t in enumerate(ids) for _ in of(t)] for ids, of in ((a, _bytes_a), (b, _bytes_b)))
    out, from_a, from_b = [], 0, 0
    for k in range(len(raw)):
        end = k + 1 == len(raw)
        if end or (owner_a[k] != owner_a[k + 1] and owner_b[k] != owner_b[k + 1]):
            out.append((a[from_a:owner_a[k] + 1], b[from_b:owner_b[k] + 1]))
            from_a, from_b = owner_a[k] + 1, owner_b[k] + 1
    return out


def _expected(rows):
    groups = [_groups(t) for _, t in rows]
    links = [Counter((x, y) for a, b in g for x in a for y in b) for g in groups]
    count, top = Counter(p for c in links for p in c), defaultdict(int)
    for (x, _), n in count.items():
        top[x] = max(top[x], n)
    out = []
    for (i, _), g, c in zip(rows, groups, links):
        text = ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in g)
        out.append((i, sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), sum(c.values()), sum(n for p, n in c.items() if count[p] == top[p[0]]),
                    sum(n * count[p] for p, n in c.items()), hashlib.sha256(text.encode()).hexdigest() if g else "", text))
    return out


def _rows():
    draw = random.Random(9)
    words = ["the", "Quick", "naïve", "straße", "日本語", "😀", "x1y2z3", "don't", "…", "e-mail", "A", "0042", "\n", "\n\n", "  ", "\t", "<s>", "<0x41>", "<|endoftext|>",
             "▁", "ﬁ", " ", "zzzzqqqq", "http://a.b/c?d=e", "Ελλάδα", "שלום"]
    made = [(100 + k, " ".join(draw.choice(words[:draw.choice([8, 12, len(words)])]) for _ in range(draw.randrange(1, 60)))) for k in range(300)]
    glued = [(500 + k, "".join(draw.choice(words) for _ in range(draw.randrange(1, 20)))) for k in range(100)]
    return TEXTS + made + glued + [(700, "日本" * 3000), (701, "aAbB" * 2000), (702, " "), (703, " a"), (704, "a "), (705, "\x00")]


def test_alignment(spark):
    rows = _rows()
    want = _expected(rows)
    assert sum(1 for w in want if w[3]) > 200 and any(w[1] > w[3] for w in want) and sum(1 for w in want if w[3] == 0) > 20
    df = frame(spark, [(i, t, "en", 1, *["x"] * 14) for i, t in rows]).repartition(3)
    for block_bytes in (cross_tokens.BLOCK_BYTES, 3000):
        assert order(cross_tokens.align(df, block_bytes=block_bytes, spans=True).collect()) == order(want)


def test_alignment_of_nothing(spark):
    assert cross_tokens.align(frame(spark, [])).count() == 0
    assert [tuple(r) for r in cross_tokens.align(frame(spark, [(None, None, "en", 1, *["x"] * 14)])).collect()] == [(None, 0, 0, 0, 0, 0, 0, "")]


def test_memory_and_wide_groups_change_nothing(monkeypatch):
    texts = [t or "" for _, t in _rows()]
    paths = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    usual = cross_tokens.Windows(*paths).aligned(texts)
    monkeypatch.setattr(cross_tokens, "WIDE", 1)
    monkeypatch.setattr(cross_tokens, "IDS_KEPT", 50)
    small = cross_tokens.Windows(*paths)
    for _ in range(2):  # with memories that hold nothing, and then anew
        again = small.aligned(texts)
        assert {k: list(v) for k, v in usual.items()} == {k: list(v) for k, v in again.items()}
