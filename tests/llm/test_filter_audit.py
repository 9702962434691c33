"""The filter audit against a walk of every document through every order."""

import random
import re
from collections import Counter
from itertools import permutations

from cases import TEXTS, WORD, frame

from regwise.llm import filter_audit


def _fails(rows):
    """For each row the set of failed filters."""
    out = []
    for i, t, _ in rows:
        t = t or ""
        words = WORD.findall(t)
        same = [j for j, u, _ in rows if (u or "") == t and j is not None]
        out.append({f for f, bad in (("A", len(words) < 200), ("B", 100 * len(set(words)) < 50 * len(words)),
                                     ("C", 100 * len(re.findall("[A-Z]", t)) > 3 * len(t)), ("D", bool(re.search("[#$%&*|]", t))),
                                     ("E", i is not None and any(j < i for j in same))) if bad})
    return out


def _walked(rows, labels):
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, x in labels if x == 1 and i is not None}
    fails, out = _fails(rows), {}
    for part in {p or "" for _, _, p in rows}:
        mine = [(i, f) for (i, _, p), f in zip(rows, fails) if (p or "") == part]
        shapley, steps = Counter(), {}
        for order in map("".join, permutations("ABCDE")):
            left = mine
            for step, f in enumerate(order, 1):
                gone = [i for i, bad in left if f in bad]
                left = [(i, bad) for i, bad in left if f not in bad]
                shapley[f] += len(gone)
                steps[order, step] = (len(left), len(gone), sum(f in bad for _, bad in mine) - len(gone), sum(bad == {f} for _, bad in mine),
                                      sum(i in good for i in gone), sum(i in toxic for i in gone))
        out |= {(part, o, s): (*v, shapley[o[s - 1]]) for (o, s), v in steps.items()}
    return out


def _audited(spark, rows, labels):
    docs = frame(spark, [(i, t, p, 1, *["x"] * 14) for i, t, p in rows])
    marks = spark.createDataFrame([(i, q, x, "y") for i, q, x in labels], "doc_id long, quality int, toxic int, mask string")
    got = filter_audit.audit(docs, marks).collect()
    assert len({r[:3] for r in got}) == len(got)
    return {tuple(r[:3]): tuple(r[3:]) for r in got}


def test_audit_on_odd_rows(spark):
    draw = random.Random(3)
    rows = [(i, t, draw.choice(["en", "de", None, ""])) for i, t in TEXTS]
    for k in range(120):
        words = [draw.choice(["a", "b", "Cc", "DDD", "x#", f"w{draw.randrange(400)}"]) for _ in range(draw.choice([5, 150, 250, 300]))]
        rows += [(100 + k, " ".join(words), draw.choice(["en", "fr"]))] * draw.choice([1, 1, 2])
    rows += [(draw.randrange(300, 400), rows[draw.randrange(20, 60)][1], "en") for _ in range(60)]
    labels = [(draw.randrange(400), draw.choice([0, 1, None]), draw.choice([0, 1, None])) for _ in range(300)] + [(None, 1, 1)]
    assert _audited(spark, rows, labels) == _walked(rows, labels)


def test_audit_without_rows(spark):
    assert _audited(spark, [], [(1, 1, 1)]) == {}
    rows = [(1, "a", None)]
    assert _audited(spark, rows, []) == _walked(rows, [])


def test_intervals_cover_each_order_once():
    seen = Counter((mask, rank) for mask, _, low, high in filter_audit.intervals() for rank in range(low, high))
    assert seen == Counter({(mask, rank): 1 for mask in range(1, 32) for rank in range(120)})
