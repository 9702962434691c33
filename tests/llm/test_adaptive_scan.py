"""The adaptive dimension scan against all pairs."""

import math

import numpy as np
import pytest

from regwise.llm import adaptive_scan


def _score(q, x):
    total = 0.0
    for a, b in zip(q, x):
        total += a * b
    return total


def _all_pairs(rows, most=20, every=20):
    """Sorted (query_id, rank, vec_id, score) from the distinct usable rows."""
    usable = sorted({(i, tuple(x + 0.0 for x in v)) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)})
    out = []
    for i, q in usable:
        if i % every == 0:
            near = sorted((-_score(q, x), j) for j, x in usable if (j, x) != (i, q) and len(x) == len(q))[:most]
            out += [(i, k, j, -s) for k, (s, j) in enumerate(near, 1)]
    return sorted(out)


def _vectors(n=500, d=24, spread=1.0):
    draw = np.random.default_rng(5)
    centres = draw.normal(size=(10, d)) * spread
    rows = [(i, (draw.uniform(.5, 2) * (centres[i % 10] + draw.normal(size=d))).astype(np.float32).astype(float).tolist()) for i in range(n)]
    rows += [(1000 + i, rows[40][1]) for i in range(60)] + [(20, rows[20][1])] * 3 + [(60, rows[7][1]), (60, rows[8][1])]
    return rows


ODD = [(400_000, None), (400_020, []), (400_040, [0.0] * 24), (400_060, [float("nan")] * 24), (400_080, [float("inf")] + [1.0] * 23), (400_100, [None] + [1.0] * 23),
       (500_000, [1.0, 2.0]), (500_001, [2.0, 4.1]), (500_020, [-0.0, 1.0]), (500_041, [0.0, 1.0]), (None, [5.0] * 24), (500_060, [3.0])]


def _found(spark, rows, **how):
    df = spark.createDataFrame([(i, v, "x", 1, 2) for i, v in rows], "vec_id long, embedding array<double>, k string, list int, rank int")
    got = adaptive_scan.nearest(df, **how)
    assert got.dtypes == [("query_id", "bigint"), ("rank", "int"), ("vec_id", "bigint"), ("score", "double")]
    return sorted(tuple(r) for r in got.collect())


def test_one_list_finds_all(spark):
    rows = _vectors() + ODD
    assert _found(spark, rows) == _all_pairs(rows)


def test_probed_lists_find_nearly_all(spark):
    rows = _vectors(3000, spread=2.0)
    got, want = _found(spark, rows, list_rows=100), _all_pairs(rows)
    assert len(got) == len(want) and {r[:2] for r in got} == {r[:2] for r in want}
    pairs, true, exact = ({(q, v, s) for q, _, v, s in r} for r in (got, want, _all_pairs(rows, most=len(rows))))
    assert len(pairs & true) >= 0.95 * len(true) and pairs <= exact


@pytest.mark.parametrize("scale", [1e-140, 1e140])
def test_scale_does_not_matter(spark, scale):
    rows = [(i, [x * scale for x in v]) for i, v in _vectors(200)]
    assert [r[:3] for r in _found(spark, rows)] == [r[:3] for r in _all_pairs(rows)]


def test_few_and_no_rows(spark):
    rows = [(20, [1.0, 0.0]), (21, [0.5, 1.0]), (22, [0.5, -1.0])]
    assert _found(spark, rows) == _all_pairs(rows)
    assert _found(spark, []) == _found(spark, ODD[:6]) == _found(spark, rows[1:]) == _found(spark, rows[:1]) == []


def test_abandoned_candidates_are_out_of_reach():
    draw = np.random.default_rng(2)
    q, x = draw.normal(size=(40, 64)), draw.normal(size=(64, 900))
    far = ((q[:, :, None] - x) ** 2).sum(axis=1)
    bound = np.sort(far, axis=1)[:, 4]
    i, j = adaptive_scan.survivors(q, [x[k:k + 16] for k in range(0, 64, 16)], bound, 900)
    assert (far[i, j] <= bound[i] * (1 + 1e-6)).all() and len(i) >= 0.97 * 5 * 40
