"""Whitening against numpy, exact deviations, and vectors that are left out, repeated, constant or very large."""

import math
import random

import numpy as np
import pytest

from reelsieve.llm import whitening

VECS = "vec_id long, embedding array<float>, label int"


def plain(rows):
    kept = [(i, tuple(math.floor(256 * float(np.float32(c))) for c in v)) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    d = max(len(v) for _, v in kept)
    kept = [(i, v) for i, v in kept if len(v) == d]
    fit = np.array(sorted({v for _, v in kept}), dtype=np.int64)
    n, s = len(fit), fit.sum(0)
    cov = np.zeros((d, d))
    for v in fit:
        c = v - s / n
        cov += np.outer(c, c) / n
    e, u = np.linalg.eigh(cov)
    return kept, n, s, e[::-1], u[:, ::-1]


def test_whiten(spark):
    rng = random.Random(2)
    rows = [(i, [rng.gauss(k % 3, 1 + 0.3 * k) for k in range(7)]) for i in range(300)]
    rows += [(5, rows[5][1])] * 90 + [(None, rows[6][1]), (900, None), (901, []), (902, [None] + [1.0] * 6), (903, [math.nan] + [0.0] * 6), (904, [math.inf] * 7), (905, [1.0] * 3), (906, [-0.0] * 7)]
    kept, n, s, e, u = plain(rows)
    got = whitening.whiten(spark.createDataFrame([(*r, 1) for r in rows], VECS).repartition(3)).collect()
    assert len(got) == 4 * len(kept) and {r.n for r in got} == {n} and got[0].identity_error < 1e-9
    want = {}
    for i, v in kept:
        for k in range(4):
            want.setdefault((i, k + 1), (sum((n * a - b) ** 2 for a, b in zip(v, s.tolist())), float((np.array(v) - s / n) @ u[:, k] / e[k] ** 0.5)))
    sign = {}
    for r in got:
        deviation, w = want[r.vec_id, r.component]
        assert r.deviation == deviation and abs(abs(r.whitened) - abs(w)) < 1e-9 and abs(r.explained - e[r.component - 1] / e.sum()) < 1e-12
        if abs(w) > 1e-3:
            assert sign.setdefault(r.component, w * r.whitened > 0) == (w * r.whitened > 0)
    assert got[0].asDict().keys() == {"vec_id", "label", *"component n deviation whitened explained identity_error".split()}


def test_same_on_any_partitioning(spark):
    rng = random.Random(8)
    df = spark.createDataFrame([(i, [rng.gauss(0, 3) for _ in range(5)], 0) for i in range(200)], VECS)
    assert sorted(map(repr, whitening.whiten(df.repartition(1)).collect())) == sorted(map(repr, whitening.whiten(df.repartition(7)).collect()))


def test_wide_triangle(spark, monkeypatch):
    rng = random.Random(3)
    df = spark.createDataFrame([(i, [rng.gauss(0, 3) for _ in range(6)], 0) for i in range(50)], VECS)
    whole = sorted(map(repr, whitening.whiten(df).collect()))
    monkeypatch.setattr(whitening, "MOST_PAIRS", 4)
    assert sorted(map(repr, whitening.whiten(df).collect())) == whole


def test_degenerate(spark):
    def run(rows):
        return whitening.whiten(spark.createDataFrame([(*r, 0) for r in rows], VECS)).collect()

    assert run([]) == [] and run([(1, None), (2, [])]) == []
    one = run([(1, [1.0, 2.0]), (2, [1.0, 2.0])])
    assert [(r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in one] == [(1, 0, None, None, None)] * 4
    line = run([(i, [float(i), 2.0 * i, 1.0]) for i in range(9)])  # one component has variance
    assert all((r.whitened is None) == (r.component > 1) for r in line) and line[0].identity_error < 1e-9
    far = run([(i, [3e16 * (i % 2), float(i)]) for i in range(6)])  # sums leave a long
    assert {r.deviation for r in far} == {None} and max(abs(r.whitened) for r in far if r.component == 1) == pytest.approx(1, rel=1e-6)
    assert run([(1, [1e30, 1.0])]) == []
