from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np
import pytest

from lakemart.llm import topk

SCHEMA = "vec_id long, embedding array<float>, grp int, query long"


def brute(rows, k, divisor=20):
    valid = []
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            f = [math.floor(64 * float(np.float32(x))) for x in v]
            valid.append((i, [max(-topk.LIMIT, min(topk.LIMIT, x)) for x in f]))
    out = Counter()
    for a, (i, v) in enumerate(valid):
        if i % divisor == 0:
            scored = sorted(
                (-max(-topk.LIMIT, min(topk.LIMIT, sum(x * y for x, y in zip(v, w)))), j) for b, (j, w) in enumerate(valid) if b != a
            )
            for r, (s, j) in enumerate(scored[:k], 1):
                out[i, r, j, -s] += 1
    return out


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, 2) for i, v in rows], SCHEMA).repartition(3)


@pytest.mark.parametrize(("block", "columns"), [(4096, 64), (17, 3)])
def test_matches_brute_force(spark, monkeypatch, block, columns):
    monkeypatch.setattr(topk, "BLOCK", block)
    monkeypatch.setattr(topk, "COLUMNS", columns)
    rng = random.Random(2)
    rows = [(i, [rng.gauss(0, 0.1) for _ in range(8)]) for i in range(200)]
    rows += [(i, [rng.choice([0.0, 0.0, 0.0, 0.5, -0.5]) for _ in range(8)]) for i in range(200, 300)]
    rows += [(300, None), (320, [None] * 8), (340, [float("nan")] * 8), (360, [float("inf")] + [0.0] * 7)]
    rows += [(380, []), (400, [1.0]), (420, [0.5] * 12), (440, [1e9] * 8), (None, [0.1] * 8)]
    rows += [(500 + i, [0.25] * 8) for i in range(60)] + [(600, [0.25] * 8)] * 3
    rng.shuffle(rows)
    got = Counter(tuple(r) for r in topk.search(frame(spark, rows), spark).collect())
    assert got == brute(rows, 20)


def test_fewer_rows_than_k(spark):
    rows = [(0, [0.5, 0.5]), (1, [0.1, 0.9]), (20, [-0.5, 0.5])]
    got = Counter(tuple(r) for r in topk.search(frame(spark, rows), spark).collect())
    assert got == brute(rows, 20) and sum(got.values()) == 4


def test_one_row_and_none(spark):
    assert topk.search(frame(spark, [(20, [1.0])]), spark).count() == 0
    assert topk.search(frame(spark, [(20, [1.0])]).limit(0), spark).count() == 0


def test_accumulate_is_the_inner_product():
    rng = np.random.default_rng(0)
    for density in (0.05, 0.5, 1.0):
        q = rng.integers(-40, 40, (9, 30)) * (rng.random((9, 30)) < density)
        w = rng.integers(-40, 40, (50, 33)) * (rng.random((50, 33)) < density)
        assert np.array_equal(topk.accumulate(q, w), w[:, :30] @ q.T)


def test_large_weights_are_exact(spark):
    rows = [(20, [1e7, 2.0]), (1, [1e7, 1.0]), (2, [-3e7, 4.0]), (3, [3e7, 0.5])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    w = {i: [math.floor(64 * x) for x in v] for i, v in rows}
    want = sorted(((sum(a * b for a, b in zip(w[20], w[i], strict=True)), i) for i in (1, 2, 3)), key=lambda x: (-x[0], x[1]))
    assert [(r.score, r.vec_id) for r in topk.search(df, spark).orderBy("rank").collect()] == want
    vast = spark.createDataFrame([(20, [1e30]), (1, [1.0]), (2, [-1e30])], "vec_id long, embedding array<double>")
    assert [(r.score, r.vec_id) for r in topk.search(vast, spark).orderBy("rank").collect()] == [
        (topk.LIMIT, 1), (-topk.LIMIT, 2)
    ]
