import random

import numpy as np
import pytest

from outpulse.llm import ann

SCHEMA = "vec_id LONG, embedding ARRAY<FLOAT>"


def truth(rows, k=5):
    """Nearest rows of every query by exact cosine, ties to smaller ids."""
    good = {}
    for i, v in rows:
        if i is not None and v and None not in v and np.isfinite(v).all() and any(v) and len(v) == 8:
            good[i] = np.array(v, float)
    unit = {i: v / np.linalg.norm(v) for i, v in good.items()}
    return {q: sorted(((-round(float(unit[q] @ u), 9), i) for i, u in unit.items() if i != q))[:k] for q in good if q % 50 == 0}


def test_odd_vectors_and_ties(spark):
    draw = random.Random(0)
    v = [[draw.gauss(0, 1) for _ in range(8)] for _ in range(60)]
    rows = [(i, v[i % 60]) for i in range(400)]
    rows += [(1000, None), (1001, [0.0] * 8), (1002, [None] + [1.0] * 7), (1050, [float("nan")] * 8), (1051, [float("inf")] * 8),
             (1100, [1.0] * 3), (None, v[0]), (1150, []), rows[0], rows[0], (50_000, [1e-30] * 8)]
    full = [(i, None if x is None else [None if y is None else float(np.float32(y)) for y in x]) for i, x in rows]
    vectors = spark.createDataFrame(full, SCHEMA)
    got = {}
    for r in ann.nearest(vectors, vectors.where("vec_id % 50 = 0")).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    want = truth(full)
    assert set(got) == set(want)
    for q, found in got.items():
        assert [x for x, *_ in sorted(found)] == [1, 2, 3, 4, 5]
        assert [(i, round(s, 6)) for _, i, s in sorted(found)] == [(i, round(-s, 6)) for s, i in want[q]]


def test_few_and_no_candidates(spark):
    few = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 2.0])], SCHEMA)
    assert [tuple(r) for r in ann.nearest(few, few.where("vec_id = 0")).collect()] == [(0, 1, 1, 0.0)]
    one = few.limit(1)
    assert ann.nearest(one, one).collect() == []
    assert ann.nearest(few.limit(0), few).collect() == []


@pytest.mark.parametrize("clusters", [0, 20])
def test_recall(spark, clusters):
    draw = np.random.default_rng(1)
    x = draw.normal(size=(4000, 32))
    if clusters:
        x = draw.normal(size=(clusters, 32))[draw.integers(0, clusters, 4000)] + 0.2 * x
    x = x.astype(np.float32)
    vectors = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], SCHEMA)
    found = {}
    for r in ann.nearest(vectors, vectors.where("vec_id % 50 = 0")).collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    unit = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    hits = 0
    for q in range(0, 4000, 50):
        score = unit @ unit[q]
        score[q] = -2
        hits += len(found[q] & set(np.argsort(-score)[:5].tolist()))
    assert hits >= 0.9 * 5 * 80
