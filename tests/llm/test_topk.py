"""Top-k against all scores."""

import math
import random
from collections import Counter

import numpy as np
import pytest

from strata.llm import topk
from strata.llm.common import prepare

SCHEMA = "vec_id long, embedding array<float>, label int, size string, block string, rank string, score string"


def brute(rows, k, every):
    good = [(i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = Counter()
    for q, a in {(i, tuple(v)) for i, v in good if i % every == 0}:
        best = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in good if i != q and len(a) == len(b))[:k]
        out.update((q, r + 1, i, -s) for r, (s, i) in enumerate(best))
    return out


def run(spark, rows, **more):
    prepare(spark)
    df = spark.createDataFrame([(i, v, 0, "x", "x", "x", "x") for i, v in rows], SCHEMA).repartition(3)
    return Counter((r.query_id, r["rank"], r.vec_id, r.score) for r in topk.top_k(df, **more).collect())


def vectors(n, dims, seed=1, step=None):
    rng = random.Random(seed)
    return [(i, [float(np.float32(rng.gauss(0, 0.2) if step is None else round(rng.gauss(0, 1)) * step)) for _ in range(dims)]) for i in range(n)]


@pytest.mark.parametrize("step", [None, 0.25])
def test_random_vectors_and_ties(spark, step, monkeypatch):
    monkeypatch.setattr(topk, "CANDIDATES", 64)
    monkeypatch.setattr(topk, "QUERIES", 8)
    rows = vectors(400, 6, step=step)
    assert run(spark, rows, every=10) == brute(rows, 5, 10)


def test_awkward_vectors(spark):
    rows = vectors(60, 3) + [(100, None), (101, [0.1, None, 0.2]), (102, [float("nan"), 0.0, 0.0]), (103, [float("inf"), 0.0, 0.0]), (None, [1.0, 1.0, 1.0]), (150, [0.0, 0.0, 0.0]),
                             (200, [0.5, 0.5]), (201, [0.5, -0.5]), (250, []), (251, []), (300, [-1000.0, 3000.25, 0.001])] + [(7, [9.0, 9.0, 9.0])] * 9
    assert run(spark, rows) == brute(rows, 5, 50)


def test_different_vectors_under_one_vec_id(spark):
    rows = vectors(40, 3) + [(50, [0.5, 0.0, 0.0]), (50, [0.0, -0.5, 0.0]), (50, [0.0, -0.5, 0.0]), (50, [0.0, 0.0, 0.25])]
    asked = {tuple(math.floor(256 * x) for x in v) for i, v in rows if i == 50}
    every = sorted((-sum(x * math.floor(256 * y) for x, y in zip(a, b)), i) for a in asked for i, b in rows if i != 50)
    got = run(spark, [r for r in rows if r[0]])
    want = [x for x in every if x[1]][:5]
    assert got == Counter((50, r + 1, i, -s) for r, (s, i) in enumerate(want))


def test_fewer_candidates_than_k(spark):
    rows = vectors(4, 5)
    assert run(spark, rows, every=2) == brute(rows, 5, 2)
    assert not run(spark, []) and not run(spark, rows[:1])


def test_scores_beyond_the_integers_of_double_precision(spark):
    rng = random.Random(5)
    rows = [(i, [rng.randrange(1 << 23, 1 << 24) / 256 for _ in range(64)]) for i in range(120)]
    rows += [(200, [float(np.float32(2.0 ** 15 + 1 / 256))] * 64), (201, [2.0 ** 16 - 1 / 256] * 64), (202, [2.0 ** 16 - 1 / 128] * 64)]
    got = run(spark, rows, every=10)
    assert got == brute(rows, 5, 10) and max(abs(r[3]) for r in got) > 2 ** 53 and any(r[3] != int(float(r[3])) for r in got)


def test_bounds_stop_early_on_spread_vectors():
    rng = np.random.default_rng(3)
    x = np.floor(256 * rng.standard_normal((2000, 4)) ** 3)
    ids = np.arange(2000)
    for query, found, scores in topk.search_block(ids, x, ids[:40], x[:40], 5):
        every = x @ x[query]
        every[query] = -np.inf
        order = np.lexsort((ids, -every))[:5]
        assert (found == ids[order]).all() and (scores == every[order]).all()


def test_depth_at_which_queries_stop():
    rng = np.random.default_rng(3)
    for x, early in ((np.floor(256 * rng.standard_normal((2000, 4)) ** 3), True), (np.floor(256 * rng.standard_normal((2000, 64))), False)):
        stops = {}
        assert len(list(topk.search_block(np.arange(2000), x, np.arange(40), x[:40], 5, stops))) == 40 == sum(stops.values())
        assert (stops.get(1.0, 0) < 40) == early
