import math

import numpy as np
import pytest

from conftest import rows
from tidemark.llm import impact_search as search

SCHEMA = "vec_id long, embedding array<float>"


def plain_nearest(data, k=5, every=50):
    kept = [(i, r, [math.floor(256 * float(np.float32(x))) for x in e]) for r, (i, e) in enumerate(data) if e is not None and all(x is not None and math.isfinite(x) for x in e)]
    out = []
    for query_id, own, q in kept:
        if query_id is None or query_id % every:
            continue
        scores = [(-sum(a * b for a, b in zip(q, x)), i is None, i) for i, r, x in kept if r != own]
        for rank, (score, _, i) in enumerate(sorted(scores, key=lambda s: (s[0], s[1], s[2] or 0))[:k]):
            out.append((query_id, rank + 1, i, -score))
    return sorted(out, key=repr)


def vectors(n, size=16, seed=1):
    rng = np.random.default_rng(seed)
    e = rng.normal(size=(n, size)) / math.sqrt(size)
    e[n // 2 :: 3] = e[:1] + rng.normal(size=e[n // 2 :: 3].shape) * 0.01
    return [(i, [float(np.float32(x)) for x in row]) for i, row in enumerate(e)]


def test_nearest_equals_brute_force(spark):
    data = vectors(400)
    data += [(1000, data[0][1]), (1001, data[0][1]), (0, data[0][1]), (None, data[0][1]), (50, data[7][1])]
    data += [(1050, None), (1100, [None] + [0.0] * 15), (1150, [float("nan")] * 16), (1200, [float("inf")] * 16), (1250, []), (1300, [0.0] * 16), (1350, [0.5]), (-50, [0.1] * 20)]
    df = spark.createDataFrame(data, SCHEMA).selectExpr("*", "1 AS score", "2 AS rank", "'x' AS q", "3 AS row").repartition(4)
    assert rows(search.nearest(df)) == plain_nearest(data)


@pytest.mark.parametrize("shard,block", [(64, 3), (100, 1000)])
def test_shards_and_blocks_do_not_change_the_result(spark, monkeypatch, shard, block):
    data = vectors(600, size=8, seed=2)
    monkeypatch.setattr(search, "SHARD", shard)
    monkeypatch.setattr(search, "BLOCK", block)
    assert rows(search.nearest(spark.createDataFrame(data, SCHEMA), k=7)) == plain_nearest(data, 7)


def test_stops_on_proof_before_the_end():
    rng = np.random.default_rng(3)
    e = rng.normal(size=(4000, 64))
    v = np.floor(256 * e / np.linalg.norm(e, axis=1, keepdims=True)).astype(np.int64)
    index, used = search.Index(v), []
    for own in range(0, 4000, 200):
        there, exact, n = index.top(v[own], 5, own)
        plain = v @ v[own]
        plain[own] = -(10**12)
        assert set(there) == set(np.flatnonzero(plain >= np.sort(plain)[-5])) and (plain[there] == exact).all()
        used.append(n / v.size)
    assert np.mean(used) < 0.6


@pytest.mark.parametrize("scale", [1, 40, 10**4])
def test_lengths_of_any_spread_are_exact(scale):
    rng = np.random.default_rng(5)
    v = np.floor(rng.normal(size=(500, 12)) * rng.choice([1, 30, scale], size=(500, 1))).astype(np.int64)
    v[::50] = 0
    for own in range(0, 500, 25):
        there, exact, _ = search.Index(v).top(v[own], 3, own)
        plain = v @ v[own]
        plain[own] = -(10**15)
        assert set(there) == set(np.flatnonzero(plain >= np.sort(plain)[-3]))


def test_few_rows(spark):
    assert search.nearest(spark.createDataFrame([], SCHEMA)).collect() == []
    assert search.nearest(spark.createDataFrame([(0, [1.0])], SCHEMA)).collect() == []
    two = search.nearest(spark.createDataFrame([(0, [1.0]), (3, [-1.0])], SCHEMA)).collect()
    assert [tuple(r) for r in two] == [(0, 1, 3, -65536)]
