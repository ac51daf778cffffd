import math

import numpy as np

from conftest import rows
from tidemark.llm import embedding_dedup as ed

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain_groups(data):
    good = lambda v: v and all(c is not None and math.isfinite(c) for c in v) and any(v)
    unit = [np.array(v, dtype=np.float32).astype(float) if good(v) else None for _, v, _ in data]
    near = [[] for _ in data]
    for i in range(len(data)):
        for j in range(i):
            a, b = unit[i], unit[j]
            if a is None or b is None or len(a) != len(b) or data[i][2] is None or data[i][2] != data[j][2]:
                continue
            if a @ b / np.linalg.norm(a) / np.linalg.norm(b) >= 0.98:
                near[i].append(j)
                near[j].append(i)
    out = []
    for i, (vec_id, _, _) in enumerate(data):
        seen, todo = {i}, [i]
        while todo:
            for j in near[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        ids = [data[j][0] for j in seen if data[j][0] is not None]
        least = min(ids) if ids else None
        out.append((vec_id, len(near[i]), least, vec_id == least))
    return out


def near_copies(rng, n, size=64, spread=0.16):
    base = rng.normal(size=(n // 4, size))
    base /= np.linalg.norm(base, axis=1, keepdims=True)
    x = base[rng.integers(0, len(base), n)] + rng.normal(size=(n, size)) * spread / math.sqrt(size) * rng.random((n, 1))
    return x * rng.uniform(0.5, 2, (n, 1))


def test_groups_equal_brute_force(spark):
    rng = np.random.default_rng(10)
    data = [(i, v.tolist(), int(rng.integers(0, 3))) for i, v in enumerate(near_copies(rng, 500))]
    data += [(600 + i, data[0][1], data[0][2]) for i in range(20)] + [(5, data[5][1], data[5][2])]
    nan = float("nan")
    data += [(700, None, 1), (701, [0.0] * 64, 1), (702, [nan] * 64, 1), (703, [None] + [1.0] * 63, 1), (704, [], 1),
             (705, data[0][1], None), (706, [1.0, 2.0], 1), (707, [2.0, 4.0], 1), (None, data[0][1], data[0][2]), (None, None, None)]
    df = spark.createDataFrame(data, SCHEMA).selectExpr("*", "1 AS g", "2 AS cell", "3 AS root")
    found, expected = rows(ed.embedding_groups(df)), sorted(plain_groups(data), key=repr)
    assert found == expected and sum(r[1] > 0 for r in found) > 200


def test_blocks_of_a_large_cell_lose_nothing(spark, monkeypatch):
    monkeypatch.setattr(ed, "BLOCK", 16)
    rng = np.random.default_rng(11)
    centre = rng.normal(size=64)
    data = [(i, (centre + rng.normal(size=64) * 0.09).tolist(), 1) for i in range(150)]
    df = spark.createDataFrame(data, SCHEMA)
    assert rows(ed.embedding_groups(df)) == sorted(plain_groups(data), key=repr)


def test_pairs_at_the_threshold_reach_the_count():
    rng = np.random.default_rng(12)
    a = rng.normal(size=(4000, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b = rng.normal(size=a.shape)
    b -= (a * b).sum(axis=1, keepdims=True) * a
    b /= np.linalg.norm(b, axis=1, keepdims=True)
    b = 0.98 * a + math.sqrt(1 - 0.98**2) * b
    width = ed.WIDTH * math.sqrt(0.04 / 64)
    hits = (np.abs((a - b) @ ed.directions(64)) <= width).sum(axis=1)
    assert (hits >= ed.required_count(ed.PROJECTIONS)).mean() > 0.999


def test_empty_table(spark):
    assert ed.embedding_groups(spark.createDataFrame([], SCHEMA)).collect() == []
