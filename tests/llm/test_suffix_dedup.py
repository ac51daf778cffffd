import hashlib
import random

import numpy as np
import pytest

from conftest import rows
from tidemark.llm import common, suffix_dedup as sd


def plain(docs):
    first = {}
    texts = [(d, (t or "").encode()) for d, t in docs]
    for d, t in texts:
        if d is not None:
            for i in range(len(t) - 49):
                s = t[i : i + 50]
                first[s] = min(first.get(s, d), d)
    out = []
    for d, t in texts:
        gone = bytearray(len(t))
        for i in range(len(t) - 49):
            f = first.get(t[i : i + 50])
            if f is not None and (d is None or f < d):
                gone[i : i + 50] = b"\1" * 50
        kept = bytes(b for b, g in zip(t, gone) if not g)
        spans = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        out.append((d, len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("letters", [1, 2, 4, 250])
@pytest.mark.parametrize("n", [0, 1, 49, 700, 5000])
def test_suffix_array_and_prefixes(letters, n):
    data = np.random.default_rng(n).integers(0, letters, n).astype(np.uint8)
    data[n // 2 :] = data[: n - n // 2]
    order, rank = sd.suffix_array(data)
    text = data.tobytes()
    assert sorted(order.tolist()) == list(range(n))
    whole = [text[i:] for i in order.tolist()]
    assert whole == sorted(whole)
    cut = [w[:50] for w in whole]
    prefixes = sd.common_prefixes(data, order, lanes=64)
    for k in range(1, n):
        a, b = cut[k - 1], cut[k]
        same = next((i for i in range(min(len(a), len(b))) if a[i] != b[i]), min(len(a), len(b)))
        assert prefixes[k] == same


def test_merge_by_binary_search_equals_one_shard():
    rng = np.random.default_rng(15)
    base = rng.integers(0, 3, 300).astype(np.uint8)
    shards, every = [], {}
    for _ in range(4):
        data = np.concatenate([base[a : a + 90] for a in rng.integers(0, 200, 12)])
        starts = np.arange(0, len(data) - 49, 3)
        docs = rng.integers(0, 1000, len(starts))
        shards.append((data, starts, docs))
        for s, d in zip(starts, docs):
            key = data[s : s + 50].tobytes()
            every[key] = min(every.get(key, 10**9), d)
    for (data, starts, _), found in zip(shards, sd.merged_first_documents(shards)):
        assert found.tolist() == [every[data[s : s + 50].tobytes()] for s in starts]


def corpus():
    rng = random.Random(14)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randrange(1, 9)))
    prose = lambda n: " ".join(word() for _ in range(n))
    shared = [prose(20) for _ in range(5)] + ["x" * 120, "ab" * 70, "\0" * 60, "é" * 40]
    docs = []
    for i in range(150):
        parts = [prose(rng.randrange(25)) for _ in range(3)]
        for _ in range(rng.randrange(3)):
            piece = rng.choice(shared)
            cut = rng.randrange(len(piece) // 2)
            parts.insert(rng.randrange(3), piece[cut:] if rng.random() < 0.5 else piece)
        docs.append((i, rng.choice(["", " ", "\n"]).join(parts)))
    docs += [(200, docs[3][1]), (201, docs[3][1] + "!"), (202, docs[3][1][7:]), (7, docs[3][1]), (7, docs[8][1] * 2)]
    docs += [(None, docs[4][1]), (None, prose(30) + docs[4][1]), (300, None), (301, ""), (302, "z" * 49), (303, "z" * 50), (304, "z" * 5000)]
    return docs


@pytest.mark.parametrize("block,part,shard", [(4 << 20, 16 << 20, 1 << 20), (1500, 3000, 700)])
def test_removed_bytes_equal_brute_force(spark, monkeypatch, block, part, shard):
    for name, value in (("BLOCK", block), ("PART", part), ("CHUNK", 3 * shard), ("SHARD", shard)):
        monkeypatch.setattr(sd, name, value)
    monkeypatch.setattr(common, "MAX_BUCKETS", 8)
    docs = corpus()
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 AS block", "2 AS spans").repartition(4)
    removed = sd.repeats_removed(df)
    assert rows(sd.repeat_digest(removed)) == sorted(plain(docs), key=repr)
    for row in removed.collect():
        assert sum(s.end - s.start for s in row.spans) == row.n_bytes - len(row.kept)


def test_nothing_repeated_and_empty(spark):
    df = spark.createDataFrame([(1, "a" * 60), (2, "b" * 60)], "doc_id long, text string")
    assert [r[2] for r in rows(sd.repeat_digest(sd.repeats_removed(df)))] == [0, 0]
    assert sd.repeats_removed(df.limit(0)).collect() == []
