import hashlib
import math
import re
import zlib

import numpy as np
import pyarrow as pa

from conftest import rows
from tidemark.llm import importance as imp, regular_sort

SCHEMA = "doc_id long, text string"
TARGET = [(1, "the cat sat on the mat"), (2, "Ünï-code CAT; on 42 mats"), (3, None), (4, "")]


def plain_features(text):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)
    return words, words + [f"{a} {b}" for a, b in zip(words, words[1:])]


def plain_resampled(docs, target):
    def bucket(f):
        return zlib.crc32(f.encode()) % 10000

    s, t = [0] * 10000, [0] * 10000
    for counts, texts in ((s, docs), (t, target)):
        for _, text in texts:
            for f in plain_features(text)[1]:
                counts[bucket(f)] += 1
    S, T = sum(s), sum(t)
    scored = []
    for at, (doc_id, text) in enumerate(docs):
        words, features = plain_features(text)
        gain = [math.floor(1000 * math.log((t[b] + 1) * (S + 10000) / ((s[b] + 1) * (T + 10000)))) for b in map(bucket, features)]
        weight = math.floor(sum(gain) / len(gain)) if gain else 0
        h = int(hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        scored.append([doc_id, len(features), weight, score, None, len(words)])
    able = [x for x in scored if x[5] >= 20]
    able.sort(key=lambda x: (-x[3], x[0] is None, x[0]))
    for rank, x in enumerate(able[: 25 * len(able) // 100]):
        x[4] = rank + 1
    return sorted((tuple(x[:5]) for x in scored), key=repr)


def documents(n=300):
    rng = np.random.default_rng(4)
    vocabulary = ["the", "cat", "sat", "on", "mat", "Ünï", "42", "x" * 70, "É-é", "dog", "ran", "&&", "A.b"]
    docs = [(i, " ".join(rng.choice(vocabulary, rng.integers(0, 60)))) for i in range(n)]
    return docs + [(None, "cat " * 25), (900, None), (901, ""), (902, "\x00 ;; "), (5, docs[5][1]), (903, "y" * 5000 + " " + "z" * 49 + "\tq" * 30)]


def test_resampled_equals_brute_force(spark):
    docs = documents()
    df = spark.createDataFrame(docs, SCHEMA).selectExpr("*", "'x' AS rank", "1 AS weight", "2 AS score", "3 AS n_words").repartition(5)
    target = spark.createDataFrame(TARGET, SCHEMA)
    assert rows(imp.resampled(df, target)) == plain_resampled(docs, TARGET)


def test_drawn_keeps_rows_and_columns(spark):
    df = spark.createDataFrame(documents(), SCHEMA).where("doc_id < 300").selectExpr("*", "doc_id + 1 AS rank")
    ranks = imp.resampled(df, spark.createDataFrame(TARGET, SCHEMA))
    kept = imp.drawn(df, ranks)
    assert kept.columns == df.columns and kept.count() == ranks.where("rank IS NOT NULL").count() > 0


def test_empty_tables(spark):
    none, some = spark.createDataFrame([], SCHEMA), spark.createDataFrame(documents(40), SCHEMA)
    assert imp.resampled(none, some).collect() == []
    assert rows(imp.resampled(some, none)) == plain_resampled(documents(40), [])


def test_ranks_hold_with_ties_and_one_hot_key(spark):
    data = [(5, i % 3) for i in range(3000)] + [(5, 77)] * 2000 + [(i % 7, None if i % 5 == 0 else i) for i in range(1000)] + [(-3, -(2**62)), (2**62, 1)]
    df = spark.createDataFrame(data, "score long, id long").repartition(9)
    for parts in (1, 2, 31):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        try:
            found = regular_sort.ranked(df, len(data), "score", "id", "rank")
            sizes = [r["count"] for r in found.groupBy(regular_sort.F.spark_partition_id()).count().collect()]
            got = [(r.score, r.id) for r in found.orderBy("rank").collect()]
            ranks = sorted(r.rank for r in found.collect())
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", 8)
        assert got == sorted(data, key=lambda x: (-x[0], x[1] is None, x[1] or 0))
        assert ranks == list(range(1, len(data) + 1)) and max(sizes) <= len(data)


def test_segments_stay_even_with_equal_rows(spark, monkeypatch):
    written, stage = [], regular_sort.stage
    monkeypatch.setattr(regular_sort, "stage", lambda df, label: written.append(stage(df, label)) or written[-1])
    df = spark.createDataFrame([(1, 1)] * 20000, "score long, id long").repartition(8)
    assert regular_sort.ranked(df, 20000, "score", "id", "rank").count() == 20000
    sizes = [r["count"] for r in written[0].groupBy("_segment").count().collect()]
    assert len(sizes) == 8 and max(sizes) <= 2 * 20000 / 8


def test_buckets_of_long_and_short_words():
    texts = ["a", "ab " * 3, "w" * 47 + " " + "w" * 48 + " " + "w" * 49 + " " + "w" * 50, "", "é" * 40 + " é"]
    bucket, owner, n = imp.feature_buckets(pa.array(texts), 2, 10000)
    for i, text in enumerate(texts):
        words, features = plain_features(text)
        assert sorted(bucket[owner == i]) == sorted(zlib.crc32(f.encode()) % 10000 for f in features) and n[i] == len(words)
