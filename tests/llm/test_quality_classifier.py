import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from conftest import rows
from tidemark.llm import quality_classifier as qc
from test_quality_rules import split


def texts(n, seed=8):
    rng = random.Random(seed)
    good, bad = [f"good{i}" for i in range(80)], [f"bad{i}" for i in range(80)]
    both = [f"Word{i}é" for i in range(200)]
    out = []
    for i in range(n):
        label = int(rng.random() < 0.7)
        own = good if label else bad
        out.append((i, " ".join(rng.choice(own if rng.random() < 0.15 else both) for _ in range(rng.randrange(10, 60))), label))
    return out


def test_features_are_the_distinct_words_and_pairs():
    docs = ["A b a B c", "", "x", " \t\n ", "é É " * 3, "long " * 5000]
    found, features = qc.row_features(pa.array(docs), 1 << 40)
    assert found.tolist() == sorted(found.tolist())
    for row, text in enumerate(docs):
        words = split("".join(c.lower() if "A" <= c <= "Z" else c for c in text))
        assert (found == row).sum() == len(set(words) | set(zip(words, words[1:])))
    one = [set(features[found == r]) for r in range(len(docs))]
    other = qc.row_features(pa.array(docs[::-1]), 1 << 40)
    assert one == [set(other[1][other[0] == len(docs) - 1 - r]) for r in range(len(docs))]


def test_ratios_equal_counts(spark):
    data = texts(120)
    frame = spark.createDataFrame([(t, q) for _, t, q in data], "text string, quality int").repartition(4)
    counts = [Counter(), Counter()]
    for _, t, q in data:
        counts[q].update(qc.row_features(pa.array([t]))[1].tolist())
    n = [sum(c.values()) + qc.BUCKETS for c in counts]
    expected = np.log([(counts[1][f] + 1) / n[1] / ((counts[0][f] + 1) / n[0]) for f in range(qc.BUCKETS)])
    assert np.allclose(qc.ratios(frame), expected, atol=1e-5)


def test_dual_coordinate_descent_reaches_the_optimum():
    rng = np.random.default_rng(9)
    x = rng.normal(size=(60, 4))
    labels = np.sign(x @ [1, -2, 0.5, 0] + 0.3 * rng.normal(size=60))
    rows_ = [(np.arange(4), row) for row in x]
    weights = qc.dual_coordinate_descent(rows_, labels, 4, 1.0, 2000)
    share = np.where(labels > 0, np.mean(labels > 0), np.mean(labels < 0))
    loss = lambda w: w @ w / 2 + (np.maximum(0, 1 - labels * (x @ w)) / (2 * share)).sum()
    best = loss(weights)
    assert all(best <= loss(weights + d) + 1e-6 for d in rng.normal(scale=0.05, size=(300, 4)))


def test_held_out_accuracy(spark):
    data = texts(900)
    model = qc.fit(spark.createDataFrame(data[:600], "doc_id long, text string, quality int"))
    scored = {r.doc_id: r.score for r in qc.score(spark.createDataFrame(data[600:], "doc_id long, text string, quality int"), model).collect()}
    assert np.mean([(scored[i] >= 0.5) == q for i, _, q in data[600:]]) > 0.95


@pytest.mark.parametrize("labels", [[], [1, 1], [0], [None, 2]])
def test_one_class_or_none(spark, labels):
    frame = spark.createDataFrame([(i, f"text {i}", q) for i, q in enumerate(labels)], "doc_id long, text string, quality int")
    model = qc.fit(frame)
    found = rows(qc.score(spark.createDataFrame([(1, "a"), (1, "a"), (None, None)], "doc_id long, text string"), model))
    assert len(found) == 3 and len({s for _, s in found}) == 1 and all(0 < s < 1 for _, s in found)


def test_odd_rows_and_clashing_columns(spark):
    data = texts(200) + [(900, None, 1), (901, "", 0), (902, "good1 " * 20000, 1), (None, "bad1 bad2", 0), (5, "good1", None)]
    frame = spark.createDataFrame(data, "doc_id long, text string, quality int").selectExpr("*", "1 AS score", "2 AS features")
    model = qc.fit(frame)
    found = qc.score(frame, model)
    assert found.count() == len(data) and all(0 <= r.score <= 1 for r in found.collect())
    assert qc.score(frame.limit(0), model).collect() == []


def test_a_rare_class_is_learnt_from(spark):
    rng = random.Random(3)
    data = [(i, " ".join(rng.choice([f"bad{k}" for k in range(80)]) for _ in range(12)), 0) for i in range(5000)]
    data[777] = (777, "good1 good2 good3 good4 good5", 1)
    model = qc.fit(spark.createDataFrame(data, "doc_id long, text string, quality int"), sample=500)
    scored = qc.score(spark.createDataFrame([(0, "good1 good2 good3"), (1, "bad1 bad2 bad3")], "doc_id long, text string"), model)
    good, bad = [s for _, s in rows(scored)]
    assert good > 10 * bad and bad < 0.05


def test_samples_of_a_small_share_have_both_classes(spark):
    data = [(i, f"{'good' if i % 2 else 'bad'}{i % 40} x{i % 7}", i % 2) for i in range(20000)]
    model = qc.fit(spark.createDataFrame(data, "doc_id long, text string, quality int"), sample=40)
    found = qc.score(spark.createDataFrame([(0, "bad2 bad4"), (1, "good1 good3")], "doc_id long, text string"), model)
    bad, good = [s for _, s in rows(found)]
    assert good > 0.5 > bad
