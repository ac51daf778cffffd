import math
import random
from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tidemark.llm import katz
from test_quality_rules import split


def words(text):
    return split("".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")) + ["</s>"]


class Plain:
    """The model, one count at a time."""

    def __init__(self, texts):
        self.one, self.two, self.context = Counter(), Counter(), Counter()
        for text in texts:
            before = "<s>"
            for word in words(text):
                self.one[word] += 1
                self.two[before, word] += 1
                self.context[before] += 1
                before = word
        self.n = sum(self.one.values())
        held = lambda c: [0] + [sum(v == r for v in c.values()) for r in range(1, 7)]
        self.d1, self.d2 = katz.discounts(held(self.one)), katz.discounts(held(self.two))
        left = self.n - sum(self.kept(c, self.d1) for c in self.one.values())
        if left <= 0:
            self.d1 = [self.n / (self.n + 1)] * 6
            self.scale = self.n / (self.n + 1)
            self.unseen = 1 / (self.n + 1)
        else:
            self.unseen = left / self.n
        self.after = defaultdict(list)
        for h, w in self.two:
            self.after[h].append(w)
        self.full, self.alpha = set(), {}
        for h, after in self.after.items():
            if sum(self.pair(h, w) for w in after) > 1 - 1e-12:
                self.full.add(h)
            self.alpha[h] = (1 - sum(self.pair(h, w) for w in after)) / (1 - sum(self.word(w) for w in after))

    @staticmethod
    def kept(c, d):
        return c * (d[c] if c <= 5 else 1)

    def word(self, w):
        return self.kept(self.one[w], self.d1) / self.n if self.one[w] else self.unseen

    def pair(self, h, w):
        return self.kept(self.two[h, w], self.d2) / (self.context[h] + (h in self.full))

    def p(self, h, w):
        return self.pair(h, w) if self.two[h, w] else self.alpha.get(h, 1.0) * self.word(w)

    def score(self, text):
        total, before = 0.0, "<s>"
        for word in words(text):
            total += math.log10(self.p(before, word))
            before = word
        return total


def corpus(n=160, seed=13):
    rng = random.Random(seed)
    vocabulary = [f"W{i}é" for i in range(120)]
    pick = lambda: vocabulary[min(int(rng.expovariate(0.06)), 119)]
    return [(i, rng.choice([" ", "\n"]).join(pick() for _ in range(rng.randrange(60)))) for i in range(n)]


def expected(docs, held):
    model = Plain([t for d, t in docs if not held(d)])
    out = {}
    for doc_id, text in docs:
        own = words(text)
        base = sum(math.log10((model.one[w] + 1) / (model.n + len(model.one) + 1)) for w in own)
        out[doc_id] = (held(doc_id), len(own), sum(model.one[w] > 0 for w in own), model.n, base, model.score(text))
    return model, out


def check(found, wanted):
    assert len(found) == len(wanted)
    for row in found:
        held, n, known, train, base, score = wanted[row.doc_id]
        assert (row.held_out, row.n_tokens, row.n_known, row.train_tokens) == (held, n, known, train)
        assert row.base_score == pytest.approx(base, rel=1e-9) and row.score == pytest.approx(score, rel=1e-9)


@pytest.mark.parametrize("block,part", [(8 << 20, 16 << 20), (900, 2000)])
def test_scores_equal_the_plain_model(spark, monkeypatch, block, part):
    monkeypatch.setattr(katz, "BLOCK", block)
    monkeypatch.setattr(katz, "PART", part)
    docs = corpus() + [(900, None), (901, ""), (902, "never seen words"), (903, "long " * 3000)]
    held = lambda d: d % 7 == 2
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 AS block", "2 AS part", "true AS held")
    found = katz.katz_scores(df.repartition(5), F.col("doc_id") % 7 == 2).collect()
    model, wanted = expected(docs, held)
    check(found, wanted)
    # After any context the probabilities of all words, and of the unseen one, add up to one.
    for h in [*list(model.context)[:40], "nowhere"]:
        assert sum(model.p(h, w) for w in [*model.one, "unseen"]) == pytest.approx(1, abs=1e-9)


def test_without_training_rows_and_empty(spark):
    df = spark.createDataFrame([(1, "a b"), (None, "a b"), (None, None)], "doc_id long, text string")
    found = katz.katz_scores(df, F.lit(True)).collect()
    assert sorted((r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in found) == [(1, 0, 0, 0, 0), (3, 0, 0, 0, 0), (3, 0, 0, 0, 0)]
    assert katz.katz_scores(df.limit(0), F.lit(False)).collect() == []


def test_a_context_with_frequent_pairs_only_leaves_something(spark):
    docs = corpus() + [(1000 + i, "always same") for i in range(12)] + [(2004, "always other w1é"), (2011, "always same")]
    held = lambda d: d % 7 == 2
    found = katz.katz_scores(spark.createDataFrame(docs, "doc_id long, text string"), F.col("doc_id") % 7 == 2).collect()
    model, wanted = expected(docs, held)
    assert 2004 % 7 == 2 and "always" in model.full
    check(found, wanted)
    assert sum(model.p("always", w) for w in [*model.one, "unseen"]) == pytest.approx(1, abs=1e-9)


def test_repeated_rows_count(spark):
    docs = [(1, "a b a"), (1, "a b a"), (2, "b")]
    found = katz.katz_scores(spark.createDataFrame(docs, "doc_id long, text string"), F.lit(False)).collect()
    model = Plain([t for _, t in docs])
    assert sorted(r.score for r in found) == pytest.approx(sorted(model.score(t) for _, t in docs))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 1000), min_size=7, max_size=7))
def test_discounts_leave_a_part(counts):
    factors = katz.discounts(counts)
    assert all(0 < f <= 1 for f in factors) and factors[1] < 1


def test_discounts_are_good_turing_with_bumps_and_gaps():
    half = [1, *[(r - 0.5) / r for r in range(1, 6)]]
    # A bump of copies at five makes the plain factor of four larger than one; doubled documents
    # leave gaps; documents five times over have one count up to six.
    bump, doubled, fives = [0, 6000, 2000, 1000, 600, 900, 300], [0, 0, 6000, 0, 2000, 0, 1000], [0] * 5 + [60, 0, 0, 0, 0, 20]
    for counts in (bump, doubled, fives):
        factors = list(katz.discounts(counts))
        assert factors[0] == 1 and all(0 < a < b < 1 for a, b in zip(factors[1:], factors[2:]))
        assert max(abs(a - b) for a, b in zip(factors, half)) > 0.02
    smooth = [0, 6000, 2000, 1000, 600, 400, 300]
    common = 6 * 300 / 6000
    wanted = [((r + 1) * smooth[r + 1] / (r * smooth[r]) - common) / (1 - common) for r in range(1, 6)]
    assert list(katz.discounts(smooth))[1:] == pytest.approx(wanted)
    # A power law with gaps has the slope of the law.
    assert katz._slope([0] + [round(1e12 * r**-2.5) for r in range(1, 7)], 5) == pytest.approx(-2.5, abs=1e-6)
    assert list(katz.discounts([0] * 7)) == half


def test_doubled_documents_keep_good_turing_discounts(spark):
    docs = [row for row in corpus() for _ in range(2)]
    held = lambda d: d % 7 == 2
    model, wanted = expected(docs, held)
    assert 1 not in model.two.values()
    assert abs(model.d2[2] - 0.75) > 0.01 and abs(model.d2[4] - 0.875) > 0.01
    found = katz.katz_scores(spark.createDataFrame(docs, "doc_id long, text string"), F.col("doc_id") % 7 == 2).collect()
    assert len(found) == len(docs)
    for row in found:
        assert row.score == pytest.approx(wanted[row.doc_id][5], rel=1e-9)
