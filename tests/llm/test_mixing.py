from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from conftest import rows
from tidemark.llm import mixing


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 60), min_size=1, max_size=12))
def test_schedule_is_less_than_one_block_off(units):
    period = sum(units)
    slots = mixing.schedule(units)
    assert sorted(s for own in slots for s in own) == list(range(period))
    for own, share in zip(slots, units):
        for k, slot in enumerate(own):
            release, deadline = mixing.window_of(k, share, period)
            assert release <= slot < deadline
        for now in range(period + 1):
            assert abs(sum(slot < now for slot in own) - now * share / period) < 1


@given(st.lists(st.tuples(st.integers(1, 1000), st.floats(0.1, 9)), min_size=1, max_size=9), st.floats(0.1, 1))
def test_quotas_share_by_weight_up_to_the_supply(sources, part):
    supply, weights = [n for n, _ in sources], [w for _, w in sources]
    total = int(part * sum(supply))
    got = mixing.quotas(supply, weights, total)
    assert all(0 <= g <= n for g, n in zip(got, supply)) and total - len(got) <= sum(got) <= total
    free = [(g + 1) / w for g, n, w in zip(got, supply, weights) if g < n]
    # Sources with documents to spare get the same per weight, and no other gets more.
    if free:
        level = max(free)
        assert all(g / w <= level + 1e-6 for g, w in zip(got, weights))


def test_shares_add_up():
    assert mixing.shares([1, 1000, 1], 8) == [1, 6, 1]
    assert sum(mixing.shares([3, 3, 3], 1024)) == 1024


@pytest.fixture(scope="module")
def docs(spark):
    data = [(i, ["a", "a", "a", "b", None, "c"][i % 6] if i % 50 else "", f"text {i}", i) for i in range(3000)]
    data += [(7, "a", "again", 1), (None, "b", None, None), (None, None, "", None)]
    return spark.createDataFrame(data, "doc_id long, source string, text string, slot int")


def test_mixture(docs):
    found = mixing.mixture(docs, budget=0.6, block=4, resolution=64).collect()
    assert len(found) == docs.count()
    supply = Counter(r.source for r in found)
    assert all(sorted(r.rank for r in found if r.source == s) == list(range(n)) for s, n in supply.items())
    kept = [r for r in found if r.kept]
    assert all((r.slot is None) == (not r.kept) for r in found)
    quota = Counter(r.source for r in kept)
    small = min(supply, key=supply.get)
    assert quota[small] == supply[small] == 60 and quota["a"] == quota["b"] or quota["b"] == supply["b"]
    assert all(r.release <= r.slot < r.deadline for r in kept)
    # In every prefix of slots each source is less than one block from its share.
    blocks = {(r.source, r.block): r.slot for r in kept}
    last = max(blocks.values()) + 1
    for source in quota:
        own = [slot for (s, _), slot in blocks.items() if s == source]
        units = len(own) / last
        for now in range(last + 1):
            assert abs(sum(slot < now for slot in own) - now * units) < 1 + 1e-9


def test_order_does_not_depend_on_partitions(docs):
    one, two = mixing.mixture(docs), mixing.mixture(docs.repartition(5))
    unique = lambda df: [r for r in rows(df) if r[0] not in (7, None)]
    assert unique(one) == unique(two)


def test_mixed_keeps_the_rows_of_the_mixture(docs):
    kept = mixing.mixed(docs, budget=0.6)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in mixing.mixture(docs, budget=0.6).where("kept").collect()]
    assert set(ids) == {r.doc_id for r in kept.collect()} and abs(kept.count() - len(ids)) <= 2


def test_weights_and_sources_without_one(docs):
    found = mixing.mixture(docs, weights={"a": 3, "b": 1}, budget=0.2).where("kept")
    count = Counter(r.source for r in found.collect())
    assert set(count) == {"a", "b"} and count["a"] >= 2.9 * count["b"]


def test_every_document_has_a_slot_and_phases_hold_the_weights(spark):
    sizes, weights = {"a": 2000, "b": 700, None: 300, "c": 100}, {"a": 1, "b": 2, None: 3, "c": 1}
    data = [(i, s, f"t{i}") for i, s in enumerate(s for s, n in sizes.items() for _ in range(n))] + [(9000, "off", "t")]
    df = spark.createDataFrame(data, "doc_id long, source string, text string")
    found = mixing.mixture(df, weights=weights, block=2, resolution=28).collect()
    assert {r.source for r in found if not r.kept} == {"off"} and sum(r.kept for r in found) == 3100
    kept = sorted((r for r in found if r.kept), key=lambda r: (r.slot, r.rank))
    assert all(r.release <= r.slot < r.deadline for r in kept)
    # A slot is one source's, and slots go with ranks.
    assert len({r.slot for r in kept}) == len({(r.slot, r.source) for r in kept}) == len({(r.source, r.block) for r in kept})
    # While all have documents left, each is near its target; then those left share by weight.
    left, given = dict(sizes), Counter()
    at = 0
    while any(left.values()):
        alive = {s: w for s, w in weights.items() if left[s]}
        span = min(left[s] / w for s, w in alive.items())
        part = Counter()
        for n in range(round(span * sum(alive.values()))):
            part[kept[at].source] += 1
            at += 1
            if n % 7 == 0:
                assert all(abs(part[s] - (n + 1) * w / sum(alive.values())) <= 8 for s, w in alive.items()), (at, part)
        left = {s: left[s] - round(span * w) if s in alive else 0 for s, w in weights.items()}
    assert at == 3100
    order = [r.doc_id for r in mixing.mixed(df, weights=weights, block=2, resolution=28).collect()]
    assert order == [r.doc_id for r in kept]


@given(st.lists(st.tuples(st.integers(1, 1000), st.floats(0.1, 9)), min_size=1, max_size=30), st.integers(1, 9))
def test_phases_give_all_documents(sources, part):
    supply, weights = np.array([*[n for n, _ in sources], 5]), np.array([*[w for _, w in sources], 0.0])
    plan = list(mixing.phases(supply, weights))
    assert sum(given for _, _, given, _ in plan).tolist() == [*supply[:-1], 0]
    assert all((given >= 0).all() for _, _, given, _ in plan)
    # Sources with documents left hold their weights in every phase.
    for _, start, given, exact in plan:
        alive = (start + given < supply) & (weights > 0)
        per_weight = exact[alive] / weights[alive]
        assert not alive.any() or np.ptp(per_weight) <= 1e-9 * per_weight.max() and (abs(given - exact)[alive] < 1 + 1e-6).all()
    # Parts planned on their own are the same plan.
    again = [x for first in range(0, len(plan), part) for x in mixing.phases(supply, weights, first, part)]
    assert [[y.tolist() if i else y for i, y in enumerate(x)] for x in again] == [[y.tolist() if i else y for i, y in enumerate(x)] for x in plan]


def test_a_thousand_sources_that_run_out_one_by_one_hold_the_weights(spark):
    # Source k has k // 2 + 1 documents: 500 phases. While a source has documents, it gives one in each.
    sizes = {f"s{k}": k // 2 + 1 for k in range(1000)}
    df = spark.range(1000).selectExpr("concat('s', id) AS source", "explode(sequence(0L, id div 2)) AS i")
    df = df.selectExpr("row_number() OVER (ORDER BY source, i) AS doc_id", "source", "'t' AS text")
    found = mixing.mixture(df, block=1, resolution=16).collect()
    assert len(found) == sum(sizes.values()) and all(r.kept and r.release <= r.slot < r.deadline for r in found)
    kept = sorted(found, key=lambda r: r.slot)
    at, given = 0, Counter()
    for phase in range(500):
        alive = 1000 - 2 * phase
        part = Counter(r.source for r in kept[at : at + alive])
        assert len(part) == alive and set(part.values()) == {1}, phase
        at += alive
        given += part
    assert given == Counter(sizes)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, source string, text string")
    assert mixing.mixture(df).collect() == [] and mixing.mixed(df).collect() == []
