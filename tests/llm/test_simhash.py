import random
import re

import numpy as np
import pyarrow as pa
import xxhash

from conftest import rows
from tidemark.llm import simhash


def plain_fingerprint(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for blank in "\t\n\x0b\f\r":
        words = words.replace(blank, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    grams = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def plain_groups(docs):
    prints = [(doc_id, plain_fingerprint(text)) for doc_id, text in docs]
    group = {fp: {fp} for _, fp in prints}
    for a in list(group):
        for b in list(group):
            if (a ^ b).bit_count() <= 3 and group[a] is not group[b]:
                merged = group[a] | group[b]
                for fp in merged:
                    group[fp] = merged
    out = []
    for doc_id, fp in prints:
        ids = [d for d, other in prints if other in group[fp] and d is not None]
        out.append((doc_id, f"{fp:016x}", min(ids) if ids else None))
    return out


def test_code_is_perfect_and_homes_are_near():
    values = np.random.default_rng(1).integers(0, 1 << 63, 5000).astype(np.uint64)
    heads = simhash.homes(values)
    words = (heads << 11) ^ simhash._syndromes(heads << 11)
    assert (np.bitwise_count(words ^ (values & np.uint64((1 << 23) - 1)).astype(np.int64)) <= 3).all()


def test_no_pair_within_the_threshold_is_missed():
    rng = np.random.default_rng(2)
    values = rng.integers(0, 1 << 63, 2000).astype(np.uint64)
    for flips in range(4):
        other = values.copy()
        for i in range(len(other)):
            for bit in rng.choice(64, flips, replace=False):
                other[i] ^= np.uint64(1 << int(bit))
        index, anchors = simhash.around(values, 3)
        places = set(zip(index.tolist(), anchors.tolist())) | set(enumerate(simhash.homes(values).tolist()))
        assert all((i, home) in places for i, home in enumerate(simhash.homes(other).tolist()))


def test_groups_equal_brute_force(spark):
    rng = random.Random(3)
    words = [f"w{i}é" for i in range(300)]
    docs = []
    for i in range(60):
        base = [rng.choice(words) for _ in range(rng.choice([1, 2, 3, 40, 400]))]
        docs.append((len(docs), " ".join(base)))
        for _ in range(rng.randrange(4)):
            near = list(base)
            near[rng.randrange(len(near))] = rng.choice(words)
            docs.append((len(docs), ("\n " if rng.random() < 0.5 else " ").join(near).upper()))
    docs += [(1000, ""), (1001, None), (1002, " \t\n"), (5, docs[5][1]), (None, docs[7][1]), (None, "alone without an id")]
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "'x' AS fp", "1 AS component_id")
    assert rows(simhash.simhash_groups(df)) == sorted(plain_groups(docs), key=repr)


def test_one_of_each_group_keeps_columns_and_rows(spark):
    docs = [(3, "a b c d", "x"), (4, "a b c d", "y"), (4, "a b c d", "y"), (9, None, None), (9, None, None), (None, "", "z"), (2, "other words are here", "q")]
    df = spark.createDataFrame(docs, "doc_id long, text string, fp string")
    kept = simhash.one_of_each_group(df)
    assert kept.columns == df.columns
    assert rows(kept) == rows(spark.createDataFrame([docs[0], docs[3], docs[5], docs[6]], df.schema))


def plain_similar(docs, similarity=0.8, shingle=5, distance=simhash.WIDE):
    """Ids that stay, by comparing every pair of the groups' first documents."""
    groups = {}
    for (doc_id, text), (_, fp, component) in zip(docs, plain_groups(docs)):
        if doc_id == component:
            groups[doc_id] = (int(fp, 16), text)
    sets = {}
    for doc_id, (_, text) in groups.items():
        words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
        sets[doc_id] = {tuple(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))} if words else set()
    root = {d: d for d in groups}
    for a in groups:
        for b in groups:
            if a < b and (groups[a][0] ^ groups[b][0]).bit_count() <= distance:
                both = len(sets[a] & sets[b])
                if both and both >= similarity * len(sets[a] | sets[b]) - 1e-9:
                    old, new = max(root[a], root[b]), min(root[a], root[b])
                    root = {d: new if r == old else r for d, r in root.items()}
    return sorted(d for d, r in root.items() if d == r), sets


def similar_corpus(count=80):
    rng = random.Random(8)
    words = [f"w{i}" for i in range(500)]
    docs = []
    for _ in range(count):
        base = [rng.choice(words) for _ in range(rng.choice([3, 60, 100, 200]))]
        docs.append((len(docs), " ".join(base)))
        for _ in range(rng.randrange(3)):
            near = list(base)
            for _ in range(1 + len(near) // 60):
                near[rng.randrange(len(near))] = rng.choice(words).upper()
            docs.append((len(docs), " ".join(near)))
    return docs


def test_no_pair_within_the_wide_distance_is_missed():
    rng = np.random.default_rng(5)
    values = rng.integers(0, 1 << 63, 3000).astype(np.uint64)
    other = values.copy()
    for i in range(len(other)):
        for bit in rng.choice(64, simhash.WIDE, replace=False):
            other[i] ^= np.uint64(1 << int(bit))
    met = np.zeros(len(values), dtype=bool)
    for shift, bits in simhash.RANGES:
        near = {(i, a): c for i, a, c in zip(*(x.tolist() for x in simhash.meeting(values, shift, bits)))}
        for i, a, c in zip(*(x.tolist() for x in simhash.meeting(other, shift, bits))):
            met[i] |= (i, a) in near and (c or near[i, a])
    assert met.all()


def test_close_pairs_equal_brute_force(spark):
    rng = np.random.default_rng(6)
    values = rng.integers(0, 1 << 62, 200).tolist()
    values += [v ^ int(sum(1 << int(b) for b in rng.choice(62, n, replace=False))) for v, n in zip(values, list(range(1, 16)) * 10)]
    found = rows(simhash.close_pairs(spark.createDataFrame([(v,) for v in values], "fp long").distinct()))
    distinct = sorted(set(values))
    assert found == sorted(((a, b) for a in distinct for b in distinct if a < b and (a ^ b).bit_count() <= 11), key=repr)


def test_similar_texts_equal_brute_force(spark):
    docs = similar_corpus()
    odd = [(900, ""), (901, None), (902, "one two"), (903, "one  TWO"), (904, docs[0][1])]
    df = spark.createDataFrame(docs + odd, "doc_id long, text string").selectExpr("*", "1 AS fp", "'x' AS _set", "2 AS a")
    kept = simhash.one_of_each_group(df, similarity=0.8)
    expected, sets = plain_similar(docs + odd)
    assert sorted(r.doc_id for r in kept.collect()) == expected and kept.columns == df.columns
    # More goes than without the second comparison, and of the pairs as similar as that nine in ten at least are found.
    assert len(expected) < simhash.one_of_each_group(df).count()
    ids = sorted(sets)
    pairs = [(a, b) for a in ids for b in ids if a < b and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]) > 0]
    left = [(a, b) for a, b in pairs if a in expected and b in expected]
    assert len(pairs) >= 20 and len(left) <= len(pairs) / 10
    nulls = spark.createDataFrame([(None, docs[0][1]), (None, docs[0][1]), (0, docs[0][1]), (0, docs[0][1])], "doc_id long, text string")
    assert simhash.one_of_each_group(nulls, similarity=0.8).count() == 3
    assert simhash.one_of_each_group(df.limit(0), similarity=0.8).collect() == []


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.simhash_groups(df).collect() == [] and simhash.one_of_each_group(df).collect() == []


def test_long_chain_is_one_group(spark):
    from tidemark.llm.common import components

    links = spark.createDataFrame([(i, i + 1) for i in range(0, 300)] + [(500, 501), (501, 501)], "a long, b long")
    found = dict(rows(components(links)))
    assert {found[i] for i in range(301)} == {0} and found[500] == found[501] == 500


def dense_group(count, changed, seed=9):
    """Texts that differ from one another in ``changed`` of 120 words, and their fingerprints by hand within 11 bits."""
    rng = random.Random(seed)
    base = [f"w{i}" for i in range(120)]
    texts, fps = [], set()
    for i in range(count):
        words = list(base)
        for k in rng.sample(range(120), changed):
            words[k] = f"x{i}n{k}"
        texts.append(" ".join(words))
        while len(fps) == i:
            fps.add(sum(1 << b for b in rng.sample(range(62), rng.randrange(6))))
    return [(i, text, fp) for i, (text, fp) in enumerate(zip(texts, sorted(fps)))]


def plain_links(members, similarity=0.8):
    sets = [{tuple(t.split()[i : i + 5]) for i in range(len(t.split()) - 4)} for _, t, _ in members]
    label = {fp: fp for *_, fp in members}
    for i, (_, _, a) in enumerate(members):
        for j, (_, _, b) in enumerate(members[:i]):
            if (a ^ b).bit_count() <= 11 and len(sets[i] & sets[j]) >= similarity * len(sets[i] | sets[j]) - 1e-9:
                old, new = max(label[a], label[b]), min(label[a], label[b])
                label = {k: new if v == old else v for k, v in label.items()}
    return label


def test_a_dense_group_does_not_send_all_its_pairs(spark, monkeypatch):
    from pyspark.sql import functions as F
    from tidemark.llm.common import components

    written, plain_stage = {}, simhash.stage

    def counting(df, label):
        out = plain_stage(df, label)
        written[label] = max(written.get(label, 0), out.count())
        return out

    monkeypatch.setattr(simhash, "stage", counting)
    # One word changed: most pairs are similar. Four: the bound tells that none is. A mix of both in one group.
    for members in (dense_group(150, 1), dense_group(150, 4), dense_group(90, 1) + [
        (i + 500, t, fp | 1 << 62) for i, t, fp in dense_group(60, 3, seed=2)
    ]):
        written.clear()
        docs = spark.createDataFrame([m[:2] for m in members], "doc_id long, text string")
        firsts = spark.createDataFrame([(m[0], m[2]) for m in members], "doc_id long, fp long").join(docs, "doc_id")
        firsts = firsts.select("doc_id", F.xxhash64("text").alias("first_hash"), "fp")
        links = simhash.similar_links(docs, firsts, 0.8, 5, 11)
        found = {m[2]: m[2] for m in members} | dict(rows(components(links)))
        assert found == plain_links(members)
        # All pairs are within 11 bits (150 * 149 / 2 of them).
        assert written["named"] <= 2 * written["met"] and written["checked"] < 4 * len(members)


def test_pairs_below_the_similarity_are_all_verified_where_the_bound_can_not_tell(spark, monkeypatch):
    from pyspark.sql import functions as F
    from tidemark.llm.common import components

    members = dense_group(40, 1) + [(i + 100, t, fp | 1 << 62) for i, t, fp in dense_group(30, 2, seed=4)]
    monkeypatch.setattr(simhash, "_highest", lambda left, right, m, n: np.minimum(m, n))
    docs = spark.createDataFrame([m[:2] for m in members], "doc_id long, text string")
    firsts = spark.createDataFrame([(m[0], m[2]) for m in members], "doc_id long, fp long").join(docs, "doc_id")
    firsts = firsts.select("doc_id", F.xxhash64("text").alias("first_hash"), "fp")
    for similarity in (0.8, 0.9):
        links = simhash.similar_links(docs, firsts, similarity, 5, 11)
        assert {m[2]: m[2] for m in members} | dict(rows(components(links))) == plain_links(members, similarity)


def test_bounds_hold():
    rng = np.random.default_rng(4)
    for size in (3, 40, 400, 4000, 100_000):
        pool = rng.integers(-(1 << 62), 1 << 62, size * 2)
        sets = [set(rng.choice(pool, rng.integers(1, size + 1), replace=False).tolist()) for _ in range(8)]
        (batch,) = simhash._bucket_counts([pa.RecordBatch.from_arrays([pa.array(range(8)), pa.array([list(s) for s in sets], pa.list_(pa.int64()))], ["fp", "_set"])])
        counts = np.frombuffer(b"".join(batch.column("counts").to_pylist()), dtype=np.uint8).reshape(8, -1)
        n = batch.column("size").to_numpy().astype(np.int64)
        for i in range(8):
            for j in range(8):
                (most,) = simhash._highest(counts[[i]], counts[[j]], n[[i]], n[[j]])
                assert len(sets[i] & sets[j]) <= most <= min(len(sets[i]), len(sets[j]))
