import hashlib
import random
import re
import zlib

import pytest

from conftest import rows
from tidemark.llm import prefix_trie as pt

SCHEMA = "conv_id long, turn long, role string, text string"


def words(text):
    return len([w for w in re.split(r"[\x20\x09-\x0D]+", text) if w])


def plain_rebuilt(data):
    own = {}
    for c, turn, role, text in data:
        if c is not None:
            role, text = role or "", text or ""
            name = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            own.setdefault(c, []).append((turn is not None, turn or 0, name, (role, text)))
    own = {c: [t[3] for t in sorted(turns)] for c, turns in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = own.get(c - c % 20, [])[:h] + turns[h:]
    return out


def plain_trie(convs):
    members = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    out = []
    for node, inside in members.items():
        below = [x for x in members if x[: len(node)] == node]
        ends = ",".join(map(str, sorted(c for c in inside if len(convs[c]) == len(node))))
        out.append(
            (
                min(inside), len(node), min(members[node[:-1]]) if node else None, len(inside),
                sum(len(x) == len(node) + 1 for x in below),
                sum(not any(len(y) == len(x) + 1 and y[: len(x)] == x for y in below) for x in below),
                sum((len(members[x]) - 1) * words(x[-1][1]) for x in below if x),
                hashlib.sha256(ends.encode()).hexdigest(),
            )
        )
    return sorted(out, key=repr)


def talks(n, seed=1, turns=6, texts=5):
    rng = random.Random(seed)
    data = []
    for c in range(n):
        for turn in range(rng.randrange(1, turns)):
            data.append((c, turn, rng.choice(["user", "assistant", None]), rng.choice([None, "", "a b", "aé  b\tc\n", "long " * 9][:texts])))
    return data


def odd():
    return [
        (7, None, "user", "null turn first"), (7, 0, "user", "a b"), (7, 0, "user", "a b"), (7, 0, "bot", "tie"),
        (None, 1, "user", "no conversation"), (45, 1, "user", "donor absent"), (1005, 3, None, None),
        (20, 1, "userx", "y"), (21, 1, "user", "xy"), (80, 5, "a", "b"), (10**12, 0, "user", "far"),
    ]


def test_trie_equals_brute_force(spark):
    data = talks(150) + odd()
    df = spark.createDataFrame(data, SCHEMA).selectExpr("*", "'x' AS depth", "1 AS key", "2 AS words", "3 AS kid")
    assert rows(pt.prefix_trie(pt.rebuilt(df))) == plain_trie(plain_rebuilt(data))


def test_ranges_of_any_size_merge_to_the_same_forest(spark, monkeypatch):
    data = talks(90, seed=2, texts=3) + [(200 + i, t, "user", f"deep {min(t, i + 20)}") for i in range(6) for t in range(40)]
    expected = plain_trie(plain_rebuilt(data))
    df = spark.createDataFrame(data, SCHEMA).repartition(7)
    monkeypatch.setattr(pt, "FAN", 3)
    monkeypatch.setattr(pt, "ENDS", 2)
    for parts in (1, 3, 29):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        try:
            assert rows(pt.prefix_trie(pt.rebuilt(df))) == expected
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", 8)


def test_copies_are_one_sequence_with_all_ends(spark):
    data = [(c, t, "user", f"turn {t}") for c in range(0, 4000, 20) for t in range(3)] + [(4000, 0, "user", "other")]
    found = {r.depth: r for r in pt.prefix_trie(pt.rebuilt(spark.createDataFrame(data, SCHEMA))).where("n_convs > 1").collect()}
    ids = ",".join(str(c) for c in range(0, 4000, 20))
    assert found[3].ends_sha256 == hashlib.sha256(ids.encode()).hexdigest() and found[0].n_convs == 201


def test_empty_table_and_turnless_conversations(spark):
    assert pt.prefix_trie(pt.rebuilt(spark.createDataFrame([], SCHEMA))).collect() == []
    lonely = next(c for c in range(21, 40) if zlib.crc32(str(c).encode()) % 4 >= 1)
    (root,) = pt.prefix_trie(pt.rebuilt(spark.createDataFrame([(lonely, 0, "user", "gone")], SCHEMA))).collect()
    assert (root.conv_id, root.depth, root.n_convs, root.n_children, root.n_leaves) == (lonely, 0, 1, 0, 1)
    assert root.ends_sha256 == hashlib.sha256(str(lonely).encode()).hexdigest()


@pytest.mark.parametrize("n", [0, 3])
def test_negative_ids_do_not_crash(spark, n):
    data = [(-21, t, "user", "x") for t in range(n)] + [(-40, 0, "user", "y")]
    assert pt.prefix_trie(pt.rebuilt(spark.createDataFrame(data, SCHEMA))).count() >= 1
