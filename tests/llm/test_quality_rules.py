import random
from collections import Counter, defaultdict

from conftest import rows
from tidemark.llm import quality_rules as q

BLANKS = " \t\n\x0b\f\r"


def split(text):
    for blank in BLANKS:
        text = text.replace(blank, " ")
    return [w for w in text.split(" ") if w]


def plain_rules(docs, max_docs=q.MAX_DOCS, per_mille=q.MAX_PER_MILLE):
    """Rows of ``quality_rules``, counted one by one; ``docs`` are (doc_id, text, host)."""
    out, stands, first = [], Counter(), {}
    hosts = Counter(host for *_, host in docs)
    lines_of = []
    for doc_id, text, host in docs:
        lines = [line for line in (text or "").split("\n") if split(line)]
        normal = defaultdict(int)
        for line in lines:
            normal[" ".join(split(line)).lower()] += len("".join(split(line)))
        lines_of.append((lines, normal))
        for line in normal:
            stands[host, line] += 1
            if doc_id is not None:
                first[host, line] = min(first.get((host, line), doc_id), doc_id)
    for (doc_id, text, host), (lines, normal) in zip(docs, lines_of):
        words = split(text or "")
        windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
        counts = Counter(windows)
        covered = {p for i, w in enumerate(windows) if counts[w] > 1 for p in range(i, i + 5)}
        chars = sum(map(len, words))
        failed = len(words) < 10 or 100 * len(covered) > 20 * len(words)
        gone = sum(
            n for line, n in normal.items()
            if stands[host, line] > max_docs and stands[host, line] * 1000 > hosts[host] * per_mille
            and first.get((host, line)) != doc_id
        )
        out.append((
            doc_id, len(words), chars, sum((text or "").count(c) for c in q.SYMBOLS), len(lines) - len(set(lines)),
            len(covered), failed, not failed and gone * 100 <= chars * q.MAX_REMOVED_PERCENT, gone,
        ))
    return out


def corpus():
    rng = random.Random(7)
    words = [f"w{i}é" for i in range(50)] + ["#x", "a&b", "|"]
    line = lambda: rng.choice([" ", "\t"]).join(rng.choice(words) for _ in range(rng.randrange(12)))
    shared = [line() for _ in range(3)] + ["Common  LINE of the host that every page has", "common line of the host that every page has"]
    docs = [(i, "\n".join([*[line() for _ in range(rng.randrange(5))], *rng.sample(shared, rng.randrange(3))]), rng.choice("ab")) for i in range(120)]
    copies = [(200 + i, "one text of ten words that is copied over and over\nagain with lines", "a") for i in range(30)]
    odd = [(300, None, "a"), (301, "", None), (302, "\n \n\t", None), (303, " ".join(["same words here now yes"] * 5), "b"),
           (5, docs[5][1], docs[5][2]), (None, copies[0][1], "a"), (304, "w " * 6000, None), (305, " ".join(map(str, range(6000))), None)]
    return docs + copies + odd


def test_counts_and_verdicts_equal_plain_ones(spark):
    docs = corpus()
    df = spark.createDataFrame(docs, "doc_id long, text string, source string").selectExpr("*", "1 AS host", "2 AS line", "3 AS _row")
    assert rows(q.quality_rules(df, max_docs=10)) == sorted(plain_rules(docs, max_docs=10), key=repr)
    assert rows(q.quality_rules(df)) == sorted(plain_rules(docs), key=repr)


def test_of_many_copies_the_first_is_kept(spark):
    docs = corpus()
    df = spark.createDataFrame(docs, "doc_id long, text string, source string").selectExpr("*", "7 AS host")
    kept = q.passing(df)
    assert kept.columns == df.columns
    ids = [r.doc_id for r in kept.collect() if r.doc_id and 200 <= r.doc_id < 230]
    assert ids == [200]
    wanted = [(d, *rest) for (d, *rest), judged in zip(docs, plain_rules(docs)) if judged[7]]
    assert rows(kept.drop("host")) == sorted(map(tuple, wanted), key=repr)


def test_frequent_lines_leave_the_texts(spark):
    menu = "  Home |\tAbout  us "
    own = lambda i: f"this is the story number {i} of a page that has words of its own"
    docs = [(i, f"{menu}\n{own(i)}\n\n \t\nend of {i}\nHOME | about US", "a", None) for i in range(30)]
    docs += [(100, f"{own(100)}\n{menu}", "b", 7), (None, f"{menu}\n{own(5)}\n{own(6)}", "a", 1), (5, docs[5][1], "a", None), (101, "home", "a", 2)]
    docs += [(102, "\n".join([menu] * 9 + ["one two three four"]), "a", 3), (103, f"\n{own(103)}\n", None, 4)]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string, cut int")
    found = q.cleaned(df)
    assert found.columns == df.columns
    judged = plain_rules([(d, t, h) for d, t, h, _ in docs])
    cut = lambda t: "\n".join(line for line in t.split("\n") if " ".join(split(line)).lower() != "home | about us")
    wanted = [(d, cut(t) if j[8] else t, h, c) for (d, t, h, c), j in zip(docs, judged) if j[7]]
    assert rows(found) == sorted(wanted, key=repr)
    texts = {r.doc_id: r.text for r in found.collect()}
    assert texts[0] == docs[0][1] and texts[1] == f"{own(1)}\n\n \t\nend of 1" and texts[100] == docs[30][1]
    assert not {101, 102} & set(texts)
    gone = {j[0]: j[2] - j[8] for j in judged}
    assert all(len("".join(split(t))) == gone[d] for d, t in texts.items() if d not in (5, None))


def test_lines_of_any_shape_are_cut_by_their_place(spark):
    docs = corpus()
    df = spark.createDataFrame(docs, "doc_id long, text string, source string")
    left = {d: j for d, *j in plain_rules(docs, max_docs=10) if j[6]}
    for row in q.cleaned(df, max_docs=10).collect():
        assert sum(map(len, split(row.text))) == left[row.doc_id][1] - left[row.doc_id][7]


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string, source string")
    assert q.quality_rules(df).collect() == [] and q.passing(df).collect() == []
