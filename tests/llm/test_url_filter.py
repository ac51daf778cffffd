import re
from collections import Counter, defaultdict

from conftest import rows
from tidemark.llm import url_filter as uf

RULES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/")]
SCHEMA = "page_id long, url string, html string"


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.split(r"[/?#]", rest, maxsplit=1)[0]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), re.split(r"[?#]", rest[len(host) :], maxsplit=1)[0]


def plain_rule(host, path):
    best = None
    for verdict, rule in RULES:
        h, _, p = rule.partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p) and (best is None or len(rule) > len(best[1])):
            best = verdict, rule
    return best or (None, None)


def plain_verdicts(pages):
    judged = [(i, *parts(url), html or "") for i, url, html in pages]
    hosts = defaultdict(list)
    for _, host, path, _ in judged:
        if host:
            hosts[host].append(plain_rule(host, path)[0])
    links = Counter()
    for _, host, _, html in judged:
        if host:
            links[host, host] += 1
            for m in re.finditer(r"""href\s*=\s*["']?(?:[a-z][a-z0-9+.-]*:)?//([^/?#"'\s<>]+)""", html, re.I):
                links[host, m[1].lower()] += 1
    for host, pages_ in hosts.items():
        labels = host.split(".")
        for i in range(len(labels) - 2 if all(labels) else 0):
            low, high = ".".join(labels[i:]), ".".join(labels[i + 1 :])
            links[low, high] += len(pages_)
            links[high, low] += len(pages_)
    out, into = Counter(), Counter()
    for (a, b), n in links.items():
        out[a] += n
        into[b] += n
    nodes = set(hosts) | {b for _, b in links}
    share = lambda v, h: hosts[h].count(v) / len(hosts[h]) if h in hosts else 0.0
    seed = {"allow": {h: share("allow", h) for h in nodes}, "block": {h: share("block", h) for h in nodes}}
    t, d = dict(seed["allow"]), dict(seed["block"])
    for _ in range(uf.ROUNDS):
        nt, nd = {h: 0.15 * s for h, s in seed["allow"].items()}, {h: 0.15 * s for h, s in seed["block"].items()}
        for (a, b), n in links.items():
            nt[b] += 0.85 * t[a] * n / out[a]
            nd[a] += 0.85 * d[b] * n / into[b]
        t, d = nt, nd
    result = []
    for i, host, path, _ in judged:
        given, rule = plain_rule(host, path)
        result.append((i, host, path, rule, given or ("block" if d.get(host, 0) - t.get(host, 0) > share(None, host) * uf.THRESHOLD else "allow")))
    return result


def pages():
    good = [(i, f"https://good{i % 4}.org/{i}", f'<a href="http://www.Example.com/en/x">a</a> <A HREF = \'https://friend.org?q\'>') for i in range(12)]
    bad = [(100 + i, f"http://bad.net/es/{i}", '<a href="http://bad.net/x">') for i in range(9)] + [(120, "http://bad.net/de/1", "")]
    spam = [(200 + i, f"ftp://SPAM{i % 2}.org/en", '<a href=http://bad.net/es/1>x</a>' * 20) for i in range(8)]
    odd = [(300, None, None), (301, "no scheme", "<a href='http://bad.net'>"), (302, "http://", ""), (303, "a://b://c/d#e?f", None), (304, "http://x.example.com", ""),
           (305, "http://example.com/en/1?u=http://z", ""), (306, "http://www.example.com/en/", None), (307, "http://m.bad.net/fr/", ""),
           (308, "http://com/", ""), (309, "http://notexample.com/en/\n2", ""), (0, good[0][1], good[0][2]), (None, "http://friend.org#x", None)]
    return good + bad + spam + odd


def test_verdicts_equal_brute_force(spark):
    data = pages()
    df = spark.createDataFrame(data, SCHEMA).selectExpr("*", "'x' AS host", "1 AS rule", "2 AS trust")
    found = uf.url_verdicts(df, RULES)
    expected = plain_verdicts(data)
    assert rows(found.drop("trust", "distrust")) == sorted(expected, key=repr)
    verdict = {row[0]: row[4] for row in expected}
    assert verdict[120] == "block" and verdict[200] == "block" and verdict[1] == "allow"


def test_hosts_of_one_domain_meet_and_pages_without_markup_count(spark):
    # No link leaves its host; the first one's pages are blocked, its sibling has no rule for most.
    data = [(i, f"http://a.spam.net/es/{i}", None if i % 2 else '<a href="/x">') for i in range(40)]
    data += [(100 + i, f"http://b.spam.net/de/{i}", None) for i in range(4)] + [(200, "http://c.other.net/de/1", '<a href="//a.spam.net/es/1">')]
    data += [(300, "http://d.third.net/de/1", None)]
    found = {r.page_id: r for r in uf.url_verdicts(spark.createDataFrame(data, SCHEMA), RULES).collect()}
    assert rows(spark.createDataFrame([tuple(r)[:5] for r in found.values()], "page_id long, host string, path string, rule string, verdict string")) == sorted(plain_verdicts(data), key=repr)
    # Distrust reaches the sibling through a domain without pages, and a host by its link without a scheme.
    assert found[100].distrust > 0 and found[200].distrust > 0 and found[300].distrust == 0


def test_empty_table(spark):
    assert uf.url_verdicts(spark.createDataFrame([], SCHEMA), RULES).collect() == []
