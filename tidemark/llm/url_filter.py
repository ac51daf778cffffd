"""URL filter: rules by host and path, and verdicts that spread over the links between hosts.

Hosts with allowed pages are seeds of trust, hosts with blocked pages seeds of distrust. Trust
runs along the host links, distrust against them (who links to blocked hosts is suspect), both
as personalised PageRank. A url without a rule of its own is blocked if its host's distrust
exceeds its trust by more than the threshold times the share of its pages without a rule.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.session import stage

DAMPING = 0.85
ROUNDS = 16
#: Rounds of propagation between two written tables.
STEP = 4
#: Distrust that a host with no trust at all is let off, if all its pages are without a rule.
THRESHOLD = 0.25
# Links in markup that name a host, with a scheme or without one; the group is the host.
LINK = r"""[Hh][Rr][Ee][Ff]\s*=\s*["']?(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#"'\s<>]+)"""


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(rest, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _split(rule: str) -> tuple[str, str]:
    host, slash, path = rule.partition("/")
    return host, slash + path


def rule_columns(rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest rule (verdict, ``host/path``) that fits ``host`` and ``path``, and its verdict.

    Ties go to the rule listed first. The list is part of the plan, so it stays short; it is
    meant for a policy, not for a table of hosts.
    """
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, text in sorted(reversed(rules), key=lambda r: len(r[1])):
        host, path = _split(text)
        fits = ((F.col("host") == host) | F.endswith("host", F.lit(f".{host}"))) & F.startswith("path", F.lit(path))
        rule = F.when(fits, text).otherwise(rule)
        verdict = F.when(fits, what).otherwise(verdict)
    return rule, verdict


def host_links(pages: DataFrame) -> DataFrame:
    """``source``, ``target`` and ``weight`` between hosts.

    Links of the pages that name a host, by number; every page also links to its own host, as its
    relative links do. Besides, a host and its parent domain link to each other once for every page below them, up to
    the domain of two labels and whether or not the domain has pages of its own: hosts of one
    domain meet there.
    """
    named = F.coalesce(F.regexp_extract_all("html", F.lit(LINK), F.lit(1)), F.array())
    found = pages.select(F.col("host").alias("source"), F.explode(F.array_append(named, F.col("host"))).alias("target"))
    found = found.select("source", F.lower("target").alias("target"), F.lit(1.0).alias("weight"))
    labels = F.split("host", r"\.")
    up = F.transform(
        F.sequence(F.lit(1), F.greatest(F.size("labels") - 2, F.lit(1))),
        lambda i: F.struct(
            F.array_join(F.slice("labels", i, F.size("labels")), ".").alias("low"),
            F.array_join(F.slice("labels", i + 1, F.size("labels")), ".").alias("high"),
        ),
    )
    below = pages.groupBy("host").agg(F.count("*").cast("double").alias("weight")).withColumn("labels", labels)
    steps = below.where((F.size("labels") > 2) & ~F.array_contains("labels", "")).select(F.explode(up).alias("k"), "weight")
    kin = steps.select(
        F.explode(F.array(F.struct("k.low", "k.high"), F.struct(F.col("k.high").alias("low"), F.col("k.low").alias("high")))).alias("k"), "weight"
    ).select("k.low", "k.high", "weight")
    every = found.union(kin).where("source <> '' AND target <> ''")
    return every.groupBy("source", "target").agg(F.sum("weight").alias("weight"))


def propagated(links: DataFrame, seeds: DataFrame, damping: float = DAMPING, rounds: int = ROUNDS) -> DataFrame:
    """``host``, ``trust`` and ``distrust`` after ``rounds`` of personalised PageRank.

    ``seeds`` have a row per host. Trust of a host is shared over its outgoing links by weight,
    distrust over its incoming ones. Partial sums combine before the shuffle, so a host with very
    many links takes a row from each task. Every few rounds are written to the shared folder.
    """
    out = links.groupBy("source").agg(F.sum("weight").alias("_out"))
    into = links.groupBy("target").agg(F.sum("weight").alias("_in"))
    shares = links.join(out, "source").join(into, "target").select(
        "source", "target", (F.col("weight") / F.col("_out")).alias("forth"), (F.col("weight") / F.col("_in")).alias("back")
    )
    moves = stage(
        shares.select(F.col("source").alias("host"), F.col("target").alias("to"), F.col("forth").alias("t"), F.lit(0.0).alias("d"))
        .union(shares.select("target", "source", F.lit(0.0), "back")),
        "moves",
    )
    seeds = stage(seeds.select("host", "seed_trust", "seed_distrust"), "seeds")
    ranks = seeds.select("host", F.col("seed_trust").alias("trust"), F.col("seed_distrust").alias("distrust"))
    for number in range(1, rounds + 1):
        sent = moves.join(ranks, "host").groupBy(F.col("to").alias("host")).agg(
            F.sum(F.col("t") * F.col("trust")).alias("t"), F.sum(F.col("d") * F.col("distrust")).alias("d")
        )
        ranks = seeds.join(sent, "host", "left").select(
            "host",
            ((1 - damping) * F.col("seed_trust") + damping * F.coalesce("t", F.lit(0.0))).alias("trust"),
            ((1 - damping) * F.col("seed_distrust") + damping * F.coalesce("d", F.lit(0.0))).alias("distrust"),
        )
        if number % STEP == 0 or number == rounds:
            ranks = stage(ranks, "ranks")
    return ranks


def url_verdicts(
    pages: DataFrame, rules: Sequence[tuple[str, str]], threshold: float = THRESHOLD, rounds: int = ROUNDS
) -> DataFrame:
    """``page_id``, ``host``, ``path``, ``rule`` and ``verdict`` of every page, with its host's
    ``trust`` and ``distrust`` to six decimals.

    Seeds are the shares of a host's pages that rules allow or block. Null urls and urls without
    ``://`` have an empty host and path, no rule, and are allowed. Null markup has no links;
    repeated rows and null ids stay rows; an empty table gives an empty result; other columns are
    ignored.
    """
    parsed = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), "html")
    rule, verdict = rule_columns(rules)
    judged = parsed.select("page_id", "host", "path", "html", rule.alias("rule"), verdict.alias("given"))
    own = judged.where("host <> ''").groupBy("host").agg(
        F.avg(F.when(F.col("given") == "allow", 1.0).otherwise(0.0)).alias("seed_trust"),
        F.avg(F.when(F.col("given") == "block", 1.0).otherwise(0.0)).alias("seed_distrust"),
    )
    own = stage(own, "hosts")
    links = stage(host_links(parsed.select("host", "html")), "host-links")
    linked = links.select(F.col("target").alias("host")).distinct().join(own, "host", "left_anti")
    seeds = own.union(linked.select("host", F.lit(0.0), F.lit(0.0)))
    ranks = propagated(links, seeds, rounds=rounds)
    let_off = (1 - F.col("seed_trust") - F.col("seed_distrust")) * threshold
    spread = F.when(F.col("distrust") - F.col("trust") > let_off, "block").otherwise("allow")
    ranked = own.join(ranks, "host")
    return judged.drop("html").join(ranked, "host", "left").select(
        "page_id", "host", "path", "rule", F.coalesce("given", spread).alias("verdict"),
        F.round("trust", 6).alias("trust"), F.round("distrust", 6).alias("distrust"),
    )
