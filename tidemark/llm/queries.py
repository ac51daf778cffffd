"""The operators over the given tables, one query each, with SQL for DuckDB where SQL can say it."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm.common import crc_remainder
from tidemark.llm import (
    bpe, embedding_dedup, impact_search, importance, katz, mixing, prefix_trie, quality_classifier, quality_rules, secret_scan,
    simhash, suffix_dedup, url_filter,
)



def tokenizer_path(name: str) -> str:
    """File of a public tokenizer, in the folder TOKENIZER_DIR names or in the installed package."""
    import public_tokenizers

    folder = os.environ.get("TOKENIZER_DIR")
    return f"{folder}/{name}" if folder else str(public_tokenizers.path(name))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _query(run: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[run.__name__] = run
    return run


# White space and words of a text, for DuckDB.
_SQL_WORDS = r"list_filter(string_split_regex(text, '[\x20\x09-\x0D]+'), lambda w: w <> '')"


@_query
def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality counts of every document, and whether it is kept."""
    return quality_rules.quality_rules(_table(spark, sf_dir, "documents"))


ORACLES["op5_quality_rules"] = rf"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS text FROM documents),
w AS (
  SELECT doc_id, source, text, {_SQL_WORDS} AS words,
         list_filter(string_split(text, chr(10)), lambda l: translate(l, chr(32)||chr(9)||chr(10)||chr(11)||chr(12)||chr(13), '') <> '') AS lines
  FROM d
),
windows AS (
  SELECT doc_id, i, array_to_string(words[i:i+4], ' ') AS gram
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 3)) AS i FROM w)
),
twice AS (SELECT doc_id, gram FROM windows GROUP BY doc_id, gram HAVING count(*) > 1),
covered AS (
  SELECT doc_id, count(DISTINCT p) AS n
  FROM (SELECT doc_id, unnest(range(i, i + 5)) AS p FROM windows JOIN twice USING (doc_id, gram))
  GROUP BY doc_id
),
base AS (
  SELECT doc_id, source, lines, CAST(len(words) AS BIGINT) AS n_words,
         CAST(coalesce(list_sum(list_transform(words, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
         CAST(length(text) - length(translate(text, '{quality_rules.SYMBOLS}', '')) AS BIGINT) AS n_symbols,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words
  FROM w LEFT JOIN covered USING (doc_id)
),
judged AS (
  SELECT *, n_words < {quality_rules.MIN_WORDS}
         OR 100 * n_repeat_words > {quality_rules.MAX_REPEAT_PERCENT} * n_words AS base_failed
  FROM base
),
lines AS (
  SELECT doc_id, source, lower(trim(regexp_replace(line, '[\x20\x09-\x0D]+', ' ', 'g'))) AS line,
         sum(length(regexp_replace(line, '[\x20\x09-\x0D]+', '', 'g'))) AS chars
  FROM (SELECT doc_id, source, unnest(lines) AS line FROM base) GROUP BY ALL
),
hosts AS (SELECT source, count(*) AS n_host FROM d GROUP BY source),
many AS (
  SELECT l.source, l.line, l.first FROM
    (SELECT source, line, count(*) AS n_docs, min(doc_id) AS first FROM lines GROUP BY source, line) l
    JOIN hosts h ON l.source IS NOT DISTINCT FROM h.source
  WHERE n_docs > {quality_rules.MAX_DOCS} AND n_docs * 1000 > n_host * {quality_rules.MAX_PER_MILLE}
),
removed AS (
  SELECT l.doc_id, sum(chars) AS n FROM lines l
  JOIN many m ON l.source IS NOT DISTINCT FROM m.source AND l.line = m.line AND l.doc_id <> m.first
  GROUP BY l.doc_id
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND coalesce(n, 0) * 100 <= word_chars * {quality_rules.MAX_REMOVED_PERCENT} AS kept,
       CAST(coalesce(n, 0) AS BIGINT) AS n_removed_chars
FROM judged LEFT JOIN removed USING (doc_id)
"""


@_query
def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate group of every document."""
    return simhash.simhash_groups(_table(spark, sf_dir, "documents"))


@_query
def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document: counts and spans."""
    return secret_scan.secret_digest(secret_scan.secret_spans(_table(spark, sf_dir, "documents")))


def _secret_sql() -> str:
    def quoted(kind: str) -> str:
        return secret_scan.PATTERNS[kind].replace("'", "''")

    found = " UNION ALL ".join(
        f"SELECT doc_id, {k} AS kind, string_split_regex(text, '{quoted(kind)}') AS pieces, "
        f"regexp_extract_all(text, '{quoted(kind)}') AS tokens FROM d"
        for k, kind in enumerate(secret_scan.KINDS)
    )
    bins = "CASE encoding " + " ".join(
        f"WHEN '{name}' THEN {k}" for name, (_, _, k) in secret_scan.ENCODINGS.items()
    ) + " END"
    encoding = secret_scan.encoding_sql().replace("regexp_like_", "regexp_matches")
    columns = {c: c for c in ("n", "k", "squares", "high", "turns", "total", "squared", "product")}
    scores = ", ".join(f"{sql} AS {name}" for name, sql in secret_scan.score_sql(columns).items())
    rate = int(secret_scan.FALSE_DISCOVERIES * 1000)
    names = "CASE kind " + " ".join(f"WHEN {k} THEN '{kind}'" for k, kind in enumerate(secret_scan.KINDS)) + " END"
    return rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
found AS ({found}),
each AS (
  SELECT doc_id, kind, i, tokens[i] AS token, length(pieces[i]) AS before
  FROM (SELECT *, unnest(range(1, len(tokens) + 1)) AS i FROM found)
),
placed AS (
  SELECT *, sum(before + length(token)) OVER (PARTITION BY doc_id, kind ORDER BY i) AS stop FROM each
),
spans AS (
  SELECT doc_id, kind, CAST(stop - length(token) AS INT) AS start, CAST(stop AS INT) AS stop, token
  FROM placed
  WHERE kind <> 0 OR length(regexp_extract(token, '{quoted("assign")}', 2)) >= {secret_scan.MIN_VALUE}
),
named AS (SELECT *, {encoding} AS encoding FROM spans WHERE kind = 3),
binned AS (
  SELECT *, {secret_scan.bins_sql()} AS b, {bins} AS k FROM named WHERE encoding IS NOT NULL
),
digits AS (SELECT *, length(b) AS n, list_transform(string_split(b, ''), lambda c: CAST(c AS BIGINT)) AS x FROM binned),
counted AS (
  SELECT *,
    list_sum(list_transform(range(0, 8), lambda v: power(len(list_filter(x, lambda y: y = v)), 2))) AS squares,
    len(list_filter(x, lambda y: y * 2 >= k)) AS high,
    list_sum(list_transform(range(1, n), lambda i: CASE WHEN (x[i] * 2 >= k) <> (x[i + 1] * 2 >= k) THEN 1 ELSE 0 END)) AS turns,
    list_sum(x) AS total, list_sum(list_transform(x, lambda y: y * y)) AS squared,
    list_sum(list_transform(range(1, n + 1), lambda i: x[i] * x[i % n + 1])) AS product
  FROM digits
),
scored AS (SELECT *, {scores}, CAST(floor(log2(n)) AS INT) AS band FROM counted),
tested AS (SELECT *, {secret_scan.p_sql()} AS p FROM scored),
steps AS (
  SELECT band, p, sum(count(*)) OVER (PARTITION BY band ORDER BY p) AS up_to,
         sum(count(*)) OVER (PARTITION BY band) AS total_n
  FROM tested GROUP BY band, p
),
limits AS (
  SELECT band, coalesce(max(p) FILTER (WHERE p * total_n <= {rate} * up_to), -1) AS p_limit FROM steps GROUP BY band
),
secrets AS (
  SELECT doc_id, kind, start, stop FROM spans WHERE kind < 3
  UNION ALL
  SELECT t.doc_id, 3, t.start, t.stop FROM tested t JOIN limits USING (band)
  WHERE p > p_limit AND NOT EXISTS (
    SELECT 1 FROM spans s WHERE s.doc_id = t.doc_id AND s.kind < 3 AND s.start <= t.start AND s.stop >= t.stop)
),
texts AS (SELECT *, {names} || ':' || start || ':' || stop AS span FROM secrets),
lists AS (
  SELECT doc_id, count(*) FILTER (WHERE kind = 0) AS n_assign, count(*) FILTER (WHERE kind = 1) AS n_access,
         count(*) FILTER (WHERE kind = 2) AS n_hex,
         string_agg(span, ',' ORDER BY start, kind) FILTER (WHERE kind < 3) AS base,
         string_agg(span, ',' ORDER BY start, kind) AS spans
  FROM texts GROUP BY doc_id
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN lists USING (doc_id)
"""


ORACLES["op8_secret_scan"] = _secret_sql()


@_query
def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token count of every document, and digests of its ids and of the text decoded from them."""
    path = tokenizer_path("byte_bpe_50k.json")
    return bpe.token_digest(bpe.decode(bpe.encode(_table(spark, sf_dir, "documents"), path), path))


@_query
def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place of every document in a mix of equal weights for all sources."""
    return mixing.mixture(_table(spark, sf_dir, "documents"))


@_query
def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document, learnt from the labelled ones that are not held out."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = crc_remainder("doc_id", 4) == 2
    labels = _table(spark, sf_dir, "labels").select("doc_id", "quality")
    # Labels grow with the documents: never broadcast them, whatever their size today.
    model = quality_classifier.fit(docs.where(~held_out).join(labels.hint("merge"), "doc_id"))
    scored = quality_classifier.score(docs, model)
    return scored.select(
        "doc_id", held_out.alias("held_out"), "score", F.when(F.col("score") >= 0.7, 1).otherwise(0).alias("predicted")
    )


@_query
def op7_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and near-duplicate group of every vector."""
    return embedding_dedup.embedding_groups(_table(spark, sf_dir, "embeddings"))


ORACLES["op7_embedding_dedup"] = f"""
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
),
links AS MATERIALIZED (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= {embedding_dedup.THRESHOLD}
),
reach AS (
  SELECT vec_id AS node, vec_id AS root FROM embeddings
  UNION SELECT links.b, reach.root FROM reach JOIN links ON links.a = reach.node AND reach.root < links.b
),
least AS (SELECT node AS vec_id, min(root) AS component_id FROM reach GROUP BY node),
n AS (SELECT a AS vec_id, count(*) AS n_links FROM links GROUP BY a)
SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM least LEFT JOIN n USING (vec_id)
"""


URL_RULES = [
    ("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/"),
]


@_query
def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on the url of every page."""
    return url_filter.url_verdicts(_table(spark, sf_dir, "pages"), URL_RULES)


def _url_sql() -> str:
    rule = verdict = "NULL"
    for what, text in sorted(reversed(URL_RULES), key=lambda r: len(r[1])):
        host, _, path = text.partition("/")
        fits = f"(host = '{host}' OR suffix(host, '.{host}')) AND starts_with(path, '/{path}')"
        rule = f"CASE WHEN {fits} THEN '{text}' ELSE {rule} END"
        verdict = f"CASE WHEN {fits} THEN '{what}' ELSE {verdict} END"
    link = url_filter.LINK.replace("'", "''")
    d = url_filter.DAMPING
    rounds = "".join(
        f"""
r{k} AS MATERIALIZED (
  SELECT host, {1 - d} * seed_t + {d} * coalesce(t, 0) AS trust, {1 - d} * seed_d + {d} * coalesce(d, 0) AS distrust
  FROM seeds
  LEFT JOIN (SELECT target AS host, sum(forth * trust) AS t FROM shares JOIN r{k - 1} r ON r.host = source GROUP BY target) USING (host)
  LEFT JOIN (SELECT source AS host, sum(back * distrust) AS d FROM shares JOIN r{k - 1} r ON r.host = target GROUP BY source) USING (host)
),"""
        for k in range(1, url_filter.ROUNDS + 1)
    )
    return rf"""
WITH parsed AS (
  SELECT page_id, html,
    coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages
),
judged AS (SELECT *, {rule} AS rule, {verdict} AS given FROM parsed),
own AS MATERIALIZED (
  SELECT host, avg(CASE WHEN given = 'allow' THEN 1.0 ELSE 0.0 END) AS seed_t, avg(CASE WHEN given = 'block' THEN 1.0 ELSE 0.0 END) AS seed_d
  FROM judged WHERE host <> '' GROUP BY host
),
steps AS (
  SELECT array_to_string(labels[i:], '.') AS low, array_to_string(labels[i + 1:], '.') AS high, n
  FROM (SELECT labels, n, unnest(range(1, len(labels) - 1)) AS i
        FROM (SELECT string_split(host, '.') AS labels, count(*) AS n FROM parsed WHERE host <> '' GROUP BY host)
        WHERE NOT list_contains(labels, ''))
),
every AS (
  SELECT host AS source, host AS target, 1 AS weight FROM parsed WHERE host <> ''
  UNION ALL SELECT host, lower(unnest(regexp_extract_all(html, '{link}', 1))), 1 FROM parsed WHERE host <> ''
  UNION ALL SELECT low, high, n FROM steps
  UNION ALL SELECT high, low, n FROM steps
),
links AS (SELECT source, target, sum(weight) AS weight FROM every GROUP BY source, target),
shares AS MATERIALIZED (
  SELECT source, target, weight / sum(weight) OVER (PARTITION BY source) AS forth, weight / sum(weight) OVER (PARTITION BY target) AS back
  FROM links
),
seeds AS MATERIALIZED (
  SELECT * FROM own UNION ALL SELECT DISTINCT target, 0.0, 0.0 FROM links WHERE target NOT IN (SELECT host FROM own)
),
r0 AS (SELECT host, seed_t AS trust, seed_d AS distrust FROM seeds),{rounds}
done AS (SELECT * FROM r{url_filter.ROUNDS} JOIN own USING (host))
SELECT page_id, host, path, rule,
  coalesce(given, CASE WHEN distrust - trust > (1 - seed_t - seed_d) * {url_filter.THRESHOLD} THEN 'block' ELSE 'allow' END) AS verdict,
  round(trust, 6) AS trust, round(distrust, 6) AS distrust
FROM judged LEFT JOIN done USING (host)
"""


ORACLES["op2_url_filter"] = _url_sql()


@_query
def op3_katz(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language-model score of every document, learnt from those that are not held out."""
    return katz.katz_scores(_table(spark, sf_dir, "documents"), crc_remainder("doc_id", 7) == 2)


@_query
def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without strings that start in a document before it."""
    return suffix_dedup.repeat_digest(suffix_dedup.repeats_removed(_table(spark, sf_dir, "documents")))


# crc32 of a text, for DuckDB: its table, and a fold over the bytes.
_SQL_CRC_TABLE = """
crc AS MATERIALIZED (
  SELECT list(v ORDER BY i) AS steps FROM (
    SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END) AS v
    FROM range(256) r(i)
  )
)"""


def _sql_crc(text: str) -> str:
    code = f"hex(encode({text}))"
    bytes_ = f"list_transform(range(0, CAST(length({code}) // 2 AS BIGINT)), lambda i: CAST('0x' || substr({code}, 2 * i + 1, 2) AS BIGINT))"
    start = "CAST(4294967295 AS BIGINT)"
    fold = f"list_reduce(list_prepend({start}, {bytes_}), lambda c, b: xor(steps[(xor(c, b) & 255) + 1], c >> 8))"
    return f"xor({fold}, {start})"


@_query
def op11_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weight, score and rank of every document in a draw that favours texts like the benchmark's."""
    return importance.resampled(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def _importance_sql() -> str:
    lower = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    words = rf"regexp_extract_all({lower}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    k = importance.BUCKETS
    return rf"""
WITH {_SQL_CRC_TABLE},
d AS (SELECT row_number() OVER () AS r, doc_id, {words} AS w FROM documents),
b AS (SELECT {words} AS w FROM benchmark),
features AS MATERIALIZED (
  SELECT r, unnest(w) AS f FROM d
  UNION ALL SELECT r, w[i] || ' ' || w[i + 1] FROM (SELECT r, w, unnest(range(1, len(w))) AS i FROM d)
  UNION ALL SELECT NULL, unnest(w) FROM b
  UNION ALL SELECT NULL, w[i] || ' ' || w[i + 1] FROM (SELECT w, unnest(range(1, len(w))) AS i FROM b)
),
hashed AS MATERIALIZED (SELECT f, {_sql_crc("f")} % {k} AS bucket FROM (SELECT DISTINCT f FROM features), crc),
placed AS MATERIALIZED (SELECT r, bucket FROM features JOIN hashed USING (f)),
counts AS (SELECT bucket, count(r) AS s, count(*) FILTER (WHERE r IS NULL) AS t FROM placed GROUP BY bucket),
sums AS (SELECT count(r) AS s, count(*) FILTER (WHERE r IS NULL) AS t FROM placed),
gains AS (
  SELECT bucket, CAST(floor(1000 * ln(
    CAST(c.t + 1 AS DOUBLE) * CAST(sums.s + {k} AS DOUBLE) / (CAST(c.s + 1 AS DOUBLE) * CAST(sums.t + {k} AS DOUBLE)))) AS BIGINT) AS gain
  FROM counts c, sums
),
weights AS (SELECT r, count(*) AS n, CAST(floor(sum(gain)::DOUBLE / count(*)) AS BIGINT) AS weight FROM placed JOIN gains USING (bucket) WHERE r IS NOT NULL GROUP BY r),
scored AS (
  SELECT d.r, doc_id, len(w) AS words, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln(
      (CAST('0x' || substr(sha256('{importance.SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296.0::DOUBLE))) AS BIGINT) AS score
  FROM d LEFT JOIN weights USING (r)
),
ranks AS (SELECT r, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST) AS place, count(*) OVER () AS able FROM scored WHERE words >= {importance.MIN_WORDS})
SELECT doc_id, CAST(n_features AS BIGINT) AS n_features, CAST(weight AS BIGINT) AS weight, CAST(score AS BIGINT) AS score,
  CASE WHEN place <= {importance.PERCENT} * able // 100 THEN CAST(place AS BIGINT) END AS rank
FROM scored LEFT JOIN ranks USING (r)
"""


ORACLES["op11_importance"] = _importance_sql()


@_query
def op12_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five vectors with the largest inner products for every fiftieth vector."""
    return impact_search.nearest(_table(spark, sf_dir, "embeddings"))


ORACLES["op12_exact_top_k"] = f"""
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id,
    list_transform(embedding, lambda x: CAST(floor({impact_search.SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
pairs AS (
  SELECT a.r, a.vec_id AS query_id, b.vec_id,
    CAST(coalesce(list_sum(list_transform(range(1, least(len(a.q), len(b.q)) + 1), lambda i: a.q[i] * b.q[i])), 0) AS BIGINT) AS score
  FROM v a JOIN v b ON a.r <> b.r WHERE a.vec_id % {impact_search.EVERY} = 0
),
ranks AS (SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id NULLS LAST) AS rank FROM pairs)
SELECT query_id, CAST(rank AS INT) AS rank, vec_id, score FROM ranks WHERE rank <= {impact_search.K}
"""


@_query
def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes of the prefix trie of all conversations, each rebuilt on the first turns of another."""
    return prefix_trie.prefix_trie(prefix_trie.rebuilt(_table(spark, sf_dir, "conversations")))


ORACLES["op13_prefix_trie"] = rf"""
WITH {_SQL_CRC_TABLE},
turns AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, digest) AS p, digest, words
  FROM (
    SELECT conv_id, turn, sha256(strlen(role) || ':' || role || text) AS digest, len({_SQL_WORDS}) AS words
    FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL)
  )
),
convs AS (
  SELECT conv_id, {_sql_crc("CAST(conv_id AS VARCHAR)")} % 4 AS h FROM (SELECT DISTINCT conv_id FROM turns), crc
),
mixed AS (
  SELECT c.conv_id, p, digest, words FROM convs c JOIN turns t ON t.conv_id = c.conv_id - c.conv_id % 20 AND p <= h
  UNION ALL SELECT c.conv_id, p, digest, words FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND p > h
),
placed AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY p) AS depth, digest, words FROM mixed),
prefixes AS (
  SELECT conv_id, 0 AS depth, '' AS node, '' AS parent, 0 AS words FROM convs
  UNION ALL
  SELECT a.conv_id, a.depth, string_agg(b.digest, '' ORDER BY b.depth), coalesce(string_agg(b.digest, '' ORDER BY b.depth) FILTER (WHERE b.depth < a.depth), ''), any_value(a.words)
  FROM placed a JOIN placed b ON a.conv_id = b.conv_id AND b.depth <= a.depth GROUP BY a.conv_id, a.depth
),
lengths AS (SELECT conv_id, max(depth) AS n FROM prefixes GROUP BY conv_id),
nodes AS MATERIALIZED (
  SELECT node, any_value(parent) AS parent, any_value(depth) AS depth, any_value(words) AS words, min(conv_id) AS conv_id, count(*) AS n_convs,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE n = depth), '')) AS ends_sha256
  FROM prefixes JOIN lengths USING (conv_id) GROUP BY node
),
children AS (SELECT parent AS node, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY parent),
below AS (
  SELECT a.node, count(*) FILTER (WHERE n_children IS NULL) AS n_leaves, sum((b.n_convs - 1) * b.words) AS saved
  FROM nodes a JOIN (SELECT * FROM nodes LEFT JOIN children USING (node)) b ON starts_with(b.node, a.node) GROUP BY a.node
)
SELECT a.conv_id, CAST(a.depth AS BIGINT) AS depth, CASE WHEN a.depth > 0 THEN p.conv_id END AS parent_conv_id, a.n_convs,
  coalesce(n_children, 0) AS n_children, n_leaves, CAST(saved AS BIGINT) AS saved_tokens, a.ends_sha256
FROM nodes a JOIN nodes p ON p.node = a.parent LEFT JOIN children c ON c.node = a.node JOIN below s ON s.node = a.node
"""
