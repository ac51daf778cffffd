"""Quality rules with cross-document line frequency, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.common import BLANKS, WHITE, document_texts, words_of
from tidemark.session import stage

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
#: A line is removed when it stands in more documents of its host than either limit allows.
MAX_DOCS = 20
MAX_PER_MILLE = 1
#: A document is depleted when removed lines hold more than this share of its characters.
MAX_REMOVED_PERCENT = 70


def _blank_free_length(text: Column) -> Column:
    return F.char_length(F.translate(text, BLANKS, ""))


def _normal_line(line: Column) -> Column:
    return F.lower(F.trim(F.regexp_replace(line, WHITE, " ")))


def measured(docs: DataFrame, *more: str) -> DataFrame:
    """Counts of each text: words, word characters, symbols, repeated lines and repeated words.

    Windows of five words are compared by 64-bit hashes. The positions of repeated windows are
    sorted only for texts that have any.
    """
    text = F.col("text")
    keep = ["doc_id", "text_hash", *more]
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines"]
    # The texts go through one projection only; later steps hold hashes.
    lines = F.transform(
        F.split(text, "\n"),
        lambda l: F.struct(
            F.xxhash64(l).alias("raw"), F.xxhash64(_normal_line(l)).alias("line"), _blank_free_length(l).alias("chars")
        ),
    )
    lines = document_texts(docs, *more).withColumn("text_hash", F.xxhash64("text")).select(
        *keep,
        (F.char_length(text) - F.char_length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.transform(words_of(text), lambda w: F.xxhash64(w)).alias("_words"),
        F.filter(lines, lambda l: l.getField("chars") > 0).alias("_lines"),
    )
    n = F.size("_words")
    hashed = lines.select(
        *keep, "n_symbols", "_lines",
        n.cast("long").alias("n_words"),
        F.aggregate(
            "_lines", F.lit(0).cast("long"), lambda total, l: total + l.getField("chars")
        ).alias("word_chars"),
        (F.size("_lines") - F.size(F.array_distinct("_lines.raw"))).cast("long").alias("n_dup_lines"),
        F.when(
            n >= 5,
            F.transform(
                F.sequence(F.lit(0), n - 5), lambda i: F.xxhash64(*[F.get("_words", i + k) for k in range(5)])
            ),
        ).otherwise(F.array().cast("array<bigint>")).alias("_windows"),
    )
    repeats = F.size(F.array_distinct("_windows")) < F.size("_windows")
    ordered = hashed.select(
        *keep, *counts, "_lines",
        F.when(repeats, F.sort_array(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))
        .otherwise(F.array().cast("array<struct<h:bigint,i:int>>")).alias("_sorted"),
    )

    def twin(p: Column, k: Column) -> Column:
        near = [F.coalesce(F.get("_sorted", k + d).getField("h") == p.getField("h"), F.lit(False)) for d in (-1, 1)]
        return near[0] | near[1]

    found = ordered.select(
        *keep, *counts, "_lines",
        F.sort_array(F.transform(F.filter("_sorted", twin), lambda p: p.getField("i"))).alias("_at"),
    )
    gaps = F.transform("_at", lambda p, k: F.least(F.lit(5), F.coalesce(F.get("_at", k + 1) - p, F.lit(5))))
    covered = F.aggregate(gaps, F.lit(0).cast("long"), lambda total, x: total + x)
    return found.select(*keep, *counts, covered.alias("n_repeat_words"), "_lines")


def frequent_lines(lines: DataFrame, hosts: DataFrame, max_docs: int, max_per_mille: int) -> DataFrame:
    """``host``, ``line`` and its ``first`` document, for lines beyond both limits.

    ``lines`` has one row per document and line; copies combine before the shuffle.
    """
    counted = lines.groupBy("host", "line").agg(F.count("*").alias("n_docs"), F.min("doc_id").alias("first"))
    return counted.where(F.col("n_docs") > max_docs).alias("c").join(
        hosts.alias("h"),
        F.col("c.host").eqNullSafe(F.col("h.host")) & (F.col("n_docs") * 1000 > F.col("n_host") * max_per_mille),
    ).select("c.host", "line", "first")


def _measured_lines(
    docs: DataFrame, host: str, max_docs: int = MAX_DOCS, max_per_mille: int = MAX_PER_MILLE
) -> tuple[DataFrame, DataFrame]:
    """Counts of each row, staged, and its host's lines beyond both limits."""
    rows = measured(docs.select("doc_id", "text", F.col(host).alias("_host")), "_host")
    base_failed = (F.col("n_words") < MIN_WORDS) | (
        F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT
    )
    # Written once: three steps read it, and it holds no text.
    rows = rows.withColumn("base_failed", base_failed).withColumn("_row", F.monotonically_increasing_id())
    rows = stage(rows, "quality")
    hosts = rows.groupBy(F.col("_host").alias("host")).agg(F.count("*").alias("n_host"))
    return rows, frequent_lines(_lines_of(rows), hosts, max_docs, max_per_mille)


def _lines_of(rows: DataFrame) -> DataFrame:
    return (
        rows.select("_row", "doc_id", F.col("_host").alias("host"), F.inline("_lines"))
        .groupBy("_row", "doc_id", "host", "line").agg(F.sum("chars").alias("chars"))
    )


def _removed(lines: DataFrame, many: DataFrame) -> DataFrame:
    """The frequent ones of ``lines``, without those of the document that keeps them."""
    return lines.alias("l").join(
        many.alias("m"),
        F.col("l.host").eqNullSafe(F.col("m.host")) & (F.col("l.line") == F.col("m.line"))
        & ~F.col("l.doc_id").eqNullSafe(F.col("m.first")),
    )


def _judged(docs: DataFrame, host: str, max_removed_percent: int = MAX_REMOVED_PERCENT, **limits: int) -> DataFrame:
    rows, many = _measured_lines(docs, host, **limits)
    removed = _removed(_lines_of(rows), many).groupBy("_row").agg(F.sum("chars").alias("n_removed_chars"))
    joined = rows.join(removed, "_row", "left")
    n_removed = F.coalesce("n_removed_chars", F.lit(0)).cast("long")
    return joined.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & (n_removed * 100 <= F.col("word_chars") * max_removed_percent)).alias("kept"),
        n_removed.alias("n_removed_chars"), "text_hash", F.col("_host").alias("host"),
    )


def quality_rules(docs: DataFrame, host: str = "source", **limits: int) -> DataFrame:
    """A row per document: counts, ``base_failed``, ``n_removed_chars`` and ``kept``.

    A line, with case and spacing made equal, is removed when it stands in more than
    ``max_docs`` documents of its host and in more than ``max_per_mille`` thousandths of them;
    the host's document with the smallest id keeps it, so that one of many copies survives.
    A document whose removed lines hold more than ``max_removed_percent`` of its characters is
    depleted and not kept. A null text is empty and fails the base rules; a null host is a host
    of its own; repeated rows count as documents of their own, and those with the smallest id all
    keep their lines. An empty table gives an empty result; other columns are ignored.
    """
    return _judged(docs, host, **limits).drop("text_hash", "host")


def _verdicts(docs: DataFrame, host: str, max_removed_percent: int = MAX_REMOVED_PERCENT, **limits: int) -> DataFrame:
    """``doc_id``, ``host`` and ``text_hash`` of documents that are rejected or lose lines, once each,
    with ``kept`` and ``cut``, the places of the lost lines among the lines that are not blank.
    """
    rows, many = _measured_lines(docs, host, **limits)
    placed = rows.select("_row", "doc_id", F.col("_host").alias("host"), F.posexplode("_lines").alias("_at", "_line"))
    placed = placed.select("_row", "doc_id", "host", "_at", F.col("_line.line").alias("line"), F.col("_line.chars").alias("chars"))
    lost = _removed(placed, many).groupBy("_row").agg(
        F.sum("chars").alias("n_removed"), F.sort_array(F.collect_list("_at")).alias("cut")
    )
    joined = rows.select("_row", "doc_id", F.col("_host").alias("host"), "text_hash", "base_failed", "word_chars").join(lost, "_row", "left")
    kept = ~F.col("base_failed") & (F.coalesce("n_removed", F.lit(0)) * 100 <= F.col("word_chars") * max_removed_percent)
    found = joined.select("doc_id", "host", "text_hash", kept.alias("kept"), F.when(kept, F.col("cut")).alias("cut"))
    # Rows equal in the three columns have the same verdict and lose the same lines.
    return found.where("NOT kept OR cut IS NOT NULL").groupBy("doc_id", "host", "text_hash").agg(
        F.min("kept").alias("kept"), F.min("cut").alias("cut")
    )


def _without_lines(text: Column, cut: Column) -> Column:
    """``text`` without the lines at the sorted places ``cut``, counted among those not blank.

    What lies between two cut lines is taken in one slice, so the work grows with the lines.
    """

    def joined(lines: Column) -> Column:
        filled = F.filter(F.sequence(F.lit(0), F.size(lines) - 1), lambda i: _blank_free_length(F.get(lines, i)) > 0)
        # Bound once: a column named in a lambda is computed for every element.
        return F.get(F.transform(F.array(filled), lambda at: between(lines, F.transform(cut, lambda c: F.get(at, c)))), F.lit(0))

    def between(lines: Column, gone: Column) -> Column:
        ends = F.concat(gone, F.array(F.size(lines)))
        begins = F.concat(F.array(F.lit(0)), F.transform(gone, lambda g: g + 1))
        pieces = F.zip_with(begins, ends, lambda a, b: F.slice(lines, a + 1, b - a))
        return F.array_join(F.flatten(pieces), "\n")

    return F.get(F.transform(F.array(F.split(text, "\n")), joined), F.lit(0))


def cleaned(docs: DataFrame, host: str = "source", **limits: int) -> DataFrame:
    """The rows of ``docs`` that ``quality_rules`` keeps, their texts without the removed lines.

    Every line that counts into ``n_removed_chars`` goes from the text, with its line break; all
    other lines, blank ones as well, and all other columns are unchanged. Rows are named as in
    ``passing``.
    """
    verdicts = stage(_verdicts(docs, host, **limits), "verdicts").hint("merge").alias("g")
    same = (
        F.col("d.doc_id").eqNullSafe(F.col("g.doc_id"))
        & F.col(f"d.{host}").eqNullSafe(F.col("g.host"))
        & (F.xxhash64(F.coalesce("d.text", F.lit(""))) == F.col("g.text_hash"))
    )
    rows = docs.alias("d").join(verdicts, same, "left").where(F.coalesce("g.kept", F.lit(True)))
    text = F.when(F.col("g.cut").isNull(), F.col("d.text")).otherwise(_without_lines(F.col("d.text"), F.col("g.cut")))
    return rows.select(*[text.alias(name) if name == "text" else F.col(f"d.{name}") for name in docs.columns])


def passing(docs: DataFrame, host: str = "source", **limits: int) -> DataFrame:
    """The rows of ``docs`` that ``quality_rules`` keeps, all columns unchanged.

    Rejected rows are named by id, host and a hash of the text: rows equal in these share their
    fate. Their list grows with the documents, so both are shuffled, whatever its size today.
    """
    gone = _judged(docs, host, **limits).where(~F.col("kept")).select("doc_id", "host", "text_hash").distinct()
    gone = stage(gone, "rejected").hint("merge").alias("g")
    rows = docs.alias("d")
    same = (
        F.col("d.doc_id").eqNullSafe(F.col("g.doc_id"))
        & F.col(f"d.{host}").eqNullSafe(F.col("g.host"))
        & (F.xxhash64(F.coalesce("d.text", F.lit(""))) == F.col("g.text_hash"))
    )
    return rows.join(gone, same, "left_anti").select(*[F.col(f"d.{name}") for name in docs.columns])
