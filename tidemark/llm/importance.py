"""Target-distribution importance resampling: draw documents that look like a target collection.

Features are hashed runs of one and two words. The log ratio of a bucket's share in the target to its
share in the documents is its gain; all gains are one array of a fixed number of buckets, and a document's
weight is the mean of its features' gains. Gumbel noise from a hash of the id, added to the weight, makes the
highest scores a draw without replacement in proportion to the weights. Ranks come from ``regular_sort``.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.common import document_texts, slices, small_batches, text_bytes, word_spans
from tidemark.llm.regular_sort import ranked
from tidemark.session import stage

BUCKETS = 10_000
#: Longest run of words that is a feature.
WORDS = 2
PERCENT, MIN_WORDS, SEED = 25, 20, 7
#: Bytes of text that are taken apart at a time.
PART = 1 << 20
#: Bytes of a word that are hashed for all words together; longer words go on alone.
_TOGETHER = 48
_ONES = np.uint32(0xFFFFFFFF)


def _word_table() -> np.ndarray:
    """Letters (lower-cased), digits and bytes beyond ASCII as they are, all others as blanks."""
    codes = np.arange(256, dtype=np.uint8)
    upper = (codes >= 65) & (codes <= 90)
    kept = (codes >= 128) | ((codes >= 48) & (codes <= 57)) | ((codes >= 97) & (codes <= 122))
    return np.where(upper, codes + 32, np.where(kept, codes, 32)).astype(np.uint8)


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, np.uint32(0xEDB88320) ^ (table >> 1), table >> 1)
    return table


_WORDS, _CRC = _word_table(), _crc_table()


def _appended(state: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Each unfinished crc32 after the bytes of its span."""
    lengths = ends - starts
    order = np.argsort(-lengths, kind="stable")
    state, at = state[order], starts[order]
    longer = np.searchsorted(-lengths[order], -np.arange(_TOGETHER + 1), side="left")
    for k in range(_TOGETHER):
        n = longer[k]
        if not n:
            break
        now = state[:n]
        state[:n] = _CRC[(now ^ data[at[:n] + k]) & 255] ^ (now >> 8)
    for i in range(longer[_TOGETHER]):
        rest = data[at[i] + _TOGETHER : ends[order[i]]]
        state[i] = zlib.crc32(rest, int(state[i] ^ _ONES)) ^ 0xFFFFFFFF
    out = np.empty_like(state)
    out[order] = state
    return out


def feature_buckets(column: pa.Array, words: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket of every feature of all texts, the index of its text, and the number of words per text."""
    data, offsets = text_bytes(column)
    data = _WORDS[data]
    starts, ends, per_text = word_spans(data, offsets)
    text = np.repeat(np.arange(len(per_text)), per_text)
    state = _appended(np.full(len(starts), _ONES), data, starts, ends)
    found, owners, left = [(state ^ _ONES) % np.uint32(buckets)], [text], np.arange(len(starts))
    for size in range(1, words):
        more = left + size < len(starts)
        more[more] = text[left[more]] == text[left[more] + size]
        left, state = left[more], state[more]
        state = _CRC[(state ^ np.uint32(32)) & 255] ^ (state >> 8)
        state = _appended(state, data, starts[left + size], ends[left + size])
        found.append((state ^ _ONES) % np.uint32(buckets))
        owners.append(text[left])
    return np.concatenate(found).astype(np.int64), np.concatenate(owners), per_text


def bucket_counts(texts: DataFrame, words: int = WORDS, buckets: int = BUCKETS) -> np.ndarray:
    """Features in each bucket over all rows; every task sends one row per bucket at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(buckets, dtype=np.int64)
        for part in slices(batches, "text", PART):
            counts += np.bincount(feature_buckets(part.column("text"), words, buckets)[0], minlength=buckets)
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(counts[used])], ["bucket", "n"])

    text = texts.select(F.coalesce("text", F.lit("")).alias("text"))
    counted = small_batches(text).mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n"))
    out = np.zeros(buckets, dtype=np.int64)
    for bucket, n in counted.collect():
        out[bucket] = n
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of target to source, per bucket, each count one higher."""
    k, all_s, all_t = len(source), int(source.sum()), int(target.sum())
    ratio = [
        float(t + 1) * float(all_s + k) / (float(s + 1) * float(all_t + k))
        for s, t in zip(source.tolist(), target.tolist())
    ]
    return np.array([math.floor(1000 * math.log(x)) for x in ratio], dtype=np.int64)


def weighed(docs: DataFrame, gain: np.ndarray, words: int = WORDS) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_features`` and ``weight`` of every row."""
    buckets = len(gain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text", PART):
            bucket, owner, n_words = feature_buckets(part.column("text"), words, buckets)
            n = np.bincount(owner, minlength=part.num_rows).astype(np.int64)
            total = np.zeros(part.num_rows, dtype=np.int64)
            np.add.at(total, owner, gain[bucket])
            weight = np.where(n > 0, total // np.maximum(n, 1), 0)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(n_words.astype(np.int64)), pa.array(n), pa.array(weight)],
                ["doc_id", "n_words", "n_features", "weight"],
            )

    texts = document_texts(docs).withColumn("doc_id", F.col("doc_id").cast("long"))
    return small_batches(texts).mapInArrow(run, "doc_id long, n_words long, n_features long, weight long")


def _noise(seed: int) -> Column:
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def resampled(
    docs: DataFrame, target: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS,
    words: int = WORDS, buckets: int = BUCKETS, seed: int = SEED,
) -> DataFrame:
    """``doc_id``, ``n_features``, ``weight``, ``score`` and ``rank`` of every row of ``docs``, all long.

    Of the rows with ``min_words`` words, ``percent`` in a hundred are drawn; the others have no rank.
    Ties go to the smaller doc_id, a null doc_id comes last (its noise is that of the empty id), equal rows are
    ranked next to each other. Null and empty texts have no features, weight 0 and no rank. An
    empty table gives an empty result, an empty target makes rare features win. Other columns are ignored.
    """
    gain = gains(bucket_counts(docs, words, buckets), bucket_counts(target, words, buckets))
    scored = weighed(docs, gain, words).withColumn("score", F.col("weight") + _noise(seed))
    scored = stage(scored, "scores")
    able = scored.where(F.col("n_words") >= min_words)
    total = able.count()
    columns = ["doc_id", "n_features", "weight", "score"]
    ranks = ranked(able.select(columns), total, "score", "doc_id", "rank")
    drawn = F.when(F.col("rank") <= percent * total // 100, F.col("rank"))
    short = scored.where(F.col("n_words") < min_words)
    return ranks.select(*columns, drawn.alias("rank")).union(
        short.select(*columns, F.lit(None).cast("long").alias("rank"))
    )


def drawn(docs: DataFrame, ranks: DataFrame) -> DataFrame:
    """The rows of ``docs`` that ``resampled`` drew, all columns unchanged; ids name rows."""
    return docs.join(ranks.where("rank IS NOT NULL").select("doc_id"), "doc_id", "left_semi").select(docs.columns)
