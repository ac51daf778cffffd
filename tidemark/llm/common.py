"""Helpers that the operators share: inputs, word positions, links to components."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.session import remove_folder, stage, work_folder

#: White space of a word split, as the contracts state it: the blank and the bytes 9 to 13.
WHITE = r"[\x20\x09-\x0D]+"
BLANKS = " \t\n\x0b\f\r"
#: Documents in a batch that goes to Python.
ROWS = 512
#: Buckets of a bucketed table at most; Spark refuses more than 100,000.
MAX_BUCKETS = 10_000


def document_texts(docs: DataFrame, *more: str) -> DataFrame:
    """``doc_id``, ``text`` (null: empty) and ``more``; any other column is left behind."""
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), *more)


def small_batches(docs: DataFrame) -> DataFrame:
    """``docs``, after limiting the rows that Spark hands to Python at a time.

    Spark's own limit counts rows; with whole documents as rows a batch of the usual 10,000 takes
    tens of megabytes on either side. The setting stays with the session.
    """
    conf, key = docs.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(conf.get(key)) > ROWS or int(conf.get(key)) <= 0:
        conf.set(key, ROWS)
    return docs


def words_of(text: str | Column) -> Column:
    """Maximal runs of characters that are no white space."""
    return F.array_remove(F.split(text, WHITE), "")


def ascii_lower(text: str | Column) -> Column:
    """A-Z lower-cased, all other characters kept."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def crc_remainder(column: str, modulus: int) -> Column:
    """crc32 of the number's decimal text, modulo ``modulus`` (null counts as the empty text)."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % modulus


@contextmanager
def bucketed(rows: DataFrame, column: str, buckets: int, label: str) -> Iterator[DataFrame]:
    """``rows`` as a table bucketed by ``column`` in the shared folder, for the time of a block.

    Joins by that column then read the rows where they are. Beyond ``MAX_BUCKETS`` several values share
    a bucket; they stay groups of their own.
    """
    spark, name = rows.sparkSession, f"{label}_{uuid.uuid4().hex}"
    folder = work_folder(spark, label)
    try:
        rows.write.bucketBy(min(buckets, MAX_BUCKETS), column).option("path", folder).saveAsTable(name)
        yield spark.table(name)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        remove_folder(spark, folder)


# ---------------------------------------------------------------- words as arrays


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a text column without nulls, one after the other, and its offsets."""
    column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None:
        return np.zeros(0, dtype=np.uint8), offsets - offsets[0]
    return np.frombuffer(data, dtype=np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def lower_bytes(data: np.ndarray) -> np.ndarray:
    """A-Z lower-cased."""
    return data + (((data >= 65) & (data <= 90)).astype(np.uint8) << 5)


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each word, and the number of words per text."""
    inner = ~((data == 32) | ((data >= 9) & (data <= 13)))
    before = np.zeros(len(data) + 1, dtype=bool)
    before[1:] = inner
    first = np.zeros(len(data) + 1, dtype=bool)
    first[offsets] = True
    after = np.append(inner, False)
    starts = np.flatnonzero(after & (~before | first))
    ends = np.flatnonzero(before & (~after | first))
    return starts, ends, np.diff(np.searchsorted(starts, offsets))


_FACTOR = np.uint64(0x9E3779B97F4A7C15)


def mix(values: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a bijection)."""
    values = values ^ (values >> np.uint64(31))
    values = values * np.uint64(0x7FB5D329728EA185)
    values = values ^ (values >> np.uint64(27))
    values = values * np.uint64(0x81DADEF4BC2DD44D)
    return values ^ (values >> np.uint64(33))


def _powers(n: int) -> np.ndarray:
    out = np.full(n, _FACTOR, dtype=np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


_INVERSE = np.uint64(pow(int(_FACTOR), -1, 1 << 64))
_CHUNK = 1 << 19


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of ``data``; spans are sorted and do not overlap.

    Polynomial prefix sums, a part of the bytes at a time, so that the extra memory is
    bounded by the part and by the longest span.
    """
    out = np.empty(len(starts), dtype=np.uint64)
    at = 0
    while at < len(starts):
        base = starts[at]
        to = max(at + 1, int(np.searchsorted(ends, base + _CHUNK, side="right")))
        part = data[base : ends[to - 1]]
        powers = _powers(len(part) + 1)
        sums = np.zeros(len(part) + 1, dtype=np.uint64)
        np.cumsum((part.astype(np.uint64) + np.uint64(1)) * powers[:-1], out=sums[1:])
        back = np.full(len(part) + 1, _INVERSE, dtype=np.uint64)
        back[0] = 1
        back = np.multiply.accumulate(back)
        s, e = starts[at:to] - base, ends[at:to] - base
        lengths = (e - s).astype(np.uint64)
        out[at:to] = mix((sums[e] - sums[s]) * back[s] + lengths * np.uint64(0xD6E8FEB86659FD93))
        at = to
    return out


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """The batches cut so that each has at most ``limit`` bytes of ``column``, or one row."""
    for batch in batches:
        sizes = np.cumsum(pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False))
        at = 0
        while at < batch.num_rows:
            done = sizes[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(sizes, done + limit, side="right")))
            yield batch.slice(at, to - at)
            at = to


# ---------------------------------------------------------------- links to components


def local_stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A link from each node to the smallest node it is connected with, for the links of one task."""
    nodes, index = np.unique(np.concatenate([a, b]), return_inverse=True)
    left, right = index[: len(a)], index[len(a) :]
    label = np.arange(len(nodes))
    while True:
        least = np.minimum(label[left], label[right])
        new = label.copy()
        for side in (left, right):
            np.minimum.at(new, label[side], least)
            np.minimum.at(new, side, least)
        new = new[new]
        if (new == label).all():
            break
        label = new
    far = label != np.arange(len(nodes))
    return nodes[far], nodes[label[far]]


def components(links: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """``node`` and ``component`` (the smallest node reachable) of every node with a link.

    Alternating stars: every node points its larger neighbours, then its smaller ones, to the
    smallest node around it. Rounds grow with the logarithm of the longest chain. Each round is
    written to the shared folder, which cuts the lineage; the driver sees two sums per round.
    """
    pairs = links.select(
        F.greatest(left, right).alias("high"), F.least(left, right).alias("low")
    ).where("high <> low")
    pairs = stage(pairs.distinct(), "links")
    seen = None
    while True:
        both = pairs.union(pairs.select(F.col("low"), F.col("high"))).toDF("node", "other")
        least = both.groupBy("node").agg(F.min("other").alias("least"))
        least = least.select("node", F.least("node", "least").alias("least"))
        large = (
            both.where("other > node").join(least, "node")
            .select(F.col("other").alias("high"), F.col("least").alias("low")).where("high <> low").distinct()
        )
        large = stage(large, "links")
        least = large.groupBy("high").agg(F.min("low").alias("least"))
        small = large.join(least, "high").select(
            F.when(F.col("low") == F.col("least"), F.col("high")).otherwise(F.col("low")).alias("high"),
            F.col("least").alias("low"),
        ).where("high <> low").distinct()
        pairs = stage(small, "links")
        state = tuple(
            pairs.agg(
                F.count("*"), F.bit_xor(F.xxhash64("high", "low")), F.bit_xor(F.xxhash64("low", "high"))
            ).first()
        )
        if state == seen:
            break
        seen = state
    roots = pairs.select("low").distinct().select(F.col("low").alias("node"), F.col("low").alias("component"))
    return pairs.select(F.col("high").alias("node"), F.col("low").alias("component")).union(roots)
