"""Exact top-k by inner product over an impact-ordered index, score at a time.

Components are quantised to integers. The index of a shard holds, for every dimension, postings in
segments of equal quantised component. A vector scores at most what its length allows, the score it would
have if it pointed where the query points: 2 a q.x = |a q|^2 + |x|^2 - |a q - x|^2, with any factor a. The impact
of a segment on a query is what it takes off that largest score, (a q_d - v)^2. Segments of all
dimensions are processed in the order of their impact, the largest first, and added up per vector; so every vector has a
largest possible score at any time. The query stops when that bound proves all but a few vectors to be below the
k-th best exact score known; the possible members are scored exactly. If the proof never
comes, all segments are processed and the remaining vectors are scored exactly.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tidemark.session import stage

SCALE, K, EVERY = 256, 5, 50
#: Vectors of a shard, and queries that meet a shard in one task.
SHARD, BLOCK = 32768, 4096
#: Queries of a block at least, where more blocks would keep more tasks busy.
LEAST = 64
#: Quantised components are kept inside this bound (components of 16,384 at scale 256).
LARGEST = 1 << 22
#: A band of segments ends about where this part of all postings is processed.
BANDS = (0.28, 0.36, 0.5, 0.7, 1.0)
#: The search stops when at most this part of a shard can still be a member.
FEW = 1 / 10
#: Vectors with the largest bounds that are scored after each band, for the k-th best score known.
TRIED = 32
_SPAN = 1 << 24


class Index:
    """Impact-ordered postings of one shard; ``vectors`` has a row of integers per vector."""

    def __init__(self, vectors: np.ndarray):
        self.vectors = vectors
        self.n, self.size = vectors.shape
        order = np.argsort(vectors, axis=0, kind="stable").T
        values = np.take_along_axis(vectors.T, order, axis=1)
        self.ids, self.values = order.ravel().astype(np.int32), values.ravel().astype(np.float32)
        # A segment is named by dimension and component; the names rise along the postings.
        names = (np.arange(self.size)[:, None] * _SPAN + values + (_SPAN >> 1)).ravel()
        starts = np.flatnonzero(np.diff(names, prepend=-1))
        self.names, self.starts = names[starts], np.append(starts, len(names))
        self.first = np.arange(self.size) * self.n
        self.lengths = (vectors.astype(np.float64) ** 2).sum(axis=1)
        # Filled anew by every band of every query.
        self._ids, self._impacts = np.empty(self.ids.shape, np.int64), np.empty(self.ids.shape)
        self.some = vectors[:: max(1, self.n // 64)].astype(np.float64)

    def _places(self, edge: np.ndarray, side: str) -> np.ndarray:
        """Per dimension, the posting where components from ``edge`` on (left) or above it (right) begin."""
        edge = np.clip(edge, 1 - (_SPAN >> 1), (_SPAN >> 1) - 2).astype(np.int64)
        name = np.arange(self.size) * _SPAN + edge + (_SPAN >> 1)
        return np.clip(self.starts[np.searchsorted(self.names, name, side=side)], self.first, self.first + self.n)

    def top(self, query: np.ndarray, k: int, own: int) -> tuple[np.ndarray, np.ndarray, int]:
        """Rows of the ``k`` best without row ``own`` (ties of the last included), exact scores, postings used.

        Every vector left out is proved to be below the k-th best exact score.
        """
        length = float((query.astype(np.float64) ** 2).sum())
        factor = np.sqrt(self.lengths.mean() / length) if length and self.lengths.any() else 1.0
        aim = query * factor
        gaps = np.abs(self.some - aim).ravel()
        ends = [len(gaps) - 1 - int((len(gaps) - 1) * share) for share in BANDS]
        gaps = np.partition(gaps, ends) if len(gaps) else gaps
        lost, used, known = np.zeros(self.n), 0, -np.inf
        low, high = self.first, self.first + self.n
        for share, end in zip(BANDS, ends):
            least = gaps[end] if share < 1 and len(gaps) else 0.0
            if least > 0:
                below = np.maximum(low, self._places(np.floor(aim - least), "right"))
                above = np.maximum(below, np.minimum(high, self._places(np.ceil(aim + least), "left")))
            else:
                below = above = high
            used += self._process(aim, np.concatenate([low, above]), np.concatenate([below, high]), lost)
            low, high = below, above
            most = (factor * factor * length + self.lengths - lost) / (2 * factor)
            if own >= 0:
                most[own] = -np.inf
            tried = np.argpartition(most, max(0, self.n - TRIED - k))[-(TRIED + k) :]
            tried = tried[tried != own]
            if len(tried) >= k:
                known = max(known, float(np.sort(self.vectors[tried] @ query)[-k]))
            # The bound is exact but for rounding, which stays far below this slack.
            left = np.flatnonzero(most >= known - 1e-9 * (1 + np.abs(known) + length + self.lengths))
            left = left[left != own]
            if len(left) <= max(4 * k, self.n * FEW):
                break
        exact = self.vectors[left] @ query
        if len(left) > k:
            best = exact >= np.partition(exact, len(left) - k)[len(left) - k]
            left, exact = left[best], exact[best]
        return left, exact, used

    def _process(self, aim: np.ndarray, begin: np.ndarray, end: np.ndarray, lost: np.ndarray) -> int:
        """Add the impacts of the postings of each range to their vectors."""
        length = end - begin
        total = int(length.sum())
        if total:
            ids, impacts, at = self._ids[:total], self._impacts[:total], 0
            aim, begin, end = np.tile(aim, 2).tolist(), begin.tolist(), end.tolist()
            for d in np.flatnonzero(length).tolist():
                to = at + end[d] - begin[d]
                ids[at:to] = self.ids[begin[d] : end[d]]
                np.subtract(self.values[begin[d] : end[d]], aim[d], out=impacts[at:to], dtype=np.float64)
                at = to
            np.square(impacts, out=impacts)
            lost += np.bincount(ids, weights=impacts, minlength=self.n)
        return total


def _matrix(column: pa.ChunkedArray | pa.Array, size: int) -> np.ndarray:
    """The lists as rows of a matrix; missing components at the end are zeros."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    lengths = np.asarray(column.value_lengths())
    out = np.zeros((len(column), size), dtype=np.int64)
    rows = np.repeat(np.arange(len(column)), lengths)
    places = np.arange(len(rows)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    out[rows, places] = column.flatten().to_numpy(zero_copy_only=False)
    return out


def _search(k: int):
    out = pa.schema([("query", pa.int64()), ("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])

    def run(key: tuple, queries: pa.Table, shard: pa.Table) -> pa.Table:
        if not queries.num_rows or not shard.num_rows:
            return out.empty_table()
        size = max(int(np.max(t.column("q").combine_chunks().value_lengths().to_numpy())) for t in (queries, shard))
        index, asked = Index(_matrix(shard.column("q"), size)), _matrix(queries.column("q"), size)
        rows = shard.column("row").to_numpy()
        order = np.argsort(rows)
        names = queries.column("row").to_numpy()
        at = np.minimum(np.searchsorted(rows[order], names), len(rows) - 1)
        own = np.where(rows[order][at] == names, order[at], -1)
        ids = shard.column("vec_id").combine_chunks()
        found, scores, counts = [], [], []
        for i in range(len(names)):
            there, exact, _ = index.top(asked[i], k, int(own[i]))
            if len(there) > k:  # ties at the last place: the smaller ids, nulls last
                tie = ids.take(pa.array(there))
                rank = np.lexsort((rows[there], tie.fill_null(0).to_numpy(), tie.is_null().to_numpy(zero_copy_only=False), -exact))[:k]
                there, exact = there[rank], exact[rank]
            found.append(there)
            scores.append(exact)
            counts.append(len(there))
        return pa.table(
            [
                pa.array(np.repeat(names, counts)),
                pa.array(np.repeat(queries.column("vec_id").to_numpy(), counts)),
                ids.take(pa.array(np.concatenate(found).astype(np.int64))),
                pa.array(np.concatenate(scores)),
            ],
            schema=out,
        )

    return run


def quantised(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """``vec_id`` and ``q``, the floored multiples of the components, of every vector that takes part."""
    fine = F.col("embedding").isNotNull() & F.forall(
        "embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    )
    def integer(x):
        return F.floor(F.greatest(F.least(x.cast("double") * scale, F.lit(float(LARGEST))), F.lit(float(-LARGEST)))).cast("int")

    return vectors.where(fine).select(F.col("vec_id").cast("long").alias("vec_id"), F.transform("embedding", integer).alias("q"))


def nearest(vectors: DataFrame, k: int = K, every: int = EVERY, scale: int = SCALE) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id`` and ``score`` of the ``k`` best vectors of each query.

    Queries are the rows whose vec_id ``every`` divides; all rows but a query's own are candidates, also
    those that repeat its id or its vector. Ties go to the smaller vec_id, a null one last. Null
    vectors and those with null or non-finite components take no part; a missing component at the
    end of a shorter vector counts as zero, so an empty vector scores zero. Components beyond
    16,384 in size count as 16,384. A row that repeats a query is a query as well. An empty table, or one vector alone,
    gives an empty result. Other columns are ignored.

    Rows are dealt to shards of about ``SHARD`` and queries to blocks of about ``BLOCK``; every block meets every
    shard in one task, which sends ``k`` rows a query.
    """
    rows = stage(quantised(vectors, scale).withColumn("row", F.monotonically_increasing_id()), "quantised")
    asked = rows.where(F.col("vec_id") % every == 0)
    shards = max(1, -(-rows.count() // SHARD))
    n, tasks = asked.count(), int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    blocks = max(1, -(-n // BLOCK), min(-(-tasks // shards), -(-n // LEAST)))

    def dealt(n: int):
        return F.pmod(F.xxhash64("row"), F.lit(n)).cast("int")

    def all_of(n: int):
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    left = asked.select("row", "vec_id", "q", dealt(blocks).alias("block"), all_of(shards).alias("shard"))
    right = rows.select("row", "vec_id", "q", all_of(blocks).alias("block"), dealt(shards).alias("shard"))
    found = left.groupBy("block", "shard").cogroup(right.groupBy("block", "shard")).applyInArrow(
        _search(k), "query long, query_id long, vec_id long, score long"
    )
    best = Window.partitionBy("query", "query_id").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score"
    )
