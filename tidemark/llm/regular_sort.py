"""Exact ranks by parallel sorting by regular sampling.

Every task sorts its own rows (a run) and takes rows at regular places of the run as samples. The
sorted samples give splitters; each run is cut at them, the pieces between two splitters meet in one
task and are merged there. The numbers of rows in the segments before, added up, turn a place in
a segment into a rank. Splitters compare score, tie breaker and the place in the runs, which is unique:
segments keep their size however many rows share a score or an id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tidemark.session import stage, staged

#: Rows of a run or segment in tables that need more of them than the session has shuffle partitions.
RUN = 16_000_000
#: Runs taken from the session's setting at most; samples are the square of it (16 bytes each).
RUNS = 512
_SIGN = np.uint64(1 << 63)


def _keys(batch: pa.RecordBatch | pa.Table, score: str, tie: str) -> np.ndarray:
    """Fixed-width keys whose byte order is: score down, tie up, nulls last, run, place."""
    ids = batch.column(tie)
    parts = np.empty((batch.num_rows, 5), dtype=">u8")
    parts[:, 0] = ~(batch.column(score).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64) ^ _SIGN)
    parts[:, 1] = ids.is_null().to_numpy(zero_copy_only=False)
    parts[:, 2] = ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64) ^ _SIGN
    parts[:, 3] = batch.column("_run").to_numpy(zero_copy_only=False)
    parts[:, 4] = batch.column("_place").to_numpy(zero_copy_only=False)
    return parts.view("S40").ravel()


def _with(schema: StructType, *names: str) -> StructType:
    return StructType([*schema.fields, *(StructField(name, LongType()) for name in names)])


def _number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    run, place = TaskContext.get().partitionId(), 0
    for batch in batches:
        n = batch.num_rows
        yield batch.append_column("_run", pa.array(np.full(n, run, dtype=np.int64))).append_column(
            "_place", pa.array(np.arange(place, place + n))
        )
        place += n


def _cut(splitters: np.ndarray, score: str, tie: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            segment = np.searchsorted(splitters, _keys(batch, score, tie), side="right")
            yield batch.append_column("_segment", pa.array(segment.astype(np.int64)))

    return run


def _place_in_segment(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    last, seen = -1, 0
    for batch in batches:
        segment = batch.column("_segment").to_numpy()
        at = np.arange(len(segment))
        first = np.flatnonzero(np.diff(segment, prepend=-1 if len(segment) else 0))
        at -= np.repeat(first, np.diff(np.append(first, len(segment))))
        if len(segment):
            at[segment == last] += seen
            last, seen = segment[-1], at[-1] + 1
        yield batch.append_column("_at", pa.array(at.astype(np.int64)))


def ranked(rows: DataFrame, total: int, score: str, tie: str, rank: str) -> DataFrame:
    """``rows`` and their ``rank`` (1, 2, 3...) by ``score`` downwards, then ``tie`` upwards, nulls last.

    ``total`` is the number of rows; ``rows`` is read once. ``score`` (no nulls) and ``tie`` are longs.
    Equal rows get ranks next to each other. The driver sees the samples, as many as the square of the
    number of runs, and one count per segment.
    """
    spark = rows.sparkSession
    parts = max(min(int(spark.conf.get("spark.sql.shuffle.partitions")), RUNS), -(-total // RUN), 1)
    order = [F.desc(score), F.asc_nulls_last(tie)]
    numbered = _with(rows.schema, "_run", "_place")
    runs = rows.coalesce(parts).sortWithinPartitions(*order).mapInArrow(_number, numbered)
    with staged(runs, "runs") as runs:
        step = max(1, total // (parts * parts))
        samples = runs.where(F.col("_place") % step == 0).select(score, tie, "_run", "_place").toArrow()
        keys = np.sort(_keys(samples.combine_chunks(), score, tie))
        splitters = keys[[len(keys) * k // parts for k in range(1, parts)]] if len(keys) else keys
        cut = runs.mapInArrow(_cut(splitters, score, tie), _with(numbered, "_segment"))
        merged = cut.repartitionById(parts, F.col("_segment").cast("int")).sortWithinPartitions(
            "_segment", *order, "_run", "_place"
        )
        segments = stage(merged.mapInArrow(_place_in_segment, _with(numbered, "_segment", "_at")), "segments")
    counts = dict(segments.groupBy("_segment").count().collect())
    before = np.cumsum([0, *(counts.get(k, 0) for k in range(parts - 1))]).tolist()
    place = F.get(F.lit(before).cast("array<long>"), F.col("_segment").cast("int")) + F.col("_at") + 1
    return segments.select(*[c for c in rows.columns if c != rank], place.alias(rank))
