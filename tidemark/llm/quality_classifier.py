"""Quality classifier: naive Bayes features with a linear support vector machine.

Features are the words and word pairs of a text, hashed to ``BUCKETS``. Each present feature has
the value of its log-count ratio between the classes, from smoothed document counts over all
training rows. A linear hinge-loss model on the normalised features is fitted by dual coordinate
descent, on a bounded sample of the training rows, and interpolated with the plain ratios. A
logistic curve, fitted to the same rows, turns margins into scores.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import document_texts, lower_bytes, mix, slices, small_batches, span_hashes, text_bytes, word_spans
from tidemark.session import stage

#: Hash buckets of the features; a power of two.
BUCKETS = 1 << 18
#: Training rows, about, that the linear model is fitted on at most. Counts use all of them.
SAMPLE = 6_000
SMOOTHING = 1.0
PENALTY = 1.0
ROUNDS = 15
#: Weight of the fitted model against the plain ratios.
INTERPOLATION = 0.75


def row_features(texts: pa.Array, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """Row and bucket of every distinct word and word pair of each text."""
    data, offsets = text_bytes(texts)
    data = lower_bytes(data)
    starts, ends, counts = word_spans(data, offsets)
    hashes = span_hashes(data, starts, ends)
    rows = np.repeat(np.arange(len(counts)), counts)
    pairs = mix(hashes[:-1] * np.uint64(3) + hashes[1:])[rows[:-1] == rows[1:]] if len(rows) else hashes
    pair_rows = rows[:-1][rows[:-1] == rows[1:]] if len(rows) else rows
    keys = np.concatenate([rows, pair_rows]) * buckets + (
        np.concatenate([hashes, pairs]) & np.uint64(buckets - 1)
    ).astype(np.int64)
    keys = np.unique(keys)
    return keys // buckets, keys % buckets


def _count_batches(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros((2, buckets), dtype=np.int64)
        for batch in slices(batches, "text", 4 << 20):
            rows, features = row_features(batch.column("text"), buckets)
            labels = batch.column("quality").to_numpy()[rows]
            for label in (0, 1):
                totals[label] += np.bincount(features[labels == label], minlength=buckets)
        seen = np.flatnonzero(totals.any(axis=0))
        yield pa.RecordBatch.from_arrays(
            [pa.array(seen), pa.array(totals[0][seen]), pa.array(totals[1][seen])], ["feature", "n0", "n1"]
        )

    return run


def ratios(labelled: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Log-count ratio of each bucket over all rows of ``labelled``; the driver sees one number per bucket.

    Every task adds up its own rows first, so the shuffle holds a row per task and bucket.
    """
    counts = labelled.mapInArrow(_count_batches(buckets), "feature long, n0 long, n1 long")
    table = counts.groupBy("feature").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")).toArrow()
    totals = np.full((2, buckets), SMOOTHING)
    for label in (0, 1):
        totals[label][table.column("feature").to_numpy()] += table.column(f"n{label}").to_numpy()
    share = totals / totals.sum(axis=1, keepdims=True)
    return np.log(share[1] / share[0]).astype(np.float32)


def dual_coordinate_descent(
    rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, size: int, penalty: float, rounds: int
) -> np.ndarray:
    """Weights of the hinge-loss model; classes weigh the same whatever their size.

    ``rows`` are (features, values); one coordinate is one row's dual variable, kept between zero
    and its class's penalty.
    """
    weights = np.zeros(size)
    alphas = np.zeros(len(rows))
    squares = np.array([float(v @ v) for _, v in rows])
    share = np.where(labels > 0, np.mean(labels > 0), np.mean(labels < 0))
    top = penalty / (2 * np.maximum(share, 1e-9))
    rng = np.random.default_rng(0)
    for _ in range(rounds):
        for i in rng.permutation(len(rows)):
            if not squares[i]:
                continue
            features, values = rows[i]
            gradient = labels[i] * float(weights[features] @ values) - 1
            new = min(max(alphas[i] - gradient / squares[i], 0.0), top[i])
            if new != alphas[i]:
                weights[features] += (new - alphas[i]) * labels[i] * values
                alphas[i] = new
    return weights


def _logistic(margins: np.ndarray, labels: np.ndarray, stands_for: np.ndarray) -> tuple[float, float]:
    """Slope and level of the probability of label 1, by Newton steps with a small ridge.

    ``stands_for`` is the share of all rows that each row was picked for, one on average.
    """
    x = np.column_stack([margins, np.ones(len(margins))])
    y = (labels > 0).astype(float)
    beta = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        bend = (stands_for * p * (1 - p))[:, None]
        step = np.linalg.solve(x.T @ (x * bend) + 1e-3 * np.eye(2), x.T @ (stands_for * (y - p)) - 1e-3 * beta)
        beta += step
        if np.abs(step).max() < 1e-9:
            break
    return float(beta[0]), float(beta[1])


class Model:
    """Weights of all features, and the curve from margin to score."""

    def __init__(self, weights: np.ndarray, slope: float, level: float):
        self.weights, self.slope, self.level = weights.astype(np.float32), slope, level

    def scores(self, texts: pa.Array) -> np.ndarray:
        rows, features = row_features(texts, len(self.weights))
        return self.curve(_margins(rows, features, self.weights, len(texts)))

    def curve(self, margins: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * margins + self.level, -30, 30)))


def _margins(rows: np.ndarray, features: np.ndarray, weights: np.ndarray, n: int) -> np.ndarray:
    """Sum of the features' weights over the square root of their number."""
    size = np.maximum(np.bincount(rows, minlength=n), 1)
    return np.bincount(rows, weights=weights[features], minlength=n) / np.sqrt(size)


def fit(labelled: DataFrame, buckets: int = BUCKETS, sample: int = SAMPLE) -> Model:
    """A model of ``quality`` from ``text``; rows without a label of 0 or 1 are left out.

    Ratios come from all rows. The linear model is fitted on about ``sample`` of them, picked by a
    hash of the doc_id, with all their features; the driver sees no others. A rare class is picked more often, so
    that it has a tenth of them or all its rows, and its rows count less for the curve. With rows of one
    class or none every text gets the same score, the class's share.
    """
    labelled = small_batches(labelled).select(
        F.xxhash64("doc_id", F.lit("sample")).alias("_order"),
        F.coalesce("text", F.lit("")).alias("text"), F.col("quality").cast("int").alias("quality"),
    )
    labelled = stage(labelled.where("quality IN (0, 1)"), "labelled")
    ratio = ratios(labelled, buckets)

    def sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 4 << 20):
            rows, features = row_features(batch.column("text"), buckets)
            cuts = np.searchsorted(rows, np.arange(batch.num_rows + 1)).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(cuts), pa.array(features.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([lists, batch.column("quality")], ["features", "quality"])

    counts = dict(labelled.groupBy("quality").count().collect())
    wanted = {q: max(sample * n / sum(counts.values()), min(n, sample / 10)) for q, n in counts.items()}
    picked = F.lit(False)
    for q, n in counts.items():
        # The hash is any 64-bit number, so the smallest share of rows still has its threshold.
        below = -(1 << 63) + int((1 << 64) * (wanted[q] / n))
        picked |= (F.col("quality") == q) & (F.lit(wanted[q] >= n) | (F.col("_order") < min(below, (1 << 63) - 1)))
    chosen = labelled.where(picked)
    table = chosen.select("text", "quality").mapInArrow(sparse, "features array<int>, quality int").toArrow()
    lists = table.column("features").combine_chunks()
    labels = np.where(table.column("quality").to_numpy() > 0, 1.0, -1.0)
    if not len(labels) or abs(labels.mean()) == 1:
        share = np.clip((labels.mean() + 1) / 2 if len(labels) else 0.5, 0.01, 0.99)
        return Model(np.zeros(buckets), 0.0, float(np.log(share / (1 - share))))
    values, cuts = lists.values.to_numpy(), lists.offsets.to_numpy()
    features = [values[a:b] for a, b in zip(cuts[:-1], cuts[1:])]
    rows = [(f, ratio[f] / np.sqrt(max(1, len(f)))) for f in features]
    fitted = dual_coordinate_descent(rows, labels, buckets, PENALTY, ROUNDS)
    mean = np.abs(fitted).sum() / max(1, np.count_nonzero(fitted))
    # What the fit has not seen keeps the plain ratio at the fitted features' mean weight.
    weights = ratio * ((1 - INTERPOLATION) * mean + INTERPOLATION * fitted)
    # The curve is learnt from margins of rows left out of the fit, as scores of new texts will be.
    parts = np.arange(len(rows)) % 4
    margins = np.zeros(len(rows))
    for part in range(4):
        inside = [i for i in range(len(rows)) if parts[i] != part]
        other = dual_coordinate_descent([rows[i] for i in inside], labels[inside], buckets, PENALTY, ROUNDS // 3)
        level = np.abs(other).sum() / max(1, np.count_nonzero(other))
        w = ratio * ((1 - INTERPOLATION) * level + INTERPOLATION * other)
        for i in np.flatnonzero(parts == part):
            margins[i] = w[features[i]].sum() / np.sqrt(max(1, len(features[i])))
    every = sum(counts.values()) / len(labels)
    stands_for = {sign: counts[int(sign > 0)] / every / np.count_nonzero(labels == sign) for sign in (-1.0, 1.0)}
    slope, level = _logistic(margins, labels, np.where(labels > 0, stands_for[1.0], stands_for[-1.0]))
    return Model(weights, slope, level)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id`` and ``score`` (0 to 1) of every row, from its text alone.

    Null and empty texts have no features and get the curve's level; repeated rows and null ids
    stay rows; an empty table gives an empty result; other columns are ignored. The weights, four
    bytes for each bucket, travel with the tasks as a broadcast.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 4 << 20):
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(shared.value.scores(batch.column("text")))], ["doc_id", "score"]
            )

    return document_texts(small_batches(docs)).mapInArrow(run, "doc_id long, score double")
