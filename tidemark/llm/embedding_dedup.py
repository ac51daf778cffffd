"""Embedding near-duplicates by counting collisions of one-dimensional projections.

Every vector is projected on many random directions. In each projection the values are sorted,
and a vector collides with those inside a window around its own value. A pair close enough to
link collides in nearly all projections; the count that a pair must reach is set from the
binomial distribution of a pair exactly at the threshold. Pairs that reach it are verified by
their cosine. The first projections also deal the vectors into cells, with a window that a
linked pair leaves with a probability of a few millionths; so only near cells are compared.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.common import components, local_stars
from tidemark.session import stage

THRESHOLD = 0.98
PROJECTIONS = 32
#: Projections that deal vectors into cells; their window in standard deviations.
ANCHORS, ANCHOR_WIDTH = 2, 4.5
#: Window of the counted projections, in standard deviations of a pair at the threshold.
WIDTH = 2.6
#: Probability that a pair at the threshold reaches the required count.
RECALL = 0.9999
#: Projections counted for all pairs of a cell before the rest is counted for the remaining.
FIRST = 12
#: Vectors of a cell that one task compares with as many others.
BLOCK = 2048


def required_count(projections: int, width: float = WIDTH, recall: float = RECALL) -> int:
    """Collisions that a pair at the threshold has with probability ``recall`` at least."""
    hit = math.erf(width / math.sqrt(2))
    reached = 0.0
    for count in range(projections, -1, -1):
        reached += math.comb(projections, count) * hit**count * (1 - hit) ** (projections - count)
        if reached >= recall:
            return count
    return 0


def directions(size: int, projections: int = PROJECTIONS) -> np.ndarray:
    """Random unit vectors, the same in every task."""
    found = np.random.default_rng([size, projections]).normal(size=(size, projections))
    return found / np.linalg.norm(found, axis=0)


def _spread(size: int, threshold: float) -> float:
    """Standard deviation of the projected difference of two unit vectors at the threshold."""
    return math.sqrt((2 - 2 * threshold) / size)


def _cells(threshold: float):
    def run(batches):
        for batch in batches:
            g, label, copies = (batch.column(name) for name in ("g", "label", "copies"))
            vectors = batch.column("embedding")
            sizes = vectors.value_lengths().to_numpy()
            for size in np.unique(sizes):
                rows = np.flatnonzero(sizes == size)
                mine = vectors.take(pa.array(rows))
                x = mine.flatten().to_numpy().reshape(len(rows), size)
                unit = x / np.linalg.norm(x, axis=1, keepdims=True)
                homes = np.floor(unit @ directions(size)[:, :ANCHORS] / (ANCHOR_WIDTH * _spread(size, threshold))).astype(np.int32)
                for shift in np.ndindex(*[2] * ANCHORS):
                    cell = homes - np.array(shift, dtype=np.int32)
                    yield pa.RecordBatch.from_arrays(
                        [
                            g.take(pa.array(rows)), label.take(pa.array(rows)), pa.array(np.full(len(rows), size, np.int32)),
                            pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1, dtype=np.int32) * ANCHORS), pa.array(cell.ravel())),
                            pa.array(np.full(len(rows), sum(s << k for k, s in enumerate(shift)), np.int32)),
                            copies.take(pa.array(rows)), mine,
                        ],
                        ["g", "label", "size", "cell", "halo", "copies", "embedding"],
                    )

    return run


_CELL = "g long, label int, size int, cell array<int>, halo int, copies long, embedding array<double>"


def colliding_pairs(left: np.ndarray, right: np.ndarray, allowed: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Indexes of the pairs (of unit vectors) whose collisions reach the required count."""
    size = left.shape[1]
    toward = directions(size)
    width, need = WIDTH * _spread(size, threshold), required_count(PROJECTIONS)
    p, q = left @ toward, right @ toward
    count = np.zeros((len(left), len(right) + 1), dtype=np.int8)
    inside = np.zeros((len(left), len(right)), dtype=np.int8)
    rows = np.arange(len(left))
    for k in range(FIRST):
        order = np.argsort(q[:, k], kind="stable")
        ranked = q[order, k]
        # One run of sorted neighbours per query: up at its start, down after its end.
        count[:] = 0
        np.add.at(count, (rows, np.searchsorted(ranked, p[:, k] - width, side="left")), 1)
        np.add.at(count, (rows, np.searchsorted(ranked, p[:, k] + width, side="right")), -1)
        inside[:, order] += np.cumsum(count[:, :-1], axis=1, dtype=np.int8)
    i, j = np.nonzero((inside >= need - (PROJECTIONS - FIRST)) & (inside >= FIRST - (PROJECTIONS - need)) & allowed)
    found = inside[i, j].astype(np.int64)
    for at in range(0, len(i), 1 << 18):
        part = slice(at, at + (1 << 18))
        found[part] += (np.abs(p[i[part], FIRST:] - q[j[part], FIRST:]) <= width).sum(axis=1)
    return i[found >= need], j[found >= need]


def _compare(threshold: float):
    def run(table: pa.Table) -> pa.Table:
        g, halo, copies = (table.column(name).to_numpy() for name in ("g", "halo", "copies"))
        mine, b1, b2 = (table.column(name).to_numpy() for name in ("block", "b1", "b2"))
        x = table.column("embedding").combine_chunks().flatten().to_numpy().reshape(len(g), -1)
        unit = x / np.linalg.norm(x, axis=1, keepdims=True)
        left, right = np.flatnonzero(mine == b1), np.flatnonzero(mine == b2)
        # A pair belongs to the cell that is home to one of the two in every direction.
        allowed = (halo[left][:, None] & halo[right][None, :]) == 0
        if b1[0] == b2[0]:
            allowed &= g[left][:, None] < g[right][None, :]
        i, j = colliding_pairs(unit[left], unit[right], allowed, threshold)
        i, j = left[i], right[j]
        close = np.zeros(len(i), dtype=bool)
        for at in range(0, len(i), 1 << 16):
            part = slice(at, at + (1 << 16))
            dots = np.einsum("ij,ij->i", x[i[part]], x[j[part]])
            norms = np.linalg.norm(x[i[part]], axis=1) * np.linalg.norm(x[j[part]], axis=1)
            close[part] = dots / norms >= threshold
        i, j = i[close], j[close]
        links = np.bincount(i, weights=copies[j], minlength=len(g)) + np.bincount(j, weights=copies[i], minlength=len(g))
        linked = np.flatnonzero(links)
        nodes, roots = local_stars(g[i], g[j]) if len(i) else (g[:0], g[:0])
        root_of = dict(zip(nodes.tolist(), roots.tolist()))
        return pa.table(
            {
                "node": g[linked], "links": links[linked].astype(np.int64),
                "root": pa.array([root_of.get(n) for n in g[linked].tolist()], pa.int64()),
            }
        )

    return run


def _usable(vector: Column) -> Column:
    """Not null, not zero, all components finite."""
    finite = F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return vector.isNotNull() & finite & F.exists(vector, lambda v: v != 0)


def embedding_groups(vectors: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``vec_id``, ``n_links``, ``component_id`` and ``kept`` of every row.

    Vectors link when their labels are equal and not null, their lengths are equal and their
    cosine is ``threshold`` or more. Vectors that are null, empty, zero or hold a null or
    non-finite component link with nothing. Equal vectors collapse before anything is compared;
    repeated rows count as vectors of their own. A null vec_id keeps its row and counts for no
    component. Cells larger than a block are compared block by block, each pair in one task. An
    empty table gives an empty result; other columns are ignored.
    """
    rows = vectors.select("vec_id", F.col("label").cast("int").alias("label"), F.col("embedding").cast("array<double>").alias("embedding"))
    usable = F.coalesce(F.col("label").isNotNull() & _usable(F.col("embedding")), F.lit(False))
    rows = stage(rows.select("vec_id", "label", F.when(usable, F.col("embedding")).alias("embedding")), "vectors")
    good = rows.where("embedding IS NOT NULL")
    groups = good.groupBy("label", "embedding").agg(F.min("vec_id").alias("first"), F.count("*").alias("copies"))
    groups = stage(groups.withColumn("g", F.monotonically_increasing_id()), "distinct")
    placed = groups.select("g", "label", "copies", "embedding").mapInArrow(_cells(threshold), _CELL)
    cell = ["label", "size", "cell"]
    sizes = placed.groupBy(*cell).agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    blocked = placed.join(sizes, cell).withColumn("block", F.pmod(F.xxhash64("g"), "blocks").cast("int"))
    paired = blocked.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        *cell, F.least("block", "other").alias("b1"), F.greatest("block", "other").alias("b2"),
        "block", "g", "halo", "copies", "embedding",
    )
    # Dealt by pair of blocks as well: otherwise all blocks of a large cell stay in its task.
    paired = paired.repartition(*cell, "b1", "b2")
    found = stage(
        paired.groupBy(*cell, "b1", "b2").applyInArrow(_compare(threshold), "node long, links long, root long"), "collisions"
    )
    roots = components(found.where("root IS NOT NULL").select("node", "root"), "node", "root")
    links = found.groupBy(F.col("node").alias("g")).agg(F.sum("links").alias("links"))
    named = groups.join(roots.withColumnRenamed("node", "g"), "g", "left").join(links, "g", "left").select(
        "label", "embedding", "first", F.coalesce("component", "g").alias("root"),
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
    )
    named = stage(named, "named")
    least = named.groupBy("root").agg(F.min("first").alias("component_id"))
    wanted = named.join(least, "root").select("label", "embedding", "n_links", "component_id")
    linked = good.join(wanted, ["label", "embedding"]).select("vec_id", "n_links", "component_id")
    alone = rows.where("embedding IS NULL").select("vec_id", F.lit(0).cast("long"), "vec_id")
    return linked.union(alone).select("*", F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept"))
