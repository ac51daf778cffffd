"""Mixing sources to target weights by proportionate-fair scheduling of document blocks.

Every document gets a slot, in phases: sources with documents left share a phase by their target
weights, until the next of them runs out. In a phase the documents of a source, in a fixed random
order, are cut into blocks. Time runs in slots of one block. Block k of a source with share w may start at slot floor(k / w) and
must be done by ceil((k + 1) / w). Earliest deadline first meets every deadline, since the
shares add up to one; so after any number of slots each source is less than one block away from
its share. Shares are whole parts of ``RESOLUTION``: the schedule repeats after that many slots,
so it is computed once for one period of a phase, and every document finds its slot on its own.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tidemark.session import stage

#: Documents in a block, on average.
BLOCK = 64
#: Slots of a period at least; with many sources four for each.
RESOLUTION = 1024
#: Phases that are planned in one row.
PART = 16

_PLAN = "_key string, _phase long, quota long, start long, n long, units long, rounds long, period long, slots array<long>"


def quotas(supply: list[int], weights: list[float], total: int) -> list[int]:
    """Documents to take of each source: in proportion to the weights, at most what there is.

    What a short source can't give, the others make up in proportion.
    """
    out = [0] * len(supply)
    left, mass = float(total), sum(weights)
    order = sorted(range(len(supply)), key=lambda i: supply[i] / weights[i] if weights[i] else math.inf)
    for i in order:
        out[i] = min(supply[i], math.floor(left * weights[i] / mass + 1e-9)) if weights[i] else 0
        left -= out[i]
        mass -= weights[i]
    return out


def shares(sizes: list[int], period: int) -> list[int]:
    """Whole parts of ``period`` in proportion to ``sizes``, one at least; largest remainders first."""
    spare, total = period - len(sizes), sum(sizes)
    exact = [spare * size / total for size in sizes]
    units = [1 + math.floor(x) for x in exact]
    by_rest = sorted(range(len(sizes)), key=lambda i: (math.floor(exact[i]) - exact[i], i))
    for i in by_rest[: period - sum(units)]:
        units[i] += 1
    return units


def window_of(k: int, units: int, period: int) -> tuple[int, int]:
    """Release and deadline of block ``k`` of a source with ``units`` of ``period`` slots."""
    return k * period // units, -(-(k + 1) * period // units)


def schedule(units: list[int]) -> list[list[int]]:
    """Slots of each source's blocks over one period, earliest deadline first."""
    period = sum(units)
    slots: list[list[int]] = [[] for _ in units]
    waiting: list[list[int]] = [[] for _ in range(period)]
    for source in range(len(units)):
        waiting[0].append(source)
    ready: list[tuple[int, int]] = []
    for slot in range(period):
        for source in waiting[slot]:
            heapq.heappush(ready, (window_of(len(slots[source]), units[source], period)[1], source))
        deadline, source = heapq.heappop(ready)
        assert slot < deadline
        slots[source].append(slot)
        if len(slots[source]) < units[source]:
            release = window_of(len(slots[source]), units[source], period)[0]
            waiting[max(release, slot + 1)].append(source)
    return slots


def phase_ends(supply: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Documents per weight at which a source runs out: the end of each phase, one for every such point."""
    return np.unique(supply[weights > 0] / weights[weights > 0])


def given_until(supply: np.ndarray, weights: np.ndarray, end: float) -> np.ndarray:
    """Documents that each source has given when a phase ends."""
    part = np.minimum(supply, np.floor(weights * end + 1e-9).astype(np.int64))
    # Compared with the same quotients as the ends, so that no last document is left to rounding.
    return np.where(weights > 0, np.where(_over(supply, weights) <= end, supply, part), 0)


def _over(supply: np.ndarray, weights: np.ndarray) -> np.ndarray:
    return np.divide(supply, weights, out=np.zeros(len(supply)), where=weights > 0)


def phases(
    supply: np.ndarray, weights: np.ndarray, first: int = 0, most: int | None = None
) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Of ``most`` phases from ``first`` on: number, documents given before and in it, and exact shares, per source.

    Sources give in proportion to their weights until one has no more; the others go on. A phase
    depends on its two ends only, so any range of phases can be planned on its own.
    """
    ends = phase_ends(supply, weights)
    if first >= len(ends):
        return
    until = _over(supply, weights)
    before = ends[first - 1] if first else 0.0
    done = given_until(supply, weights, before) if first else np.zeros(len(supply), dtype=np.int64)
    for number in range(first, len(ends) if most is None else min(len(ends), first + most)):
        end = ends[number]
        now = given_until(supply, weights, end)
        yield number, done, now - done, weights * np.maximum(0.0, np.minimum(end, until) - before)
        done, before = now, end


def _planner(weights: Mapping[str, float] | None, budget: float | None, block: int, resolution: int):
    """Plans of the phases of each part: rows of ``part`` and all ``sources``."""

    def planned(part: int, rows: list[dict]) -> Iterator[pa.RecordBatch]:
        keys = pa.array([row["_key"] for row in rows], type=pa.string())
        supply = np.array([row["n"] for row in rows], dtype=np.int64)
        wanted = np.array([1.0 if weights is None else float(weights.get(row["source"], 0.0)) for row in rows])
        if budget is None:
            quota, plan = np.where(wanted > 0, supply, 0), phases(supply, wanted, part * PART, PART)
        else:
            quota = np.array(quotas(supply.tolist(), wanted.tolist(), math.ceil(budget * int(supply.sum()))), dtype=np.int64)
            plan = [(0, np.zeros_like(quota), quota, quota)] if part == 0 else []
        for number, start, given, exact in plan:
            own = np.flatnonzero(given)
            if not len(own):
                continue
            period = max(resolution, 4 * len(own))
            units = shares(exact[own].tolist(), period)
            rounds = max(1, -(-int(given.sum()) // (period * block)))
            n = len(own)
            columns = [[number] * n, quota[own], start[own], given[own], units, [rounds] * n, [period] * n]
            yield pa.RecordBatch.from_arrays(
                [keys.take(pa.array(own)), *[pa.array(c, type=pa.int64()) for c in columns], pa.array(schedule(units), type=pa.list_(pa.int64()))],
                ["_key", "_phase", "quota", "start", "n", "units", "rounds", "period", "slots"],
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                yield from planned(row["part"], row["sources"])

    return run


def _plan(supply: DataFrame, weights: Mapping[str, float] | None, budget: float | None, block: int, resolution: int) -> DataFrame:
    """A row per source and phase in which it gives documents, from one row per source.

    The list of sources goes to each part of the phases, and the parts are planned side by side. A source is
    in a phase only if it gives a document there, so there are no more rows than documents.
    """
    known = supply.groupBy().agg(F.sort_array(F.collect_list(F.struct("_key", "source", "n"))).alias("sources")).where("size(sources) > 0")
    parts = known.select(F.explode(F.expr(f"sequence(0, (size(sources) - 1) div {PART})")).alias("part"), "sources")
    plan = stage(parts.repartition("part").mapInArrow(_planner(weights, budget, block, resolution), _PLAN), "mix")
    # One row per phase, of which there are no more than sources.
    spans = plan.groupBy("_phase").agg(F.first(F.expr("period * rounds")).alias("_span"))
    earlier = Window.orderBy("_phase").rowsBetween(Window.unboundedPreceding, -1)
    first = spans.select("_phase", F.coalesce(F.sum("_span").over(earlier), F.lit(0)).alias("first_slot"))
    own = Window.partitionBy("_key").orderBy("_phase").rowsBetween(Window.unboundedPreceding, -1)
    blocks = F.coalesce(F.sum(F.expr("units * rounds")).over(own), F.lit(0))
    return stage(plan.join(first, "_phase").withColumn("first_block", blocks), "mix")


def _keyed(docs: DataFrame) -> DataFrame:
    """With ``_key`` (null and empty sources apart), ``_hash`` of the doc_id, and its upper bits."""
    return docs.select(
        "*", F.coalesce(F.concat(F.lit("="), "source"), F.lit("")).alias("_key"), F.xxhash64("doc_id").alias("_hash")
    ).withColumn("_bucket", F.shiftright("_hash", 52))


def _placed(
    docs: DataFrame, weights: Mapping[str, float] | None, budget: float | None, block: int, resolution: int, *more: str
) -> DataFrame:
    """``mixture`` of ``docs``, whose columns are doc_id, source and ``more``, all kept."""
    keyed = _keyed(docs)
    counts = stage(
        _keyed(docs.select("doc_id", "source")).groupBy("_key", "_bucket")
        .agg(F.first("source").alias("source"), F.count("*").alias("n")), "mix",
    )
    before = Window.partitionBy("_key").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_key", "_bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_before"))
    # One row per source.
    plan = _plan(counts.groupBy("_key").agg(F.first("source").alias("source"), F.sum("n").alias("n")), weights, budget, block, resolution)
    # The phases of a range of places: the one its first place is in, and those that start within it.
    nothing = F.lit(None).cast("long")
    spots = offsets.select("_key", F.col("_before").alias("at"), F.lit(1).alias("kind"), "_bucket", nothing.alias("phase")).union(
        plan.select("_key", "start", F.lit(0), nothing, "_phase")
    )
    so_far = Window.partitionBy("_key").orderBy("at", "kind").rowsBetween(Window.unboundedPreceding, 0)
    spots = spots.select(
        "_key", "at", "kind", F.last("_bucket", True).over(so_far).alias("_bucket"), F.last("phase", True).over(so_far).alias("phase")
    )
    ranges = spots.groupBy("_key", "_bucket").agg(
        F.max(F.when(F.col("kind") == 1, F.col("at"))).alias("_before"), F.sort_array(F.collect_list(F.struct("at", "phase"))).alias("_starts")
    )
    own = Window.partitionBy("_key", "_bucket").orderBy("_hash", "doc_id")
    # Ranges grow with the sources: they meet the documents where the window has put them, and are never broadcast.
    ranked = keyed.withColumn("_place", F.row_number().over(own) - 1).join(ranges.hint("merge"), ["_key", "_bucket"])
    rank = (F.col("_before") + F.col("_place")).cast("long")
    ranked = ranked.select("doc_id", "source", *more, "_key", rank.alias("rank"), "_starts")
    phase = F.get("_starts", F.size(F.filter("_starts", lambda s: s.getField("at") <= F.col("rank"))) - 1).getField("phase")
    ranked = ranked.select("doc_id", "source", *more, "_key", "rank", phase.alias("_phase"))
    joined = ranked.join(plan.where("quota > 0"), ["_key", "_phase"], "left")
    kept = F.coalesce(F.col("rank") < F.col("quota"), F.lit(False))
    placed = joined.select(
        "doc_id", "source", *more, "rank", kept.alias("kept"), "units", "period", "slots", "first_block", "first_slot",
        F.when(kept, F.expr("(rank - start) * (units * rounds) div n")).alias("_number"),
    )
    k, start = F.expr("_number % units"), F.expr("first_slot + (_number div units) * period")
    return placed.select(
        "doc_id", "source", *more, "rank", (F.col("first_block") + F.col("_number")).alias("block"),
        (start + F.get("slots", k)).alias("slot"),
        (start + F.expr("(_number % units) * period div units")).alias("release"),
        (start + F.expr("((_number % units + 1) * period + units - 1) div units")).alias("deadline"),
        "kept",
    )


def mixture(
    docs: DataFrame,
    weights: Mapping[str, float] | None = None,
    budget: float | None = None,
    block: int = BLOCK,
    resolution: int = RESOLUTION,
) -> DataFrame:
    """A row per document: ``doc_id``, ``source``, ``rank``, ``block``, ``slot``, ``release``,
    ``deadline`` and ``kept``.

    ``weights`` are the target weights of the sources (none: equal ones; a source that is not
    listed has weight zero). Without a ``budget`` every document of a source with a weight is
    kept: in each phase the sources that have documents left hold their weights' shares, and when
    one runs out the others share its part. With a ``budget`` the mix takes that share of all
    documents in a single phase; sources too short for their part give all they have, and
    documents beyond their source's quota are not kept. Block, slot, release and deadline are null
    for documents not kept. Read the kept ones by ``slot``.

    ``rank`` orders the documents of a source by a hash of the doc_id. It is counted within
    4,096 hash ranges of the source and added up over them, so that no task holds a whole
    source. A null source is a source of its own, with weights listed under ``None``; repeated
    rows and null ids each take a place; texts are not read; an empty table gives an empty result.
    """
    return _placed(docs.select("doc_id", "source"), weights, budget, block, resolution)


def mixed(
    docs: DataFrame,
    weights: Mapping[str, float] | None = None,
    budget: float | None = None,
    block: int = BLOCK,
    resolution: int = RESOLUTION,
) -> DataFrame:
    """The rows of ``docs`` that the mixture keeps, in the order of their slots, all columns unchanged."""
    whole = docs.select("doc_id", "source", F.struct(*[docs[name] for name in docs.columns]).alias("_doc"))
    rows = _placed(whole, weights, budget, block, resolution, "_doc").where("kept").orderBy("slot", "rank")
    return rows.select(*[F.col("_doc").getField(name).alias(name) for name in docs.columns])
