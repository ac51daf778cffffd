"""Exact removal of repeated substrings with suffix arrays.

A byte goes if a string of ``SPAN`` bytes that covers it also starts in a document with a smaller
id. Suffix arrays of the whole corpus would have to move every suffix; here most of it is left
out first, without losing a match. Each string of ``SPAN`` bytes has an anchor, the ``GRAM``
bytes within it whose hash is smallest; equal strings have equal anchors. Neighbouring strings
with one anchor form a run. Blocks of documents ask the parts of the key space (see ``packed``)

1. which anchors occur in more than one document,
2. for those, which document has each run first, and whether the anchor has different runs,
3. for different runs of one anchor, in which document each of their strings occurs first.

Only the last step needs texts, each different run once. A part cuts them into shards of bounded
size and builds a suffix array of each by Larsson-Sadakane refinement, Kasai's common prefixes
tell equal strings, and the shards' sorted strings are merged by binary search.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from contextlib import ExitStack

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import bucketed, document_texts, mix, small_batches, span_hashes, text_bytes
from tidemark.llm.packed import answers, asked, blocks_of, gathered, pack, parts_of, unpack
from tidemark.session import stage, staged

SPAN = 50
GRAM = 24
#: Bytes of text in a block, in a part of the key space, in a chunk of anchors, and in a shard.
BLOCK, PART, CHUNK, SHARD = 4 << 20, 8 << 20, 1 << 20, 1 << 18
_NONE = np.iinfo(np.int64).max
_FACTOR = 0x9E3779B97F4A7C15


# ---------------------------------------------------------------- suffix arrays


def suffix_array(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes of ``data`` in order, a suffix before its extensions, and their ranks.

    Sorted by eight bytes first. Then, as Larsson and Sadakane do, only groups that are still
    equal are sorted again, by the rank of what follows, which doubles the depth each time.
    """
    n = len(data)
    padded = np.concatenate([data, np.zeros(8, dtype=np.uint8)])
    keys = np.zeros(n, dtype=np.uint64)
    for k in range(8):
        keys = keys << np.uint64(8) | padded[k : n + k].astype(np.uint64)
    # Stable from the back: of suffixes that differ in padding only, the shorter comes first.
    order = n - 1 - np.argsort(keys[::-1], kind="stable")
    sizes = np.minimum(n - order, 8)
    new = np.ones(n, dtype=bool)
    new[1:] = (keys[order][1:] != keys[order][:-1]) | (sizes[1:] != sizes[:-1])
    starts = np.flatnonzero(new)
    rank = np.empty(n, dtype=np.int64)
    rank[order] = np.repeat(starts, np.diff(np.append(starts, n)))
    reach = 8
    while True:
        group = rank[order]
        open_ = np.zeros(n, dtype=bool)
        open_[1:] = group[1:] == group[:-1]
        open_[:-1] |= open_[1:]
        places = np.flatnonzero(open_)
        if not len(places):
            return order, rank
        suffixes = order[places]
        after = suffixes + reach
        follow = np.where(after < n, rank[np.minimum(after, n - 1)] + 1, 0)
        both = group[places] << 32 | follow
        again = np.argsort(both, kind="stable")
        both = both[again]
        order[places] = suffixes[again]
        new = np.ones(len(places), dtype=bool)
        new[1:] = both[1:] != both[:-1]
        firsts = np.flatnonzero(new)
        rank[order[places]] = np.repeat(places[firsts], np.diff(np.append(firsts, len(places))))
        reach *= 2


def common_prefixes(data: np.ndarray, order: np.ndarray, depth: int = SPAN, lanes: int = 4096) -> np.ndarray:
    """Common prefix of each suffix with the one sorted before it, up to ``depth``.

    Kasai's walk in text order, where the next prefix is at most one shorter, along many lanes of
    the text at once; bytes are compared eight at a time.
    """
    n = len(data)
    if not n:
        return np.zeros(0, dtype=np.int64)
    padded = np.concatenate([data, np.zeros(depth + 16, dtype=np.uint8)])
    words = np.lib.stride_tricks.sliding_window_view(padded, 8)
    words = np.ascontiguousarray(words).view("<u8").ravel()
    before = np.full(n, -1, dtype=np.int64)
    before[order[1:]] = order[:-1]
    found = np.zeros(n, dtype=np.int64)
    step = -(-n // lanes)
    base = np.arange(0, n, step)
    height = np.zeros(len(base), dtype=np.int64)
    for t in range(step):
        at = base + t
        at = at[at < n]
        height = np.maximum(height[: len(at)] - 1, 0)
        other = before[at]
        height[other < 0] = 0
        todo = np.flatnonzero((other >= 0) & (height < depth))
        while len(todo):
            differ = words[at[todo] + height[todo]] ^ words[other[todo] + height[todo]]
            low = (differ & (~differ + np.uint64(1))) - np.uint64(1)
            height[todo] += np.where(differ == 0, 8, np.bitwise_count(low).astype(np.int64) >> 3)
            todo = todo[(differ == 0) & (height[todo] < depth)]
        height = np.minimum(height, np.minimum(n - at, np.where(other < 0, n, n - other)))
        found[at] = np.minimum(height, depth)
    return found[order]


def first_documents(data: np.ndarray, starts: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct strings (of ``SPAN`` bytes at ``starts``) of a shard in order, the smallest of their
    ``docs``, and which of them each start has."""
    order, _ = suffix_array(data)
    label = np.cumsum(common_prefixes(data, order) < SPAN) - 1
    of_start = np.full(len(data), -1, dtype=np.int64)
    of_start[order] = label
    labels, index = np.unique(of_start[starts], return_inverse=True)
    least = np.full(len(labels), _NONE)
    np.minimum.at(least, index, docs)
    example = np.empty(len(labels), dtype=np.int64)
    example[index] = starts
    windows = np.lib.stride_tricks.sliding_window_view(data, SPAN)
    strings = np.ascontiguousarray(windows[example]).view(f"S{SPAN}").ravel()
    return strings, least, index


def merged_first_documents(shards: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> list[np.ndarray]:
    """The smallest document of each start's string over all shards.

    Shards' strings are sorted; each shard looks its strings up in the merged ones by binary search.
    """
    strings, least = np.zeros(0, dtype=f"S{SPAN}"), np.zeros(0, dtype=np.int64)
    kept = []
    for data, starts, docs in shards:
        own, first, index = first_documents(data, starts, docs)
        place = np.searchsorted(strings, own)
        known = place < len(strings)
        known[known] = strings[place[known]] == own[known]
        least[place[known]] = np.minimum(least[place[known]], first[known])
        least = np.insert(least, place[~known], first[~known])
        strings = np.insert(strings, place[~known], own[~known])
        kept.append((own, index))
    return [least[np.searchsorted(strings, own)][index] for own, index in kept]


# ---------------------------------------------------------------- blocks and their runs


def _gram_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` bytes at each position, by doubling."""
    power = lambda k: np.uint64(pow(_FACTOR, k, 1 << 64))
    step, width = data.astype(np.uint64) + np.uint64(1), 1
    whole, done = None, 0
    while size:
        if size & 1:
            if whole is None:
                whole, done = step, width
            else:
                n = len(whole) - width
                whole = whole[:n] * power(width) + step[done : done + n]
                done += width
        size >>= 1
        if size:
            step = step[:-width] * power(width) + step[width:]
            width *= 2
    return mix(whole)


def runs_of(data: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Length of each run (in strings) and distance from its first string to its anchor.

    Strings are those within documents of the given ``lengths``, in order; the leftmost of equal
    smallest hashes is the anchor.
    """
    if len(data) < SPAN:
        return np.zeros(0, dtype=np.uint8), np.zeros(0, dtype=np.uint8)
    width = SPAN - GRAM + 1
    hashes = _gram_hashes(data, GRAM)
    low = np.uint64((1 << 28) - 1)
    least = hashes & ~low | np.arange(len(hashes), dtype=np.uint64)
    size = 1
    while 2 * size <= width:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    rest = width - size
    least = np.minimum(least[: len(least) - rest], least[rest:]) if rest else least
    starts = string_starts(lengths)
    anchors = (least[starts] & low).astype(np.int64)
    new = np.ones(len(starts), dtype=bool)
    new[1:] = (anchors[1:] != anchors[:-1]) | (np.diff(starts) != 1)
    firsts = np.flatnonzero(new)
    run = np.diff(np.append(firsts, len(starts)))
    return run.astype(np.uint8), (anchors[firsts] - starts[firsts]).astype(np.uint8)


def string_starts(lengths: np.ndarray) -> np.ndarray:
    """Positions where a string of ``SPAN`` bytes starts and ends in one document."""
    counts = np.maximum(lengths - SPAN + 1, 0)
    begins = np.cumsum(lengths) - lengths
    return np.repeat(begins - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())


_BLOCK = (
    "block long, doc_id array<long>, size long, data binary, lengths binary, runs int, run_lengths binary, anchors binary"
)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for block, table in blocks_of(batches, "text", BLOCK):
        data, offsets = text_bytes(table.column("text").combine_chunks())
        lengths = np.diff(offsets)
        run, anchors = runs_of(data, lengths)
        row = [block, table.column("doc_id").to_pylist(), len(data), pack(data), pack(lengths), len(run), pack(run), pack(anchors)]
        types = [pa.int64(), pa.list_(pa.int64()), pa.int64(), *[pa.binary()] * 2, pa.int32(), *[pa.binary()] * 2]
        names = ["block", "doc_id", "size", "data", "lengths", "runs", "run_lengths", "anchors"]
        yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types)], names)


class _Block:
    """Documents and runs of one row of the table of blocks."""

    def __init__(self, row: dict):
        self.block, self.doc_id, n = row["block"], row["doc_id"], row["runs"]
        self.data = unpack(row["data"], row["size"], np.uint8)
        self.lengths = unpack(row["lengths"], len(self.doc_id), np.int64)
        self.docs = np.array([_NONE if d is None else d for d in self.doc_id], dtype=np.int64)
        self.run = unpack(row["run_lengths"], n, np.uint8).astype(np.int64)
        self.starts = string_starts(self.lengths)[np.cumsum(self.run) - self.run] if n else np.zeros(0, dtype=np.int64)
        anchors = self.starts + unpack(row["anchors"], n, np.uint8)
        self.hashes = np.zeros(n, dtype=np.uint64)
        for k in range(GRAM):
            self.hashes = self.hashes * np.uint64(_FACTOR) + self.data[anchors + k] + np.uint64(1)
        self.hashes = mix(self.hashes)
        ends = np.cumsum(self.lengths)
        self.run_docs = self.docs[np.searchsorted(ends, self.starts, side="right")] if n else self.starts

    def anchors(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct anchors, whether documents with different ids have them, and each run's anchor."""
        keys, index = np.unique(self.hashes, return_inverse=True)
        least, most = np.full(len(keys), _NONE), np.full(len(keys), np.iinfo(np.int64).min)
        np.minimum.at(least, index, self.run_docs)
        np.maximum.at(most, index, self.run_docs)
        return keys, (least < most).astype(np.uint8), index


class _Entries:
    """Distinct runs of the anchors that several documents have."""

    def __init__(self, own: _Block, shared: np.ndarray):
        self.own = own
        _, _, index = own.anchors()
        self.runs = np.flatnonzero(shared[index]) if len(index) else index
        starts, lengths = own.starts[self.runs], own.run[self.runs]
        texts = span_hashes(own.data, starts, starts + lengths + SPAN - 1)
        anchors = own.hashes[self.runs]
        order = np.lexsort((texts, anchors))
        new = np.ones(len(order), dtype=bool)
        new[1:] = (anchors[order][1:] != anchors[order][:-1]) | (texts[order][1:] != texts[order][:-1])
        firsts = order[new]
        self.of_run = np.empty(len(order), dtype=np.int64)
        self.of_run[order] = np.cumsum(new) - 1
        self.anchors, self.texts = anchors[firsts], texts[firsts]
        self.starts, self.lengths = starts[firsts], lengths[firsts]
        self.docs = np.full(len(firsts), _NONE)
        np.minimum.at(self.docs, self.of_run, own.run_docs[self.runs])


_ASKED = "part int, block long, n int, keys binary, v0 binary"


def _batch(columns: dict[str, list]) -> pa.Table:
    types = {"part": pa.int32(), "block": pa.int64(), "n": pa.int32()}
    return pa.table({name: pa.array(v, types.get(name, pa.binary())) for name, v in columns.items()})


def _ask_anchors(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                own = _Block(batch.slice(at, 1).to_pylist()[0])
                keys, several, _ = own.anchors()
                yield from _batch(asked(own.block, keys, bits, several)).to_batches()

    return run


def _answered(table: pa.Table, blocks: list[int], borders: np.ndarray, *values: np.ndarray) -> pa.Table:
    cut = lambda v: pa.array([pack(v[a:b]) for a, b in zip(borders[:-1], borders[1:])], pa.binary())
    return pa.table(
        {
            "part": pa.array([table.column("part")[0].as_py()] * len(blocks), pa.int32()),
            "block": pa.array(blocks, pa.int64()), "n": pa.array(np.diff(borders).tolist(), pa.int32()),
            **{f"v{k}": cut(v) for k, v in enumerate(values)},
        }
    )


def _shared(table: pa.Table) -> pa.Table:
    """Whether each anchor asked for occurs in documents with different ids, or in several blocks."""
    blocks, borders, keys, (several,) = gathered(table, np.uint8)
    distinct, index = np.unique(keys, return_inverse=True)
    shared = (np.bincount(index, minlength=len(distinct)) > 1) | (np.bincount(index, weights=several, minlength=len(distinct)) > 0)
    return _answered(table, blocks, borders, shared[index].astype(np.uint8))


def _ask_runs(bits: int):
    def run(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        entries = _Entries(_Block(left.to_pylist()[0]), answers(right, 1, np.uint8))
        return _batch(asked(entries.own.block, entries.anchors, bits, entries.texts, entries.docs))

    return run


def _groups(anchors: np.ndarray, texts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Group of each entry by anchor and text, the first entry of each group, and its anchor's size."""
    order = np.lexsort((texts, anchors))
    new = np.ones(len(order), dtype=bool)
    new[1:] = (anchors[order][1:] != anchors[order][:-1]) | (texts[order][1:] != texts[order][:-1])
    group = np.empty(len(order), dtype=np.int64)
    group[order] = np.cumsum(new) - 1
    firsts = order[new]
    _, of_anchor, sizes = np.unique(anchors[firsts], return_inverse=True, return_counts=True)
    return group, firsts, sizes[of_anchor]


def _first_runs(table: pa.Table) -> pa.Table:
    """The smallest document of each run; 1 if its anchor has other runs, 2 for one block of each run."""
    blocks, borders, anchors, (texts, docs) = gathered(table, np.uint64, np.int64)
    group, firsts, sizes = _groups(anchors, texts)
    least = np.full(len(firsts), _NONE)
    np.minimum.at(least, group, docs)
    flags = (sizes > 1).astype(np.uint8)[group]
    flags[firsts] |= 2
    return _answered(table, blocks, borders, least[group], flags)


def _ask_strings(bits: int):
    def run(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        entries = _Entries(_Block(left.to_pylist()[0]), answers(right, 1, np.uint8))
        least, flags = answers(right, 2, np.int64), answers(right, 2, np.uint8, "v1")
        pick = np.flatnonzero(flags & 1)
        anchors, flags, least, lengths = entries.anchors[pick], flags[pick], least[pick], entries.lengths[pick]
        columns = asked(entries.own.block, anchors, bits, entries.texts[pick], flags, least, lengths.astype(np.uint8))
        columns["text"] = []
        for _, a, b in parts_of(anchors, bits):
            give = pick[a:b][(flags[a:b] & 2) > 0]
            at = _ranges(entries.starts[give], entries.lengths[give] + SPAN - 1)
            columns["text"].append(pack(entries.own.data[at]))
        return _batch(columns)

    return run


def _ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All positions of ranges, one range after the other."""
    return np.repeat(starts - (np.cumsum(lengths) - lengths), lengths) + np.arange(lengths.sum())


def _first_strings(table: pa.Table) -> pa.Table:
    """The smallest document of every string of the runs asked for.

    Equal strings have equal anchors, so the part is worked on some anchors at a time: about
    ``CHUNK`` bytes of text, or one anchor, in shards of ``SHARD`` bytes.
    """
    table = table.sort_by("block")
    blocks, borders, anchors, (texts, flags, docs, lengths) = gathered(table, np.uint64, np.uint8, np.int64, np.uint8)
    lengths = lengths.astype(np.int64)
    group, firsts, _ = _groups(anchors, texts)
    gives = np.flatnonzero(flags & 2)
    sizes = lengths[gives] + SPAN - 1
    per_block = np.diff(np.concatenate([[0], np.cumsum(sizes)])[np.searchsorted(gives, borders)])
    packed = table.column("text").to_pylist()
    data = np.concatenate([unpack(text, int(n), np.uint8) for text, n in zip(packed, per_block)])
    begins = np.cumsum(sizes) - sizes
    # Givers by anchor; the strings of each group's run stand together in that order.
    order = np.argsort(group[gives], kind="stable")
    anchor, ends = anchors[gives[order]], np.cumsum(sizes[order])
    counts = lengths[gives[order]]
    place = np.empty(len(firsts), dtype=np.int64)
    place[group[gives[order]]] = np.cumsum(counts) - counts
    least, at = [], 0
    while at < len(order):
        done = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, done + CHUNK, side="right")))
        to = int(np.searchsorted(anchor, anchor[to - 1], side="right"))
        shards, first = [], at
        while first < to:
            done = ends[first - 1] if first else 0
            last = min(to, max(first + 1, int(np.searchsorted(ends, done + SHARD, side="right"))))
            some = order[first:last]
            own = data[_ranges(begins[some], sizes[some])]
            starts = _ranges(np.cumsum(sizes[some]) - sizes[some], lengths[gives[some]])
            shards.append((own, starts, np.repeat(docs[gives[some]], lengths[gives[some]])))
            first = last
        least += merged_first_documents(shards)
        at = to
    least = np.concatenate(least)
    answer = [pack(least[_ranges(place[group[a:b]], lengths[a:b])]) for a, b in zip(borders[:-1], borders[1:])]
    n = [int(lengths[a:b].sum()) for a, b in zip(borders[:-1], borders[1:])]
    return pa.table(
        {
            "part": pa.array([table.column("part")[0].as_py()] * len(blocks), pa.int32()),
            "block": pa.array(blocks, pa.int64()), "n": pa.array(n, pa.int32()), "v0": pa.array(answer, pa.binary()),
        }
    )


_KEPT = "doc_id long, n_bytes long, spans array<struct<start:long,end:long>>, kept binary"


def _remove(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
    own = _Block(left.to_pylist()[0])
    entries = _Entries(own, answers(right, 1, np.uint8))
    least, flags = answers(right, 2, np.int64), answers(right, 2, np.uint8, "v1")
    apart = (flags & 1).astype(bool)
    strings = answers(right, 3, np.int64)
    # Smallest document of every string of every entry: the run's own, or string by string.
    sizes = entries.lengths
    each = np.repeat(least, sizes)
    each[np.repeat(apart, sizes)] = strings
    place = np.cumsum(sizes) - sizes
    runs, of = entries.runs, entries.of_run
    at = _ranges(own.starts[runs], own.run[runs])
    gone = at[each[_ranges(place[of], own.run[runs])] < np.repeat(own.run_docs[runs], own.run[runs])]
    change = np.zeros(len(own.data) + 1, dtype=np.int32)
    np.add.at(change, gone, 1)
    np.add.at(change, gone + SPAN, -1)
    covered = np.cumsum(change[:-1], dtype=np.int32) > 0
    ends = np.cumsum(own.lengths)
    begins = ends - own.lengths
    edge = np.zeros(len(own.data) + 1, dtype=bool)
    edge[begins] = True
    before = np.concatenate([[False], covered])
    after = np.append(covered, False)
    first = np.flatnonzero(after & (~before | edge))
    last = np.flatnonzero(before & (~after | edge))
    doc = np.searchsorted(ends, first, side="right")
    shift = begins[doc] if len(doc) else doc
    lists = pa.ListArray.from_arrays(
        pa.array(np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=len(ends)))]).astype(np.int32)),
        pa.StructArray.from_arrays([pa.array(first - shift), pa.array(last - shift)], ["start", "end"]),
    )
    kept_sizes = own.lengths - np.add.reduceat(np.append(covered, False), np.minimum(begins, len(covered))) * (own.lengths > 0) if len(ends) else ends
    kept = own.data[~covered].tobytes()
    cuts = np.concatenate([[0], np.cumsum(kept_sizes)]).tolist()
    return pa.table(
        {
            "doc_id": pa.array(own.doc_id, pa.int64()), "n_bytes": own.lengths, "spans": lists,
            "kept": pa.array([kept[a:b] for a, b in zip(cuts[:-1], cuts[1:])], pa.binary()),
        }
    )


def repeats_removed(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``spans`` (removed bytes, end exclusive) and ``kept`` (the others) of every row.

    A byte goes if a string of ``SPAN`` bytes that covers it also starts in a document with a
    smaller id, judged on the input; strings don't cross documents. Null and empty texts have no
    bytes; rows with one doc_id don't remove each other's; a null doc_id counts as larger than any
    other. An empty table gives an empty result; other columns are ignored. Anchors and runs are
    compared by 64-bit hashes.
    """
    texts = document_texts(small_batches(docs))
    size = texts.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    bits = max(0, math.ceil(math.log2(max(1, size / PART))))
    answer = "part int, block long, n int, v0 binary"
    columns, none = ["block", "part", "n", "v0"], F.lit(None).cast("binary")
    with ExitStack() as tables:
        keep = tables.enter_context
        blocks = keep(bucketed(texts.mapInArrow(_read, _BLOCK), "block", max(1, math.ceil(size / BLOCK)), "suffix_blocks"))

        def ask(function, schema: str) -> DataFrame:
            return blocks.groupBy("block").cogroup(known.groupBy("block")).applyInArrow(function, schema)

        anchors = blocks.mapInArrow(_ask_anchors(bits), _ASKED)
        shared = keep(staged(anchors.groupBy("part").applyInArrow(_shared, answer), "suffix-anchors"))
        known = shared.select(*columns, none.alias("v1"), F.lit(1).alias("level"))
        runs = ask(_ask_runs(bits), _ASKED + ", v1 binary")
        first = keep(staged(runs.groupBy("part").applyInArrow(_first_runs, answer + ", v1 binary"), "suffix-runs"))
        known = known.union(first.select(*columns, "v1", F.lit(2)))
        strings = ask(_ask_strings(bits), _ASKED + ", v1 binary, v2 binary, v3 binary, text binary")
        least = keep(staged(strings.groupBy("part").applyInArrow(_first_strings, answer), "suffix-strings"))
        known = known.union(least.select(*columns, none, F.lit(3)))
        return stage(ask(_remove, _KEPT), "suffix-kept")


def repeat_digest(removed: DataFrame) -> DataFrame:
    """Bytes, removed bytes and spans, and a digest of the bytes kept."""
    return removed.select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).cast("long").alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"),
    )
