"""Prefix trie of conversations by union-find over sorted neighbours.

A conversation is the sequence of its turns' digests. Sorted by that sequence, the members of a trie node are
neighbours, and the longest common prefix (LCP) of two neighbours is the depth at which they part. A task takes
a range of the order and joins neighbours over their LCP edges in descending depth, as in
Kruskal's algorithm: each set of joined neighbours is a node, each merge of two sets makes a branching one. Nodes
on the path to the first or the last sequence of a range may have members in the next range. They
alone are left over: each range is contracted to these two paths, and paths of neighbouring ranges are merged, many at a
time, until one forest is left. Equal conversations are one sequence with a list of ends.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import small_batches, words_of
from tidemark.session import stage

#: Turns that a range of sequences has on average, where more ranges than the session's partitions are needed.
RANGE = 2_000_000
#: Ranges whose paths are merged in one task.
FAN = 256
#: Ids that are joined to one text before the digest of a long list of ends is taken.
ENDS = 4096
WIDTH = 16
NO_ENDS = hashlib.sha256(b"").hexdigest()

NODE = (
    "pid int, id binary, parent binary, depth int, first long, n_convs long, n_children long, n_leaves long, "
    "saved long, words long, ends string, left boolean, right boolean, parent_first long"
)
_SCHEMA = pa.schema(
    [("pid", pa.int32()), ("id", pa.binary()), ("parent", pa.binary()), ("depth", pa.int32())]
    + [(c, pa.int64()) for c in ("first", "n_convs", "n_children", "n_leaves", "saved", "words")]
    + [("ends", pa.string()), ("left", pa.bool_()), ("right", pa.bool_()), ("parent_first", pa.int64())]
)

# ---------------------------------------------------------------- conversations


def sequences(turns: DataFrame) -> DataFrame:
    """``conv_id`` and ``turns``, its turns in order, each with ``digest`` and ``words``.

    Turns of one conversation with the same number are ordered by their digest, null numbers come first. Null
    roles and texts count as empty. Rows without a conv_id belong to no conversation.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)
    one = F.struct(
        F.col("turn").alias("turn"), F.substring(digest, 1, 2 * WIDTH).alias("digest"),
        F.size(words_of(text)).alias("words"),
    )
    kept = turns.where("conv_id IS NOT NULL").select(F.col("conv_id").cast("long").alias("conv_id"), one.alias("one"))
    return kept.groupBy("conv_id").agg(
        F.transform(F.sort_array(F.collect_list("one")), lambda t: F.struct(t["digest"], t["words"])).alias("turns")
    )


def rebuilt(turns: DataFrame, every: int = 20, most: int = 4) -> DataFrame:
    """``sequences`` whose first ``h`` turns are those of the conversation ``conv_id - conv_id % every``.

    ``h`` is the crc32 of the decimal id modulo ``most``. Conversations without such a one have their own turns
    after the first ``h`` only.
    """
    own = sequences(turns)
    donor = F.col("conv_id") - F.col("conv_id") % every
    heads = own.where(F.col("conv_id") % every == 0).select(
        F.col("conv_id").alias("donor"), F.slice("turns", 1, most - 1).alias("head")
    )
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).cast("int")
    joined = own.withColumn("donor", donor).join(heads, "donor", "left")
    rest = F.slice("turns", h + 1, F.greatest(F.size("turns") - h, F.lit(0)))
    head = F.when(F.col("head").isNotNull() & (h > 0), F.slice("head", 1, F.greatest(h, F.lit(1))))
    none = F.slice("turns", 1, 0)
    return joined.select("conv_id", F.concat(F.coalesce(head, none), F.coalesce(rest, none)).alias("turns"))


# ---------------------------------------------------------------- equal sequences


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Neighbouring ids of one sequence as texts of at most ``ENDS`` ids."""
    for batch in batches:
        kids = np.array(batch.column("kid").to_pylist(), dtype=f"S{WIDTH * 2}")
        ids = batch.column("conv_id").to_numpy()
        cut = np.flatnonzero(kids[1:] != kids[:-1]) + 1
        edges = [0, *cut.tolist(), len(ids)] if len(ids) else [0]
        places = [p for a, b in zip(edges, edges[1:]) for p in range(a, b, ENDS)] + [len(ids)]
        texts = [",".join(map(str, ids[a:b].tolist())) for a, b in zip(places, places[1:])]
        at = np.array(places[:-1], dtype=np.int64)
        yield pa.RecordBatch.from_arrays(
            [batch.column("kid").take(pa.array(at)), pa.array(ids[at]), pa.array(np.diff(places)), pa.array(texts, pa.string())],
            ["kid", "first", "n", "ids"],
        )


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per sequence; its chunks follow each other in the order of the ids, and only a hash state is kept."""
    kid, first, n, state, done = None, 0, 0, None, []
    for batch in batches:
        for k, f, m, ids in zip(*(batch.column(c).to_pylist() for c in ("kid", "first", "n", "ids"))):
            if k != kid:
                if kid is not None:
                    done.append((first, n, state.hexdigest()))
                kid, first, n, state = k, f, m, hashlib.sha256(ids.encode())
            else:
                n += m
                state.update(b"," + ids.encode())
        yield _ends(done)
        done = []
    yield _ends(done + ([(first, n, state.hexdigest())] if kid is not None else []))


def _ends(done: list[tuple]) -> pa.RecordBatch:
    first, n, ends = zip(*done) if done else ((), (), ())
    return pa.RecordBatch.from_arrays(
        [pa.array(first, pa.int64()), pa.array(n, pa.int64()), pa.array(ends, pa.string())], ["first", "n", "ends"]
    )


def distinct_sequences(convs: DataFrame) -> DataFrame:
    """``key``, ``words``, ``first`` (smallest id), ``n`` and ``ends`` of every different sequence.

    ``convs`` has ``conv_id``, ``kid`` (the name of the sequence), ``key`` and ``words``. Ids are sorted
    over all tasks by name and id, so a sequence that many conversations share is dealt over several; they
    send texts of many ids each, and the digest of the whole list runs over those texts.
    """
    parts = int(convs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    named = convs.select("kid", "conv_id").repartitionByRange(parts, "kid", "conv_id")
    chunks = named.sortWithinPartitions("kid", "conv_id").mapInArrow(_chunks, "kid string, first long, n long, ids string")
    ends = chunks.repartition(parts, "kid").sortWithinPartitions("kid", "first").mapInArrow(
        _digests, "first long, n long, ends string"
    )
    return convs.select("conv_id", "key", "words").join(ends, F.col("conv_id") == F.col("first")).drop("conv_id")


# ---------------------------------------------------------------- forests


def _path_ids(key: bytes) -> list[bytes]:
    """Names of all prefixes of a sequence, the root first: each from the one before and the turn's digest."""
    names = [b"\0" * WIDTH]
    for at in range(0, len(key), WIDTH):
        names.append(hashlib.sha256(names[-1] + key[at : at + WIDTH]).digest()[:WIDTH])
    return names


def _common(a: bytes, b: bytes) -> int:
    """Turns at the start of both sequences that are the same."""
    n = min(len(a), len(b)) // WIDTH * WIDTH
    x, y = (np.frombuffer(s[:n], dtype=np.uint8).reshape(-1, WIDTH) for s in (a, b))
    same = (x == y).all(axis=1)
    return len(same) if same.all() else int(np.argmin(same))


def range_forest(
    keys: list[bytes], words: np.ndarray, starts: np.ndarray, first: np.ndarray, n: np.ndarray, ends: list[str], pid: int
) -> Iterator[pa.RecordBatch]:
    """Nodes of one sorted range of different sequences, the deepest first.

    ``words`` holds the words of all turns, ``starts`` where those of each sequence begin. Nodes on the paths to the
    first and the last sequence are open: they carry what their closed children add up to.
    """
    lengths = np.array([len(k) // WIDTH for k in keys])
    edges = np.array([_common(a, b) for a, b in zip(keys, keys[1:])] + [-1])
    paths = [_path_ids(keys[0]), _path_ids(keys[-1])]
    by_length = np.argsort(lengths, kind="stable")
    from_length = np.searchsorted(lengths[by_length], np.arange(lengths.max() + 2))
    # Sets of joined neighbours that reach the depth, in order: where they begin and end, and their sums.
    names = ["begin", "end", "first", "n_convs", "n_leaves", "saved"]
    sets = {c: np.zeros(0, dtype=np.int64) for c in names}
    for depth in range(int(lengths.max()), -1, -1):
        own = np.sort(by_length[from_length[depth] : from_length[depth + 1]])
        new = {"begin": own, "end": own, "first": first[own], "n_convs": n[own], "n_leaves": 0 * own, "saved": 0 * own}
        order = np.argsort(np.concatenate([sets["begin"], own]), kind="stable")
        child = (np.arange(len(order)) < len(sets["begin"]))[order]
        part = {c: np.concatenate([sets[c], new[c]])[order] for c in names}
        # An edge of this depth joins the set before it to the set behind it.
        joined = (part["begin"][1:] == part["end"][:-1] + 1) & (edges[part["end"][:-1]] >= depth)
        head = np.flatnonzero(np.append(True, ~joined))
        open_child = child & ((part["begin"] == 0) | (part["end"] == len(keys) - 1))
        closed = child & ~open_child
        node = {
            "begin": part["begin"][head], "end": part["end"][np.append(head[1:], len(order)) - 1],
            "first": np.minimum.reduceat(part["first"], head), "n_convs": np.add.reduceat(part["n_convs"], head),
            "n_leaves": np.add.reduceat(np.where(closed, part["n_leaves"], 0), head),
            "saved": np.add.reduceat(np.where(closed, part["saved"], 0), head),
        }
        children = np.add.reduceat(closed.astype(np.int64), head)
        left, right = node["begin"] == 0, node["end"] == len(keys) - 1
        is_open = left | right
        word = words[starts[node["begin"]] + depth - 1] if depth else np.zeros(len(head), dtype=np.int64)
        if sets["begin"].size:
            # The children's parents are known now.
            yield _child_rows(level, np.repeat(np.arange(len(head)), np.diff(np.append(head, len(order))))[child], node["first"], is_open, left, paths, depth, pid)
        node["n_leaves"] = np.where(is_open, node["n_leaves"], np.maximum(node["n_leaves"], 1))
        node["saved"] = np.where(is_open, node["saved"], node["saved"] + (node["n_convs"] - 1) * word)
        end_at = np.full(len(head), -1)
        ending = np.flatnonzero(~child)
        end_at[np.searchsorted(head, ending, side="right") - 1] = part["begin"][ending]
        level = node | {
            "depth": depth, "children": children, "words": word, "left": left, "right": right,
            "ends": [ends[i] if i >= 0 else None for i in end_at.tolist()],
        }
        sets = {c: node[c] for c in names}
    yield _child_rows(level, np.zeros(1, dtype=np.int64), np.zeros(1, dtype=np.int64), np.ones(1, dtype=bool), None, paths, -1, pid)


def _child_rows(level, parents, parent_first, parent_open, parent_left, paths, parent_depth, pid) -> pa.RecordBatch:
    """Rows of all nodes of a depth, now that the nodes above them are known."""
    n, depth = len(parents), parent_depth + 1
    left, right = level["left"], level["right"]
    id_ = [None] * n
    for i in np.flatnonzero(left | right).tolist():
        id_[i] = paths[0][depth] if left[i] else paths[1][depth]
    parent = [None] * n
    if depth:
        for i in np.flatnonzero(parent_open[parents]).tolist():
            parent[i] = paths[0][parent_depth] if parent_left[parents[i]] else paths[1][parent_depth]
    known = pa.array(parent_first[parents], mask=parent_open[parents])
    columns = [
        pa.array(np.full(n, pid, dtype=np.int32)), pa.array(id_, pa.binary()), pa.array(parent, pa.binary()),
        pa.array(np.full(n, depth, dtype=np.int32)), *(pa.array(level[c]) for c in ("first", "n_convs", "children", "n_leaves", "saved", "words")),
        pa.array(level["ends"], pa.string()), pa.array(left), pa.array(right), known,
    ]
    return pa.RecordBatch.from_arrays(columns, schema=_SCHEMA)


def _forests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    whole = [batch for batch in batches if batch.num_rows]
    if not whole:
        return
    table = pa.Table.from_batches(whole)
    words = table.column("words").combine_chunks()
    lengths = np.asarray(words.value_lengths())
    yield from range_forest(
        table.column("key").to_pylist(), words.flatten().to_numpy().astype(np.int64), np.cumsum(lengths) - lengths,
        table.column("first").to_numpy(), table.column("n").to_numpy(), table.column("ends").to_pylist(),
        TaskContext.get().partitionId(),
    )


def _merged(final: bool):
    """Merge the open paths of neighbouring ranges: sum up equal nodes, close those that end inside."""

    def run(table: pa.Table) -> pa.Table:
        pid = table.column("pid").to_numpy()
        raw = np.frombuffer(b"".join(table.column("id").to_pylist()), dtype=">u8").reshape(-1, 2)
        _, rows, node = np.unique(raw, axis=0, return_index=True, return_inverse=True)
        node, m = node.ravel(), len(rows)
        columns = {c: table.column(c).to_numpy() for c in ("first", "n_convs", "n_children", "n_leaves", "saved")}
        depth, word = table.column("depth").to_numpy()[rows], table.column("words").to_numpy()[rows]
        total = {c: np.zeros(m, dtype=np.int64) for c in columns}
        for c in ("n_convs", "n_children", "n_leaves", "saved"):
            np.add.at(total[c], node, columns[c])
        total["first"] = np.full(m, np.iinfo(np.int64).max)
        np.minimum.at(total["first"], node, columns["first"])
        ends = [None] * m
        for at, text in zip(node.tolist(), table.column("ends").to_pylist()):
            ends[at] = text or ends[at]
        left, right = np.zeros(m, dtype=bool), np.zeros(m, dtype=bool)
        if not final:
            flag = {c: table.column(c).to_numpy(zero_copy_only=False) for c in ("left", "right")}
            left[node[flag["left"] & (pid == pid.min())]] = True
            right[node[flag["right"] & (pid == pid.max())]] = True
        is_open = left | right
        names = table.column("id").take(pa.array(rows)).to_pylist()
        above = table.column("parent").take(pa.array(rows)).to_pylist()
        place = {name: i for i, name in enumerate(names)}
        parent = np.array([place.get(p, -1) if p is not None else -1 for p in above])
        for d in range(int(depth.max()), -1, -1):
            here = np.flatnonzero((depth == d) & ~is_open)
            total["n_leaves"][here] = np.maximum(total["n_leaves"][here], 1)
            total["saved"][here] += (total["n_convs"][here] - 1) * word[here]
            inner = here[parent[here] >= 0]
            for c, by in (("n_children", 1), ("n_leaves", total["n_leaves"][inner]), ("saved", total["saved"][inner])):
                np.add.at(total[c], parent[inner], by)
        columns = [
            pa.array((pid[rows] // FAN).astype(np.int32)), pa.array(names, pa.binary()), pa.array(above, pa.binary()), pa.array(depth),
            *(pa.array(total[c]) for c in ("first", "n_convs", "n_children", "n_leaves", "saved")), pa.array(word),
            pa.array(ends, pa.string()), pa.array(left), pa.array(right), pa.nulls(m, pa.int64()),
        ]
        return pa.table(columns, schema=_SCHEMA)

    return run


def prefix_trie(convs: DataFrame) -> DataFrame:
    """One row per node of the trie of ``convs``, which has ``conv_id`` (one row each) and ``turns``.

    Returned are ``conv_id`` (smallest member), ``depth``, ``parent_conv_id`` (null for the root), ``n_convs``,
    ``n_children``, ``n_leaves`` (childless nodes in the subtree), ``saved_tokens`` (words of last turns that
    others than the first member share, summed over the subtree) and ``ends_sha256`` of the ids of members that end in the node.
    Conversations without turns are members of the root alone. No conversations, no nodes. A turn is
    known by 128 bits of a SHA-256; a conversation's digests are one row, as a document's text is.
    """
    spark = convs.sparkSession
    text = F.array_join(F.transform("turns", lambda t: t["digest"]), "")
    rows = stage(
        convs.select(
            "conv_id", F.substring(F.sha2(text, 256), 1, 2 * WIDTH).alias("kid"), F.unhex(text).alias("key"),
            F.transform("turns", lambda t: t["words"]).alias("words"),
        ),
        "conversations",
    )
    distinct = stage(distinct_sequences(rows), "sequences")
    turns = distinct.agg(F.sum(F.size("words"))).first()[0] or 0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-turns // RANGE))
    ordered = small_batches(distinct).repartitionByRange(parts, "key").sortWithinPartitions("key")
    nodes = stage(ordered.mapInArrow(_forests, NODE), "nodes")
    paths = nodes.where("id IS NOT NULL")
    closed, ranges = [], parts
    while True:
        final = ranges <= FAN
        group = (F.col("pid") / FAN).cast("int")
        paths = stage(paths.groupBy(group.alias("range")).applyInArrow(_merged(final), NODE), "paths")
        closed.append(paths.where("NOT left AND NOT right"))
        if final:
            break
        paths, ranges = paths.where("left OR right"), -(-ranges // FAN)
    merged = closed[0]
    for more in closed[1:]:
        merged = merged.union(more)
    named = merged.select(F.col("id").alias("parent"), F.col("first").alias("above"))
    # Each range gets the names on its own paths, so that children of one node are dealt by range.
    on_paths = nodes.where("id IS NOT NULL").select("pid", F.col("id").alias("parent")).distinct()
    inside = nodes.where("id IS NULL")
    found = inside.where("parent IS NULL").withColumn("above", F.col("parent_first")).union(
        inside.where("parent IS NOT NULL").join(on_paths.join(named, "parent"), ["pid", "parent"]).select(*inside.columns, "above")
    ).union(merged.join(named, "parent", "left").select(*inside.columns, "above"))
    return found.select(
        F.col("first").alias("conv_id"), F.col("depth").cast("long").alias("depth"), F.col("above").alias("parent_conv_id"),
        "n_convs", "n_children", "n_leaves", F.col("saved").alias("saved_tokens"),
        F.coalesce("ends", F.lit(NO_ENDS)).alias("ends_sha256"),
    )
