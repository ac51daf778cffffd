"""SimHash near-duplicates with a covering code: fingerprints meet at the anchors around them.

The anchors are the 4,096 words of the perfect binary Golay code on the lowest 23 bits: every
fingerprint lies within distance 3 of exactly one of them, its home. If two fingerprints differ
in at most t bits, the home of one lies within 3 + t of the other. So each fingerprint is kept
at its home and replicated to every anchor within covering radius plus threshold (about 70), and
fingerprints are compared at each anchor only. No pair within the threshold can be missed.

Texts of a given word similarity lie further apart than three bits. For them the 64 bits are cut into
three disjoint ranges, each with the same anchors: a pair within 11 bits is within 3 on one of
them. Somewhere between two words at distance 3 lies one at distance 1 from the first and 2 from the
second, and its home is within 4 of one and 5 of the other: replication goes no further there
(about 22 anchors a range). What meets within 11 bits is then verified on its word shingles.

Only what is connected matters, so a dense group does not send all its pairs: at each anchor a set of
connected members, at first each on its own, names its most promising pair with another set. Those
verified join sets; where sets have more to name there is another round, with eight times as many
pairs a set if most of the last failed. Counts of the shingles in 256 buckets go along and bound the
similarity from above; a pair that can't reach it is never sent.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.common import ascii_lower, components, document_texts, local_stars, slices, small_batches, words_of
from tidemark.session import stage

SHINGLE = 3
SEED = 42
THRESHOLD = 3
#: Bits that may differ before a pair is verified, and the ranges (lowest bit, bits) of which one has at most 3 of them.
WIDE = 11
RANGES = ((0, 23), (23, 23), (46, 18))

# ---------------------------------------------------------------- fingerprints


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """64 majority bits over the hashes of the text's word shingles; 0 without a word."""
    words = text.lower().split()  # bytes: only A-Z change, only ASCII white space splits
    if not words:
        return 0
    if len(words) <= shingle:
        grams = [b" ".join(words)]
    else:
        grams = map(b" ".join, zip(*[words[i:] for i in range(shingle)]))
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(g, SEED) for g in grams], dtype=np.uint64)
    # Big-endian bytes, so that the first of the unpacked bits is the highest.
    bits = np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
    ones = bits.sum(axis=0, dtype=np.int64) * 2 > len(hashes)
    return int.from_bytes(np.packbits(ones).tobytes(), "big")


def _fingerprint_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text", 8 << 20):
        values = [fingerprint(t) for t in batch.column("text").cast(pa.binary()).to_pylist()]
        found = pa.array(np.array(values, dtype=np.uint64).view(np.int64))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("text_hash"), found], ["doc_id", "text_hash", "fp"]
        )


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``text_hash`` and ``fp`` (the 64 bits as a signed long) of every row."""
    texts = document_texts(small_batches(docs)).withColumn("text_hash", F.xxhash64("text"))
    return texts.mapInArrow(_fingerprint_batches, "doc_id long, text_hash long, fp long")


# ---------------------------------------------------------------- the covering code

_BITS, _CHECKS, _RADIUS = 23, 11, 3
_GENERATOR = 0b110001110101  # fixed: generator polynomial of the perfect Golay code


def _syndromes(values: np.ndarray) -> np.ndarray:
    """Remainder by the generator polynomial."""
    values = values.copy()
    for bit in range(_BITS - 1, _CHECKS - 1, -1):
        values ^= np.where(values >> bit & 1, _GENERATOR << (bit - _CHECKS), 0)
    return values


@cache
def _code() -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """The error of each syndrome; and per syndrome the code words near such an error.

    The second part gives, for each syndrome, the words within radius plus threshold of its
    error, and how far beyond the radius they are.
    """
    singles = 1 << np.arange(_BITS)
    errors = [np.zeros(1, dtype=np.int64)]
    for _ in range(_RADIUS):
        errors.append(np.unique((errors[-1][:, None] ^ singles[None, :]).ravel()))
    errors = np.unique(np.concatenate(errors))
    errors = errors[np.bitwise_count(errors) <= _RADIUS]
    leaders = np.zeros(1 << _CHECKS, dtype=np.int64)
    leaders[_syndromes(errors)] = errors
    heads = np.arange(1 << (_BITS - _CHECKS), dtype=np.int64) << _CHECKS
    words = heads ^ _syndromes(heads)
    near = []
    for leader in leaders:
        excess = np.maximum(np.bitwise_count(words ^ leader).astype(np.int64) - _RADIUS, 0)
        pick = excess <= THRESHOLD
        near.append((words[pick], excess[pick]))
    return leaders, near


def homes(values: np.ndarray) -> np.ndarray:
    """The code word (as its upper 12 bits) whose ball holds the lowest 23 bits of each value."""
    low = (values & np.uint64((1 << _BITS) - 1)).astype(np.int64)
    return (low ^ _code()[0][_syndromes(low)]) >> _CHECKS


def around(values: np.ndarray, threshold: int) -> tuple[np.ndarray, np.ndarray]:
    """Index of each value and an anchor other than its home within radius plus threshold."""
    leaders, near = _code()
    low = (values & np.uint64((1 << _BITS) - 1)).astype(np.int64)
    syndrome = _syndromes(low)
    home = low ^ leaders[syndrome]
    index, anchors = [], []
    order = np.argsort(syndrome, kind="stable")
    groups = np.split(order, np.flatnonzero(np.diff(syndrome[order])) + 1) if len(order) else []
    for members in groups:
        words, excess = near[syndrome[members[0]]]
        words = words[(excess <= threshold) & (words != 0)]
        index.append(np.repeat(members, len(words)))
        anchors.append((home[members][:, None] ^ words[None, :]).ravel() >> _CHECKS)
    if not index:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    return np.concatenate(index), np.concatenate(anchors)


def _place(threshold: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                values = batch.column("fp").slice(at, 4096).to_numpy().view(np.uint64)
                index, anchors = around(values, threshold)
                fps = np.concatenate([values, values[index]]).view(np.int64)
                keys = np.concatenate([homes(values), anchors]).astype(np.int32)
                at_home = np.arange(len(fps)) < len(values)
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(at_home), pa.array(fps)], ["anchor", "home", "fp"])

    return run


def _compare(threshold: int):
    def run(table: pa.Table) -> pa.Table:
        fps = table.column("fp").to_numpy().view(np.uint64)
        at_home = table.column("home").to_numpy(zero_copy_only=False)
        here = fps[at_home]
        a, b = [], []
        step = max(1, (1 << 22) // max(1, len(here)))
        for at in range(0, len(fps) if len(here) else 0, step):
            part = fps[at : at + step]
            i, j = np.nonzero(np.bitwise_count(part[:, None] ^ here[None, :]) <= threshold)
            i, j = part[i], here[j]
            a.append(i[i != j])
            b.append(j[i != j])
            if sum(map(len, a)) > 1 << 20:
                a, b = ([x] for x in local_stars(np.concatenate(a), np.concatenate(b)))
        if a and sum(map(len, a)):
            a, b = local_stars(np.concatenate(a), np.concatenate(b))
        else:
            a = b = np.zeros(0, dtype=np.uint64)
        return pa.table({"a": a.view(np.int64), "b": b.view(np.int64)})

    return run


def linked(fps: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """Links between distinct fingerprints that differ in at most ``threshold`` bits.

    Per anchor only the links to the smallest fingerprint of each connected set are returned:
    the same components, and no more rows than fingerprints however dense a group of near
    copies is. ``threshold`` is at most 3.
    """
    if not 0 <= threshold <= THRESHOLD:
        raise ValueError(f"threshold must be 0 to {THRESHOLD}")
    placed = fps.select("fp").mapInArrow(_place(threshold), "anchor int, home boolean, fp long")
    return placed.groupBy("anchor").applyInArrow(_compare(threshold), "a long, b long").distinct()


# ---------------------------------------------------------------- similar texts


def meeting(values: np.ndarray, shift: int, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Index of each value, an anchor within 5 of the given range of its bits, and whether within 4."""
    leaders, near = _code()
    part = (values >> np.uint64(shift) & np.uint64((1 << bits) - 1)).astype(np.int64)
    syndrome = _syndromes(part)
    home = part ^ leaders[syndrome]
    index, anchors, close = [], [], []
    order = np.argsort(syndrome, kind="stable")
    groups = np.split(order, np.flatnonzero(np.diff(syndrome[order])) + 1) if len(order) else []
    for members in groups:
        words, excess = near[syndrome[members[0]]]
        pick = excess <= 2
        words, excess = words[pick], excess[pick]
        index.append(np.repeat(members, len(words)))
        anchors.append((home[members][:, None] ^ words[None, :]).ravel() >> _CHECKS)
        close.append(np.tile(excess <= 1, len(members)))
    if not index:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros(0, dtype=bool)
    return np.concatenate(index), np.concatenate(anchors), np.concatenate(close)


def _place_ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 4096):
            values = batch.column("fp").slice(at, 4096).to_numpy().view(np.uint64)
            for number, (shift, bits) in enumerate(RANGES):
                index, anchors, close = meeting(values, shift, bits)
                keys = (anchors + (number << (_BITS - _CHECKS))).astype(np.int32)
                fps = values[index].view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(close), pa.array(fps)], ["anchor", "close", "fp"])


def _compare_ranges(distance: int):
    def run(table: pa.Table) -> pa.Table:
        fps = table.column("fp").to_numpy().view(np.uint64)
        close = fps[table.column("close").to_numpy(zero_copy_only=False)]
        a, b = [np.zeros(0, dtype=np.uint64)], [np.zeros(0, dtype=np.uint64)]
        step = max(1, (1 << 20) // max(1, len(close)))
        for at in range(0, len(fps) if len(close) else 0, step):
            part = fps[at : at + step]
            i, j = np.nonzero(np.bitwise_count(part[:, None] ^ close[None, :]) <= distance)
            i, j = part[i], close[j]
            a.append(np.minimum(i, j)[i != j])
            b.append(np.maximum(i, j)[i != j])
        pairs = np.unique(np.stack([np.concatenate(a), np.concatenate(b)]), axis=1)
        return pa.table({"a": pairs[0].view(np.int64), "b": pairs[1].view(np.int64)})

    return run


def _placed(fps: DataFrame, distance: int) -> DataFrame:
    if not 0 <= distance <= WIDE:
        raise ValueError(f"distance must be 0 to {WIDE}")
    return fps.select("fp").mapInArrow(_place_ranges, "anchor int, close boolean, fp long")


def close_pairs(fps: DataFrame, distance: int = WIDE) -> DataFrame:
    """``a`` and ``b``: each pair of distinct fingerprints that differ in at most ``distance`` (at most 11) bits.

    A dense group has all its pairs here; ``similar_links`` does without them.
    """
    return _placed(fps, distance).groupBy("anchor").applyInArrow(_compare_ranges(distance), "a long, b long").distinct()


def _accompanied(distance: int):
    """The rows of an anchor that another is within ``distance`` bits of."""

    def run(table: pa.Table) -> pa.Table:
        fps = table.column("fp").to_numpy().view(np.uint64)
        close = table.column("close").to_numpy(zero_copy_only=False)
        here, met = fps[close], np.zeros(len(fps), dtype=bool)
        met_here = np.zeros(len(here), dtype=bool)
        step = max(1, (1 << 20) // max(1, len(here)))
        for at in range(0, len(fps) if len(here) else 0, step):
            part = fps[at : at + step]
            near = (np.bitwise_count(part[:, None] ^ here[None, :]) <= distance) & (part[:, None] != here[None, :])
            met[at : at + step] = near.any(axis=1)
            met_here |= near.any(axis=0)
        met[close] |= met_here
        return table.filter(pa.array(met))

    return run


BUCKETS = 256


def _bucket_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``fp``, ``size`` and, a byte each, how many shingles of a set fall into each bucket (255: or more)."""
    for batch in batches:
        sets = batch.column("_set")
        sizes = np.diff(sets.offsets.to_numpy())
        values = sets.flatten().to_numpy().view(np.uint64) % np.uint64(BUCKETS)
        rows = np.repeat(np.arange(batch.num_rows, dtype=np.int64), sizes)
        counts = np.bincount(rows * BUCKETS + values.astype(np.int64), minlength=batch.num_rows * BUCKETS)
        counts = np.minimum(counts, 255).astype(np.uint8).reshape(-1, BUCKETS)
        yield pa.RecordBatch.from_arrays(
            [batch.column("fp"), pa.array(sizes.astype(np.int32)), pa.array([row.tobytes() for row in counts], pa.binary())],
            ["fp", "size", "counts"],
        )


def _highest(left: np.ndarray, right: np.ndarray, m: np.ndarray, n: np.ndarray) -> np.ndarray:
    """What two sets of ``m`` and ``n`` shingles have in common at most, by their bucket counts."""
    upper = np.maximum(left, right)
    only_left = (upper - right).sum(axis=1, dtype=np.int64)
    only_right = (upper - left).sum(axis=1, dtype=np.int64)
    return np.minimum(m - only_left, n - only_right)


def _reaches(both, m, n, similarity: float):
    """Whether sets of ``m`` and ``n`` members with ``both`` in common are as similar as that; arrays or columns."""
    return (both > 0) & (both >= similarity * (m + n - both) - 1e-9)


def _name_partners(distance: int, similarity: float, most: int):
    """For each set at an anchor the ``most`` most promising pairs with members of others, and whether it has more."""

    def best(of, i, j, score, fps):
        """Order and pick of the best pairs by ``of``, and whether there are others."""
        order = np.lexsort((fps[j], fps[i], -score, of))
        of = of[order]
        first = np.searchsorted(of, of)
        pick = np.arange(len(of)) - first < most
        return order[pick], (np.searchsorted(of, of, side="right") - first > most)[pick]

    def run(table: pa.Table) -> pa.Table:
        fps = table.column("fp").to_numpy().view(np.uint64)
        sets, sizes = table.column("label").to_numpy(), table.column("size").to_numpy().astype(np.int64)
        counts = np.frombuffer(b"".join(table.column("counts").to_pylist()), dtype=np.uint8).reshape(-1, BUCKETS)
        here = np.flatnonzero(table.column("close").to_numpy(zero_copy_only=False))
        kept = [(np.zeros(0, dtype=np.int64),) * 2 + (np.zeros(0), np.zeros(0, dtype=bool))]
        step = max(1, (1 << 20) // max(1, len(here)))
        for at in range(0, len(fps) if len(here) else 0, step):
            part = slice(at, at + step)
            near = np.bitwise_count(fps[part, None] ^ fps[None, here]) <= distance
            i, j = np.nonzero(near & (sets[part, None] != sets[None, here]))
            i, j = i + at, here[j]
            common = np.zeros(len(i), dtype=np.int64)
            for k in range(0, len(i), 1 << 14):
                x, y = i[k : k + (1 << 14)], j[k : k + (1 << 14)]
                common[k : k + (1 << 14)] = _highest(counts[x], counts[y], sizes[x], sizes[y])
            fit = _reaches(common, sizes[i], sizes[j], similarity)
            i, j, common = i[fit], j[fit], common[fit]
            score = common / (sizes[i] + sizes[j] - common)
            pick, more = best(i, i, j, score, fps)
            kept.append((i[pick], j[pick], score[pick], more))
        i, j, score, cut = map(np.concatenate, zip(*kept))
        pick, more = best(sets[i], i, j, score, fps)
        more |= np.isin(sets[i[pick]], sets[i[cut]])
        a, b = fps[i[pick]].view(np.int64), fps[j[pick]].view(np.int64)
        anchor = table.column("anchor").to_numpy()[:1].repeat(len(a))
        return pa.table({"anchor": anchor, "a": np.minimum(a, b), "b": np.maximum(a, b), "more": more})

    return run


def shingle_set(words: str, shingle: int) -> Column:
    """Distinct hashes of the runs of ``shingle`` of the words in a column; of all, if fewer; none without a word."""
    runs = F.transform(
        F.sequence(F.lit(1), F.greatest(F.size(words) - (shingle - 1), F.lit(1))),
        lambda i: F.xxhash64(F.concat_ws(" ", F.slice(words, i, shingle))),
    )
    return F.when(F.size(words) > 0, F.array_distinct(runs)).otherwise(F.array().cast("array<bigint>"))


def similar_links(docs: DataFrame, firsts: DataFrame, similarity: float, shingle: int, distance: int) -> DataFrame:
    """``a`` and ``b``: links that connect what pairs of at least that Jaccard similarity connect.

    ``firsts`` holds ``doc_id``, ``first_hash`` and ``fp``, a row for each fingerprint. Only texts with
    another within ``distance`` bits are read for their shingles. Every pair within ``distance`` bits is verified, or
    bounded away by its bucket counts, or of one set already: rows grow with the members, however dense a
    group is, but for pairs just below ``similarity`` that the bound can't tell.
    """
    met = _placed(firsts, distance).groupBy("anchor").applyInArrow(_accompanied(distance), "anchor int, close boolean, fp long")
    met = stage(met, "met")
    wanted = firsts.join(met.select("fp").distinct(), "fp", "left_semi").select(F.col("doc_id").alias("_id"), "first_hash", "fp")
    texts = document_texts(docs)
    found = texts.join(wanted, (F.col("doc_id") == F.col("_id")) & (F.xxhash64("text") == F.col("first_hash")))
    words = found.dropDuplicates(["fp"]).select("fp", words_of(ascii_lower("text")).alias("_words"))
    sets = stage(words.select("fp", shingle_set("_words", shingle).alias("_set")), "shingles")
    bounds = sets.mapInArrow(_bucket_counts, "fp long, size int, counts binary")
    places = stage(met.join(bounds.where("size > 0").hint("merge"), "fp"), "places")
    links, tested, labels, most = None, None, None, 1
    while True:
        rows = places.withColumn("label", F.col("fp"))
        if labels is not None:
            rows = places.join(labels.hint("merge"), "fp", "left").withColumn("label", F.coalesce("component", "fp")).drop("component")
        named = rows.groupBy("anchor").applyInArrow(
            _name_partners(distance, similarity, most), "anchor int, a long, b long, more boolean"
        )
        named = stage(named, "named")
        pairs = named.select("a", "b").distinct()
        if tested is not None:
            pairs = pairs.join(tested.hint("merge"), ["a", "b"], "left_anti")
        both = (
            pairs.join(sets.select(F.col("fp").alias("a"), F.col("_set").alias("_left")).hint("merge"), "a")
            .join(sets.select(F.col("fp").alias("b"), F.col("_set").alias("_right")).hint("merge"), "b")
            .select("a", "b", F.size("_left").alias("_m"), F.size("_right").alias("_n"), F.size(F.array_intersect("_left", "_right")).alias("_both"))
        )
        checked = both.select("a", "b", _reaches(F.col("_both"), F.col("_m"), F.col("_n"), similarity).alias("_linked"))
        checked = stage(checked, "checked")
        fresh = checked.where("_linked").select("a", "b")
        links = fresh if links is None else links.union(fresh)
        dense = stage(named.where("more").select("anchor").distinct(), "dense")
        if dense.isEmpty():
            return links
        tested = checked.select("a", "b") if tested is None else tested.union(checked.select("a", "b"))
        places, joined = places.join(dense, "anchor", "left_semi"), fresh.count()
        if 2 * joined <= checked.count():
            most *= 8
        if joined:
            labels = stage(components(links).withColumnRenamed("node", "fp"), "labels")


def _grouped(docs: DataFrame, threshold: int) -> DataFrame:
    """``doc_id``, ``text_hash``, ``fp`` and ``component_id`` of every row."""
    rows = stage(fingerprints(docs), "fingerprints")
    groups = rows.groupBy("fp").agg(F.min("doc_id").alias("first"))
    roots = components(linked(groups, threshold)).withColumnRenamed("node", "fp")
    rooted = stage(
        groups.join(roots, "fp", "left").select("fp", "first", F.coalesce("component", "fp").alias("root")), "roots"
    )
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = stage(rooted.join(least, "root").select("fp", "component_id"), "named")
    return rows.join(named, "fp")


def simhash_groups(docs: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """``doc_id``, ``fingerprint`` and ``component_id`` of every row.

    The component is the smallest doc_id reachable over links of at most ``threshold`` bits.
    Null and empty texts have fingerprint zero and are linked like any other. Copies collapse to
    one fingerprint before anything is compared. Repeated rows stay rows; a null doc_id keeps its
    row and counts for no component, which is null if no other document belongs to it. An empty
    table gives an empty result; other columns are ignored.
    """
    return _grouped(docs, threshold).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def one_of_each_group(
    docs: DataFrame, threshold: int = THRESHOLD, similarity: float | None = None, shingle: int = 5, distance: int = WIDE
) -> DataFrame:
    """The rows of ``docs`` that stay: the smallest doc_id of each group, all columns unchanged.

    With a ``similarity`` the documents that stay are compared again: those whose fingerprints differ
    in at most ``distance`` bits and whose runs of ``shingle`` words have at least that Jaccard
    similarity are linked, and of what is connected by such links the smallest doc_id stays. Texts
    without a word are linked by their equal fingerprints alone.

    Of rows that repeat one kept doc_id in a group, one stays. Rows without a doc_id all stay:
    nothing says which of them to prefer. Rows that go are named by id and a hash of the text.
    Their list grows with the documents, so both are shuffled, whatever its size today.
    """
    rows = stage(_grouped(docs, threshold).where("doc_id IS NOT NULL"), "groups")
    kept = rows.where("doc_id = component_id").groupBy("doc_id").agg(
        F.min("text_hash").alias("first_hash"), F.count("*").alias("_rows"), F.min_by("fp", "text_hash").alias("fp")
    )
    repeated = stage(kept.where("_rows > 1"), "repeated")
    gone = rows.where("doc_id <> component_id").select("doc_id", "text_hash")
    if not repeated.isEmpty():
        others = rows.where("doc_id = component_id").join(repeated, "doc_id").where("text_hash <> first_hash")
        gone = gone.union(others.select("doc_id", "text_hash"))
    if similarity is not None:
        firsts = stage(kept.select("doc_id", "first_hash", "fp"), "firsts")
        named = firsts.join(
            components(similar_links(docs, firsts, similarity, shingle, distance)).withColumnRenamed("node", "fp"), "fp"
        )
        named = stage(named, "similar")
        least = named.groupBy("component").agg(F.min("doc_id").alias("_least"))
        again = named.join(least, "component").where("doc_id <> _least")
        gone = gone.union(again.select("doc_id", F.col("first_hash").alias("text_hash")))
    gone = stage(gone.distinct(), "gone").hint("merge").alias("g")
    same = (F.col("d.doc_id") == F.col("g.doc_id")) & (
        F.xxhash64(F.coalesce("d.text", F.lit(""))) == F.col("g.text_hash")
    )
    left = docs.alias("d").join(gone, same, "left_anti").select(*[F.col(f"d.{name}") for name in docs.columns])
    if repeated.isEmpty():
        return left
    again = left.join(repeated.select("doc_id"), "doc_id", "left_semi").select(docs.columns)
    return left.join(repeated.select("doc_id"), "doc_id", "left_anti").select(docs.columns).union(
        again.dropDuplicates(["doc_id"])
    )
