"""Katz backoff language model of word pairs: learning and scoring at cluster scale.

Counts up to ``LARGEST`` are discounted by Good-Turing, on a log-linear fit of the counts of
counts where these have gaps or bumps (copies); what they give up goes to pairs not seen
in training, in proportion to the words' own probabilities, with a weight per context that makes
the probabilities of all words after it add up to one exactly. A context all of whose pairs are
frequent has nothing to give up; one use is set aside there.

Documents are read once into blocks of word numbers, kept in a bucketed table. For counts and
weights the blocks ask the parts of the key space (see ``packed``): word counts, then pair
counts, then context sums. Parts are cut by hash of the word or pair, never by context, so a
word that starts a third of all pairs is no one's burden. Words are known by 64-bit hashes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from contextlib import ExitStack, contextmanager
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.common import bucketed, document_texts, lower_bytes, mix, small_batches, span_hashes, text_bytes, word_spans
from tidemark.llm.packed import answers, asked, blocks_of, gathered, pack, pack_sorted, unpack, unpack_sorted
from tidemark.session import remove_folder, stage, staged, work_folder

#: Counts above this are trusted as they are.
LARGEST = 5
#: Counts of counts are kept up to this one.
COUNTED = 64
#: Bytes of text in a block, and in a part of the key space.
BLOCK, PART = 8 << 20, 16 << 20
_END, _START = np.uint64(0x1F3D5B79A8C6E402), np.uint64(0x8E6C4A2B13579BDF)


def _slope(counts: list[int], largest: int) -> float | None:
    """Slope of log Z_r over log r, as in simple Good-Turing: Z_r spreads the keys seen r times
    over the gap to the counts in use next to r, so that gaps (copies) and bumps level out.

    The fit goes over counts up to ``largest`` + 1, or over all if fewer than two of these are in
    use; with fewer than two at all there is no slope.
    """
    for end in (largest + 2, len(counts)):
        used = [r for r in range(1, end) if counts[r]]
        if len(used) > 1:
            break
    else:
        return None
    before, after = [0, *used[:-1]], [*used[1:], 2 * used[-1] - used[-2]]
    x = np.log(used)
    y = np.log([2 * counts[r] / (t - q) for q, r, t in zip(before, used, after)])
    x = x - x.mean()
    return float((x * y).sum() / (x * x).sum())


def discounts(counts: list[int], largest: int = LARGEST) -> np.ndarray:
    """Factor for each count from 0 to ``largest``, from how many keys have each count.

    ``counts[r]`` is the number of keys seen r times, up to ``largest`` + 1 at least. Where
    Good-Turing on the counts of counts as they are gives a factor outside of zero to one, it is
    applied to their log-linear fit, which always gives factors between zero and one. Without two
    different counts to fit (empty tables), each count gives up half of one.
    """
    if all(counts[r] for r in range(1, largest + 1)):
        common = (largest + 1) * counts[largest + 1] / counts[1]
        ratios = np.array([1.0] + [(r + 1) * counts[r + 1] / (r * counts[r]) for r in range(1, largest + 1)])
        if common < 1:
            factors = (ratios - common) / (1 - common)
            if ((factors > 0) & (factors <= 1)).all() and factors[1] < 1:
                return factors
    slope = _slope(counts, largest)
    r = np.arange(1, largest + 1)
    if slope is None:
        return np.append(1.0, (r - 0.5) / r)
    # With Z_r = r ** slope, r * Z_r falls (or grows) by this power; 0 has a limit, a step beside it is as good.
    power = float(np.clip(slope + 1, -8, 8))
    power = power if abs(power) > 1e-6 else -1e-6
    common = (largest + 1.0) ** power
    return np.append(1.0, ((1 + 1 / r) ** power - common) / (1 - common))


@dataclass(frozen=True)
class Totals:
    """Training totals: tokens, distinct words, texts, and discount factors of words and pairs."""

    tokens: int
    words: int
    texts: int
    word_factors: np.ndarray
    unseen: float
    pair_factors: np.ndarray | None = None

    def word(self, counts: np.ndarray) -> np.ndarray:
        """Probability of words with these counts; a word not seen gets all of the unseen mass."""
        seen = counts * self.word_factors[np.minimum(counts, LARGEST)] if self.tokens else counts
        seen = np.where(counts > LARGEST, counts, seen) / max(1, self.tokens)
        return np.where(counts > 0, seen, self.unseen)

    def pair(self, counts: np.ndarray, contexts: np.ndarray) -> np.ndarray:
        """Discounted probability of seen pairs."""
        kept = np.where(counts > LARGEST, 1.0, self.pair_factors[np.minimum(counts, LARGEST)])
        return kept * counts / np.maximum(contexts, 1)


def totals_of(stats: list[int], texts: int) -> Totals:
    tokens, words, *counts = stats
    factors = discounts(counts)
    given_up = sum((1 - factors[r]) * r * counts[r] for r in range(1, LARGEST + 1))
    if not tokens or given_up <= 0:
        # Nothing to discount: one token's worth is set aside.
        factors = np.full(LARGEST + 1, tokens / (tokens + 1))
        return Totals(tokens, words, texts, factors, 1 / (tokens + 1))
    return Totals(tokens, words, texts, factors, given_up / tokens)


# ---------------------------------------------------------------- blocks

_BLOCK = (
    "block long, doc_id array<long>, held array<boolean>, lengths binary, codes binary, "
    "words int, vocabulary binary, uses binary"
)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for block, table in blocks_of(batches, "text", BLOCK):
        data, offsets = text_bytes(table.column("text").combine_chunks())
        data = lower_bytes(data)
        starts, ends, counts = word_spans(data, offsets)
        hashes = span_hashes(data, starts, ends)
        lengths = counts + 1
        tokens = np.full(lengths.sum(), _END, dtype=np.uint64)
        last = np.cumsum(lengths) - 1
        inner = np.ones(len(tokens), dtype=bool)
        inner[last] = False
        tokens[inner] = hashes
        vocabulary, codes = np.unique(tokens, return_inverse=True)
        held = table.column("held").to_numpy()
        trained = np.repeat(~held, lengths)
        uses = np.bincount(codes[trained], minlength=len(vocabulary)).astype(np.uint32)
        row = [
            block, table.column("doc_id").to_pylist(), held.tolist(), pack(lengths.astype(np.uint32)), pack(codes.astype(np.uint32)),
            len(vocabulary), pack_sorted(vocabulary), pack(uses),
        ]
        types = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.bool_()), *[pa.binary()] * 2, pa.int32(), *[pa.binary()] * 2]
        names = ["block", "doc_id", "held", "lengths", "codes", "words", "vocabulary", "uses"]
        yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types)], names)


class _Block:
    """The arrays of one row of the table of blocks."""

    def __init__(self, row: dict):
        self.block, self.doc_id = row["block"], row["doc_id"]
        self.held = np.array(row["held"], dtype=bool)
        n = len(self.held)
        self.lengths = unpack(row["lengths"], n, np.uint32).astype(np.int64)
        self.codes = unpack(row["codes"], int(self.lengths.sum()), np.uint32).astype(np.int64)
        self.words = row["words"]
        self.vocabulary = unpack_sorted(row["vocabulary"], self.words)
        self.uses = unpack(row["uses"], self.words, np.uint32).astype(np.int64)

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Distinct pairs in the order of their keys: keys, context, word; tokens' pairs; training uses.

        Contexts are word numbers; the number after the last word is the start of a text.
        """
        first = np.zeros(len(self.codes), dtype=bool)
        first[np.cumsum(self.lengths) - self.lengths] = True
        before = np.where(first, self.words, np.roll(self.codes, 1))
        both, index = np.unique(before * self.words + self.codes, return_inverse=True)
        context, word = both // self.words, both % self.words
        hashes = np.append(self.vocabulary, _START)
        keys = mix(hashes[context] * np.uint64(3) + hashes[word])
        order = np.argsort(keys)
        place = np.empty_like(order)
        place[order] = np.arange(len(order))
        index = place[index]
        trained = np.repeat(~self.held, self.lengths)
        uses = np.bincount(index[trained], minlength=len(order)).astype(np.uint32)
        return keys[order], context[order], word[order], index, uses


_ASKED = "part int, block long, n int, keys binary, v0 binary"


def _rows(columns: dict[str, list]) -> pa.RecordBatch:
    types = {"part": pa.int32(), "block": pa.int64(), "n": pa.int32()}
    return pa.RecordBatch.from_arrays(
        [pa.array(v, types.get(name, pa.binary())) for name, v in columns.items()], list(columns)
    )


def _ask_words(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                keys = unpack_sorted(row["vocabulary"], row["words"])
                yield _rows(asked(row["block"], keys, bits, unpack(row["uses"], row["words"], np.uint32)))

    return run


def _ask_pairs(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                own = _Block(batch.slice(at, 1).to_pylist()[0])
                keys, _, _, _, uses = own.pairs()
                yield _rows(asked(own.block, keys, bits, uses))

    return run


_ANSWER = "part int, block long, n int, keys binary, v0 binary, stats array<long>, kind string"


def _count(table: pa.Table) -> pa.Table:
    """Sums of one part. Answers hold four times the sum, plus two if other blocks ask for the key
    as well, plus one for the block that owns it.

    The owner is the first block that uses the key in training. The part's own row is the model:
    keys with their counts, and how many have each small count.
    """
    part = table.column("part")[0].as_py()
    blocks, borders, keys, (uses,) = gathered(table, np.uint32)
    distinct, index = np.unique(keys, return_inverse=True)
    sums = np.bincount(index, weights=uses, minlength=len(distinct)).astype(np.int64)
    used = np.flatnonzero(uses > 0)[::-1]
    owner = np.full(len(distinct), -1)
    owner[index[used]] = used
    found = (sums * 4 + 2 * (np.bincount(index, minlength=len(distinct)) > 1))[index]
    found[owner[owner >= 0]] += 1
    seen = sums > 0
    small = np.bincount(np.minimum(sums[seen], COUNTED + 1), minlength=COUNTED + 2)[: COUNTED + 1]
    stats = [int(sums.sum()), int(seen.sum()), *small.tolist()]
    n = len(blocks)
    return pa.table(
        {
            "part": pa.array([part] * (n + 1), pa.int32()), "block": pa.array([*blocks, None], pa.int64()),
            "n": pa.array([*np.diff(borders).tolist(), int(seen.sum())], pa.int32()),
            "keys": pa.array([None] * n + [pack_sorted(distinct[seen])], pa.binary()),
            "v0": pa.array([*[pack(found[a:b]) for a, b in zip(borders[:-1], borders[1:])], pack(sums[seen])], pa.binary()),
            "stats": pa.array([None] * n + [stats], pa.list_(pa.int64())),
            "kind": ["answer"] * n + ["model"],
        }
    )


@contextmanager
def _counted(requests: DataFrame, label: str) -> Iterator[tuple[DataFrame, list[int]]]:
    """Answers of all parts, in a table partitioned by kind, and the model's summed statistics."""
    spark = requests.sparkSession
    folder = work_folder(spark, label)
    try:
        requests.groupBy("part").applyInArrow(_count, _ANSWER).write.partitionBy("kind").parquet(folder)
        table = spark.read.schema(_ANSWER).parquet(folder)
        sums = [F.coalesce(F.sum(F.get("stats", F.lit(k))), F.lit(0)) for k in range(COUNTED + 3)]
        yield table.where("kind = 'answer'"), list(table.where("kind = 'model'").agg(*sums).first())
    finally:
        remove_folder(spark, folder)


class _Known:
    """One block with the answers on its words and pairs."""

    def __init__(self, left: pa.Table, right: pa.Table, totals: Totals):
        self.own = own = _Block(left.to_pylist()[0])
        words = answers(right, 1, np.int64)
        self.counts = words >> 2
        self.keys, self.context, self.word, self.index, _ = own.pairs()
        pairs = answers(right, 2, np.int64)
        self.pair_counts, self.owned = pairs >> 2, (pairs & 1).astype(bool)
        # Training uses of contexts; the last is the start of a text.
        self.context_counts = np.append(self.counts, totals.texts)
        self.p_word = totals.word(self.counts)
        seen = self.pair_counts > 0
        self.p_pair = np.where(seen, totals.pair(self.pair_counts, self.context_counts[self.context]), 0.0)
        # Sums over the pairs that this block owns, per context.
        n = own.words + 1
        mine = self.owned
        self.taken = np.bincount(self.context[mine], weights=self.p_pair[mine], minlength=n)
        self.lower = np.bincount(self.context[mine], weights=self.p_word[self.word[mine]], minlength=n)
        # Contexts that other blocks have as well have to be asked for.
        hashes = np.append(own.vocabulary, _START)
        open_ = np.flatnonzero((self.context_counts > 0) & np.append(words & 2, 2).astype(bool))
        self.open = open_[np.argsort(hashes[open_])]
        self.open_keys = hashes[self.open]


def _ask_contexts(bits: int, totals: Totals):
    def run(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        known = _Known(left, right, totals)
        columns = asked(known.own.block, known.open_keys, bits, known.taken[known.open], known.lower[known.open])
        return pa.Table.from_batches([_rows(columns)])

    return run


def _weights(taken: np.ndarray, lower: np.ndarray) -> np.ndarray:
    """What a context leaves to pairs it has not seen, for each unit of their words' probability.

    Negative, for a mass of one, if the context leaves nothing, as all of its pairs are above the
    discounted counts: one more use is then set aside for it, see ``_score``.
    """
    left = 1 - taken
    return np.where(left > 1e-12, left, -1.0) / (1 - lower)


def _sum_contexts(table: pa.Table) -> pa.Table:
    part = table.column("part")[0].as_py()
    blocks, borders, keys, (taken, lower) = gathered(table, np.float64, np.float64)
    distinct, index = np.unique(keys, return_inverse=True)
    weights = _weights(*[np.bincount(index, weights=v, minlength=len(distinct)) for v in (taken, lower)])[index]
    return pa.table(
        {
            "part": pa.array([part] * len(blocks), pa.int32()), "block": pa.array(blocks, pa.int64()),
            "n": pa.array(np.diff(borders).tolist(), pa.int32()),
            "v0": pa.array([pack(weights[a:b]) for a, b in zip(borders[:-1], borders[1:])], pa.binary()),
        }
    )


_SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def _score(totals: Totals):
    def run(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        known = _Known(left, right, totals)
        own = known.own
        weights = np.where(known.context_counts > 0, _weights(known.taken, known.lower), 1.0)
        weights[known.open] = answers(right, 3, np.float64)
        # A context with n uses and nothing left counts as n + 1 uses, one of them not seen.
        more = known.context_counts + 1.0
        kept = np.where(weights < 0, known.context_counts / more, 1.0)
        weights = np.where(weights < 0, -weights / more, weights)
        backed_off = weights[known.context] * known.p_word[known.word]
        p = np.where(known.pair_counts > 0, known.p_pair * kept[known.context], backed_off)
        text = np.repeat(np.arange(len(own.held)), own.lengths)
        summed = lambda values: np.bincount(text, weights=values, minlength=len(own.held))
        counts = known.counts[own.codes]
        base = np.log10((known.counts + 1) / (totals.tokens + totals.words + 1))
        return pa.table(
            {
                "doc_id": pa.array(own.doc_id, pa.int64()), "held_out": own.held, "n_tokens": own.lengths,
                "n_known": summed(counts > 0).astype(np.int64),
                "train_tokens": np.full(len(own.held), totals.tokens, dtype=np.int64),
                "base_score": summed(base[own.codes]), "score": summed(np.log10(p)[known.index]),
            }
        )

    return run


def katz_scores(docs: DataFrame, held_out: Column) -> DataFrame:
    """A row per document: ``doc_id``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``,
    ``base_score`` and ``score``, both log10 probabilities of the whole text.

    The model learns from the rows where ``held_out`` is false. Words are lower-cased (A-Z) and
    every text ends with an end token. A word not seen in training is one class, with the mass
    that the discounts of single words set free. Null and empty texts are an end token; repeated
    rows count as often as they stand; null ids stay rows; without any training row every token
    has probability one; an empty table gives an empty result; other columns are ignored.
    """
    texts = document_texts(
        small_batches(docs).select("doc_id", "text", F.coalesce(held_out, F.lit(False)).alias("held")), "held"
    )
    size = texts.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    bits = max(0, math.ceil(math.log2(max(1, size / PART))))
    columns = ["block", "part", "n", "v0"]
    with ExitStack() as tables:
        keep = tables.enter_context
        blocks = keep(bucketed(texts.mapInArrow(_read, _BLOCK), "block", max(1, math.ceil(size / BLOCK)), "katz_blocks"))
        trained = F.aggregate("held", F.lit(0), lambda n, h: n + F.when(h, 0).otherwise(1))
        n_texts = blocks.agg(F.coalesce(F.sum(trained), F.lit(0))).first()[0]
        asked_words = blocks.select("block", "words", "vocabulary", "uses").mapInArrow(_ask_words(bits), _ASKED)
        words, stats = keep(_counted(asked_words, "katz-words"))
        totals = totals_of(stats, n_texts)
        pairs, stats = keep(_counted(blocks.mapInArrow(_ask_pairs(bits), _ASKED), "katz-pairs"))
        totals = replace(totals, pair_factors=discounts(stats[2:]))
        known = words.select(*columns, F.lit(1).alias("level")).union(pairs.select(*columns, F.lit(2)))
        contexts = (
            blocks.groupBy("block").cogroup(known.groupBy("block"))
            .applyInArrow(_ask_contexts(bits, totals), _ASKED + ", v1 binary")
        )
        answer = "part int, block long, n int, v0 binary"
        weights = keep(staged(contexts.groupBy("part").applyInArrow(_sum_contexts, answer), "katz-weights"))
        known = known.union(weights.select(*columns, F.lit(3)))
        scored = blocks.groupBy("block").cogroup(known.groupBy("block")).applyInArrow(_score(totals), _SCORES)
        return stage(scored, "katz-scores")
