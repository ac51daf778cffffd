"""Byte-level BPE of whole texts, with tree concatenation for long ones.

A text of up to ``LEAF`` characters is encoded in place. A longer one is cut into leaves, which
are dealt to all tasks and encoded on their own. Neighbouring halves are then joined, pair by
pair up the tree: a window around the join is encoded again and grows until it holds, on either
side, a token that the half has at the very same place. Left of the left token the left half's
tokens stand, right of the right token the right half's, between them the window's.

Why that is exact: a token sequence is the encoding of its text if each two neighbours are (a
property of merges by rank), and each two neighbours of the result come from one encoding that
has both. The word pattern looks back at nothing and ahead at no more than two characters, so
word borders of a half hold except at its very end, which the agreed tokens keep away from.

A piece that is encoded in place is cut before each blank that a visible ASCII character follows: the
word pattern has a border there whatever comes before, and no token crosses it. Each worker keeps the
ids of the words it has met, so a word is merged once and then looked up.
"""

from __future__ import annotations

import json
import os
import re
import struct
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import slices, small_batches

#: Characters of a text, or part of one, that a task encodes in one piece.
LEAF = 1 << 15
#: Characters of the first window on either side of a join.
WINDOW = 64
#: Bytes that agreed tokens keep away from the join on its left and from the window's end.
MARGIN = 16
#: Bytes of text that a task takes at a time.
BATCH = 2 << 20
#: Words whose ids a worker keeps before it starts anew, and characters of such a word at most.
KNOWN, LONGEST = 1 << 19, 32

_BORDER = re.compile("(?= [!-~])")


class Codec:
    """One tokenizer file: encoding of pieces, joining of two."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks are the parallelism
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        added = self.tokenizer.get_added_tokens_decoder()
        if any(t.lstrip or t.rstrip or t.single_word or " " in t.content for t in added.values()):
            raise ValueError("Added tokens that look at their surroundings are not supported")
        self.added = {t.content: number for number, t in added.items()}
        self.by_words, self.known = _splits_at_blanks(path), {}
        self.lengths = np.array([len(b) for b in byte_table(path)], dtype=np.int64)

    def parts(self, text: str) -> list[str]:
        """The text cut at added tokens, which stay as parts of their own."""
        if not any(token in text for token in self.added):
            return [text]
        longest_first = sorted(self.added, key=len, reverse=True)
        return [part for part in re.split(f"({'|'.join(map(re.escape, longest_first))})", text) if part]

    def encode(self, text: str) -> bytes:
        """Ids of ``text`` as little-endian 32-bit integers."""
        return self.encode_all([text])[0]

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit integers."""
        cut = [self.words(text) for text in texts]
        if len(self.known) > KNOWN:
            self.known.clear()
        ids = self.known
        new = list({word for words in cut for word in words if word not in ids})
        if new:
            found = self.tokenizer.encode_batch_fast(new, add_special_tokens=False)
            ids.update((word, struct.pack(f"<{len(one)}I", *one.ids)) for word, one in zip(new, found))
        out = [b"".join([ids[word] for word in words]) for words in cut]
        for word in new:
            if len(word) > LONGEST:
                del ids[word]
        return out

    def words(self, text: str) -> list[str]:
        """Pieces of ``text`` that are encoded apart; the whole of it where an added token may reach over a border."""
        if not self.by_words or any(token in text for token in self.added):
            return [text]
        return _BORDER.split(text)

    def join(self, text: str, at: int, left: np.ndarray, right: np.ndarray, low: int, high: int) -> np.ndarray:
        """Ids of ``text[low:high]`` from the ids of the halves before and after ``at``."""
        width = WINDOW
        while True:
            start, end = max(low, at - width), min(high, at + width)
            inner = np.array(self.tokenizer.encode(text[start:end], add_special_tokens=False).ids, dtype="<u4")
            if (start, end) == (low, high):
                return inner
            before, after = len(text[start:at].encode()), len(text[at:end].encode())
            edges = np.concatenate([[0], np.cumsum(self.lengths[inner])]) - before
            i = j = 0, 0
            if start == low:
                i = 0, 0
            else:
                tail = left[-4 * width :]
                theirs = np.concatenate([[0], np.cumsum(self.lengths[tail])])
                i = _agreed(edges, theirs - theirs[-1], -before + 1, -MARGIN, last=True)
                i = i and (i[0], len(left) - len(tail) + i[1])
            if end == high:
                j = len(inner), len(right)
            else:
                head = right[: 4 * width]
                theirs = np.concatenate([[0], np.cumsum(self.lengths[head])])
                j = _agreed(edges, theirs, 0, after - MARGIN, last=False)
            if i and j:
                return np.concatenate([left[: i[1]], inner[i[0] : j[0]], right[j[1] :]])
            width *= 2

    def concatenate(self, text: str, leaves: list[np.ndarray], size: int) -> np.ndarray:
        """Ids of ``text`` from those of its leaves of ``size`` characters, joined as a tree."""
        width = size
        while len(leaves) > 1:
            joined = [
                self.join(text, (2 * k + 1) * width, leaves[2 * k], leaves[2 * k + 1], 2 * k * width, min(len(text), (2 * k + 2) * width))
                for k in range(len(leaves) // 2)
            ]
            leaves = joined + leaves[2 * len(joined) :]
            width *= 2
        return leaves[0]


def _agreed(edges: np.ndarray, theirs: np.ndarray, low: int, high: int, last: bool) -> tuple[int, int] | None:
    """Index, on either side, of a token with the same start and end, within ``low`` and ``high``."""
    spans = edges[:-1] * (1 << 32) + np.diff(edges)
    other = theirs[:-1] * (1 << 32) + np.diff(theirs)
    common = np.flatnonzero(np.isin(spans, other) & (edges[:-1] >= low) & (edges[1:] <= high))
    if not len(common):
        return None
    pick = common[-1 if last else 0]
    return int(pick), int(np.flatnonzero(other == spans[pick])[0])


def _byte_alphabet() -> dict[str, int]:
    """The visible character that stands for each byte in vocabulary files."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


@lru_cache(maxsize=2)
def byte_table(path: str) -> list[bytes]:
    """The bytes of each id of a file."""
    with open(path, encoding="utf-8") as file:
        content = json.load(file)
    alphabet = _byte_alphabet()
    table = {number: bytes(alphabet[c] for c in token) for token, number in content["model"]["vocab"].items()}
    table |= {token["id"]: token["content"].encode() for token in content["added_tokens"]}
    return [table.get(number, b"") for number in range(max(table) + 1)]


def _splits_at_blanks(path: str) -> bool:
    """Whether the file's texts go to the word pattern as they are, and merges look at one word only."""
    with open(path, encoding="utf-8") as file:
        content = json.load(file)
    words = content["pre_tokenizer"] or {}
    return (
        content["normalizer"] is None and not content["model"].get("dropout")
        and words.get("type") == "ByteLevel" and words.get("use_regex", True) and not words.get("add_prefix_space", True)
    )


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    """The codec of a file, loaded once in each worker."""
    return Codec(path)


def _encode_short(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = codec(path)
        for batch in slices(batches, "text", BATCH):
            ids = tool.encode_all(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(ids, pa.binary())], ["doc_id", "ids"])

    return run


_LEAVES = "_row long, doc_id long, part int, leaf int, text string"


def _cut(path: str, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = codec(path)
        for batch in slices(batches, "text", 1):
            row, doc_id, text = (batch.column(name)[0].as_py() for name in ("_row", "doc_id", "text"))
            cut = [
                (row, doc_id, p, leaf, part[at : at + size])
                for p, part in enumerate(tool.parts(text))
                for leaf, at in enumerate(range(0, len(part), size))
            ]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*cut), [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.string()])],
                ["_row", "doc_id", "part", "leaf", "text"],
            )

    return run


def _encode_leaves(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = codec(path)
        for batch in slices(batches, "text", BATCH):
            ids = tool.encode_all(batch.column("text").to_pylist())
            yield batch.append_column("ids", pa.array(ids, pa.binary()))

    return run


def _grow(path: str, size: int):
    def run(table: pa.Table) -> pa.Table:
        tool = codec(path)
        table = table.sort_by([("part", "ascending"), ("leaf", "ascending")])
        parts: dict[int, tuple[list[str], list[np.ndarray]]] = {}
        for part, text, ids in zip(*(table.column(name).to_pylist() for name in ("part", "text", "ids"))):
            texts, leaves = parts.setdefault(part, ([], []))
            texts.append(text)
            leaves.append(np.frombuffer(ids, dtype="<u4"))
        ids = b"".join(tool.concatenate("".join(texts), leaves, size).tobytes() for texts, leaves in parts.values())
        return pa.table({"doc_id": table.column("doc_id").slice(0, 1), "ids": pa.array([ids], pa.binary())})

    return run


def encode(docs: DataFrame, path: str, leaf: int = LEAF) -> DataFrame:
    """``doc_id`` and ``ids`` (little-endian unsigned 32-bit integers) of each whole text.

    ``path`` is a byte-level BPE file of the tokenizers library, reachable by every executor.
    Null texts are empty and give no ids; repeated rows and null ids stay rows; an empty table
    gives an empty result; other columns are ignored. Memory of a task is bounded by a leaf for
    the encoding and by one document's ids and text for the joins.
    """
    texts = small_batches(docs).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    short = texts.where(F.char_length("text") <= leaf).mapInArrow(_encode_short(path), "doc_id long, ids binary")
    long = texts.where(F.char_length("text") > leaf).select(F.monotonically_increasing_id().alias("_row"), "doc_id", "text")
    leaves = long.mapInArrow(_cut(path, leaf), _LEAVES).repartition("_row", "part", "leaf")
    encoded = leaves.mapInArrow(_encode_leaves(path), _LEAVES + ", ids binary")
    return short.union(encoded.groupBy("_row").applyInArrow(_grow(path, leaf), "doc_id long, ids binary"))


def _decode_batches(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = byte_table(path)
        for batch in slices(batches, "ids", BATCH):
            texts = [
                b"".join([table[i] for i in np.frombuffer(ids, dtype="<u4").tolist()]).decode("utf-8", "replace")
                for ids in batch.column("ids").to_pylist()
            ]
            yield batch.append_column("text", pa.array(texts, pa.string()))

    return run


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """``encoded`` (``doc_id`` and ``ids``) with the decoded ``text``; null ids give an empty text."""
    filled = encoded.select("doc_id", F.coalesce("ids", F.lit(b"")).alias("ids"))
    return filled.mapInArrow(_decode_batches(path), "doc_id long, ids binary, text string")


def token_digest(decoded: DataFrame, *more: str) -> DataFrame:
    """Number of tokens, digests of ids and text, and the columns ``more``."""
    return decoded.select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"), *more,
    )
