"""Sorted 64-bit keys of whole blocks of documents, packed into a few binary values.

A block asks for something about its distinct keys (words, word pairs, anchors): one row for
each part of the key space goes to the task of that part, which sees the keys of all blocks and
answers in the order asked. Rows are few and keys take five to six bytes each, so the shuffle is
small, and copies within a block have been combined before it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext

_ZSTD = pa.Codec("zstd", compression_level=1)


def pack(values: np.ndarray) -> bytes:
    """Numbers as bytes: equal places next to each other, compressed."""
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), values.itemsize).T
    return _ZSTD.compress(planes.tobytes(), asbytes=True)


def unpack(data: bytes, n: int, dtype: type) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    raw = _ZSTD.decompress(data, decompressed_size=n * size, asbytes=True)
    return np.ascontiguousarray(np.frombuffer(raw, dtype=np.uint8).reshape(size, n).T).view(dtype).ravel()


def pack_sorted(keys: np.ndarray) -> bytes:
    """Ascending unsigned keys, as differences."""
    return pack(np.diff(keys, prepend=np.uint64(0)))


def unpack_sorted(data: bytes, n: int) -> np.ndarray:
    return np.cumsum(unpack(data, n, np.uint64), dtype=np.uint64)


def parts_of(keys: np.ndarray, bits: int) -> list[tuple[int, int, int]]:
    """Part, start and end of each run of ascending ``keys`` with equal upper ``bits``."""
    if not len(keys):
        return []
    part = (keys >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(keys), dtype=np.int64)
    cuts = np.concatenate([[0], np.flatnonzero(np.diff(part)) + 1, [len(keys)]])
    return [(int(part[a]), int(a), int(b)) for a, b in zip(cuts[:-1], cuts[1:])]


def asked(block: int, keys: np.ndarray, bits: int, *values: np.ndarray) -> dict[str, list]:
    """Columns of the rows that a block sends: part, block, n, keys, and packed ``values``."""
    runs = parts_of(keys, bits)
    return {
        "part": [part for part, _, _ in runs], "block": [block] * len(runs), "n": [b - a for _, a, b in runs],
        "keys": [pack_sorted(keys[a:b]) for _, a, b in runs],
        **{f"v{k}": [pack(value[a:b]) for _, a, b in runs] for k, value in enumerate(values)},
    }


def gathered(table: pa.Table, *dtypes: type) -> tuple[list[int], np.ndarray, np.ndarray, list[np.ndarray]]:
    """Blocks, row borders, keys and values of one part, in the order of the blocks."""
    table = table.sort_by("block")
    n = table.column("n").to_pylist()
    keys = [unpack_sorted(data, k) for data, k in zip(table.column("keys").to_pylist(), n)]
    values = [
        np.concatenate([unpack(data, k, dtype) for data, k in zip(table.column(f"v{i}").to_pylist(), n)])
        for i, dtype in enumerate(dtypes)
    ]
    return table.column("block").to_pylist(), np.concatenate([[0], np.cumsum(n)]), np.concatenate(keys), values


def answers(table: pa.Table, level: int, dtype: type, column: str = "v0") -> np.ndarray:
    """The answers to one block at ``level``, in the order of its keys."""
    own = table.filter(pc.equal(table.column("level"), level)).sort_by("part")
    found = [unpack(data, n, dtype) for data, n in zip(own.column(column).to_pylist(), own.column("n").to_pylist())]
    return np.concatenate(found) if found else np.zeros(0, dtype=dtype)


def blocks_of(batches: Iterator[pa.RecordBatch], column: str, limit: int) -> Iterator[tuple[int, pa.Table]]:
    """Rows in blocks of about ``limit`` bytes of ``column``, each with a number of its own."""
    first = TaskContext.get().partitionId() << 32
    number, held, size = 0, [], 0
    for batch in batches:
        lengths = np.cumsum(pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False))
        at = 0
        while at < batch.num_rows:
            done = lengths[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(lengths, done + limit - size, side="right")))
            held.append(batch.slice(at, to - at))
            size += int(lengths[to - 1] - done)
            at = to
            if size >= limit or at < batch.num_rows:
                yield first + number, pa.Table.from_batches(held)
                number, held, size = number + 1, [], 0
    if held:
        yield first + number, pa.Table.from_batches(held)
