"""Whole texts as UTF-8 buffers inside tasks, without a Python string for each row.

``blocks`` cuts the Arrow batches of ``mapInArrow`` into runs of rows of about
``max_bytes`` of text, so that a task's memory follows that bound (or the longest
single text), not the batch. A null text has length zero and is flagged.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

MASK = (1 << 64) - 1
BASE = 0x9E3779B97F4A7C15 | 1  # odd, so that powers can be inverted modulo 2**64
BASE_INVERSE = pow(BASE, -1, 1 << 64)

#: Text bytes of a block; a worker needs up to about 125 bytes for each.
BLOCK_BYTES = 1 << 18

#: ``[\x20\x09-\x0D]``: what separates words in most of the operators.
WHITE = np.zeros(256, bool)
WHITE[[0x20, *range(0x09, 0x0E)]] = True
#: A-Z to a-z, all other bytes as they are.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20

_powers = {"n": 0}


@dataclass
class Block:
    """Rows first..last of a batch: their text bytes, row borders and null flags."""

    batch: pa.RecordBatch
    first: int
    data: np.ndarray
    offsets: np.ndarray
    null: np.ndarray

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def column(self, name: str) -> pa.Array:
        return self.batch.column(name).slice(self.first, len(self))

    def raw(self, i: int) -> bytes:
        return self.data[self.offsets[i] : self.offsets[i + 1]].tobytes()


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes, row borders and null flags of a string column."""
    column = column.cast(pa.large_binary())
    n = len(column)
    null = np.asarray(column.is_null()) if column.null_count else np.zeros(n, bool)
    _, borders, data = column.buffers()
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64), null
    offsets = np.frombuffer(borders, np.int64)[column.offset : column.offset + n + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    if column.null_count:  # a null may cover bytes
        keep = np.where(null, 0, np.diff(offsets))
        if keep.sum() != offsets[-1] - offsets[0]:
            return buffers(column.fill_null(b""))[:2] + (null,)
    return data, offsets, null


def blocks(batches: Iterator[pa.RecordBatch], max_bytes: int = BLOCK_BYTES, text: str = "text", max_rows: int = 1 << 30) -> Iterator[Block]:
    for batch in batches:
        data, offsets, null = buffers(batch.column(text))
        i, n = 0, len(null)
        while i < n:
            j = int(np.searchsorted(offsets, offsets[i] + max_bytes, "right")) - 1
            j = min(max(j, i + 1), i + max_rows, n)
            yield Block(batch, i, data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], null[i:j])
            i = j
    pa.default_memory_pool().release_unused()  # Spark keeps the worker for later tasks


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i modulo 2**64 for i < n; grown by doubling and kept."""
    if _powers["n"] < n:
        size = max(2 * BLOCK_BYTES, 1 << int(n).bit_length())
        for key, base in (("up", BASE), ("down", BASE_INVERSE)):
            x = np.full(size, base, np.uint64)
            x[0] = 1
            _powers[key] = np.multiply.accumulate(x)
        _powers["n"] = size
    return _powers["up"], _powers["down"]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser over 64 bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """Sums of (byte + 1) * BASE**i, from which ``span_hash`` takes any span."""
    up, _ = powers(len(data) + 1)
    sums = np.empty(len(data) + 1, np.uint64)
    sums[0] = 0
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=sums[1:])
    return sums


def span_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of the bytes [start, end), equal for equal bytes wherever they stand."""
    _, down = powers(len(sums))
    return mix((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64))


def words(block: Block, separator: np.ndarray = WHITE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each word of a block, and the first word of each row (n + 1 borders)."""
    inside = ~separator[block.data]
    start = inside.copy()
    start[1:] &= separator[block.data[:-1]]
    heads = block.offsets[:-1][np.diff(block.offsets) > 0]
    start[heads] = inside[heads]
    end = np.zeros(len(inside) + 1, bool)
    end[1:] = inside
    end[1:-1] &= ~inside[1:] | start[1:]
    starts, ends = np.flatnonzero(start), np.flatnonzero(end)
    return starts, ends, np.searchsorted(starts, block.offsets)


def lowered(block: Block) -> np.ndarray:
    return LOWER[block.data]


def lowered_latin(data: np.ndarray) -> np.ndarray:
    """A-Z and the capitals of Latin-1 (two bytes, the first 0xC3) in lower case."""
    out = LOWER[data]
    second = np.flatnonzero(data[:-1] == 0xC3) + 1
    capital = second[(data[second] <= 0x9E) & (data[second] != 0x97)]
    out[capital] += 0x20
    return out
