"""Vectorised text primitives: many documents as one byte buffer.

A *block* is a run of whole documents of about ``BLOCK_BYTES``; arrays of a block
stay small whatever the size of an Arrow batch. One document longer than that
forms a block of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 19
#: Multiplier of the polynomial hash, odd, and its inverse modulo 2**64.
P = 0x9E3779B97F4A7C15
P_INV = pow(P, -1, 1 << 64)

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True

_pow = np.ones(1, np.uint64)
_inv = np.ones(1, np.uint64)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _pow, _inv
    if len(_pow) < n:
        for base, name in ((P, "_pow"), (P_INV, "_inv")):
            a = np.full(n, base, np.uint64)
            a[0] = 1
            globals()[name] = np.cumprod(a, dtype=np.uint64)
    return _pow[:n], _inv[:n]


class Block(NamedTuple):
    first: int  # row of its first document in the batch
    data: np.ndarray  # uint8
    offsets: np.ndarray  # int64, one more than documents, from 0


def as_binary(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string or binary column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + n + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def blocks(column: pa.Array, size: int = BLOCK_BYTES, step: int = 1) -> Iterator[Block]:
    """Blocks of ``size`` bytes or one document more; of a multiple of ``step`` documents."""
    data, offsets = as_binary(column)
    n, at = len(offsets) - 1, 0
    while at < n:
        end = int(np.searchsorted(offsets, offsets[at] + size, "right")) - 1
        end = min(n, max(at + step, at + (end - at) // step * step))
        yield Block(at, data[offsets[at] : offsets[end]], offsets[at : end + 1] - offsets[at])
        at = end


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the word (a bijection)."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """H with H[i] the polynomial hash of data[:i]."""
    power, _ = _powers(len(data) + 1)
    h = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[: len(data)], out=h[1:])
    return h


def range_hash(h: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of data[start:end] for many ranges, whatever their place."""
    _, inverse = _powers(len(h))
    x = (h[end] - h[start]) * inverse[start]
    return mix(x ^ (np.asarray(end - start).astype(np.uint64) << np.uint64(1)))


def words(block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of maximal runs without white space, and the first word of each document."""
    n = len(block.data)
    solid = ~_SPACE[block.data]
    cut = np.zeros(n + 1, bool)
    cut[block.offsets] = True
    start, last = solid.copy(), solid.copy()
    start[1:] &= ~solid[:-1] | cut[1:n]
    last[:-1] &= ~solid[1:] | cut[1:n]
    starts, ends = np.flatnonzero(start), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, block.offsets)


def doc_of(first: np.ndarray) -> np.ndarray:
    """Document number of each word, from the first words of the documents."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def folded(data: np.ndarray) -> np.ndarray:
    """ASCII letters in lower case; other bytes as they are."""
    upper = (data >= 65) & (data <= 90)
    return data + (upper.astype(np.uint8) << 5)


def gram_hash(word: np.ndarray, first: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the n-word runs inside documents, and each one's document.

    A document of 1 to n - 1 words has one gram: all its words.
    """
    count = np.diff(first)
    grams = np.where(count >= n, count - n + 1, np.minimum(count, 1))
    doc = np.repeat(np.arange(len(count)), grams)
    start = np.arange(len(doc)) - np.repeat(np.cumsum(grams) - grams, grams) + first[:-1][doc]
    end = first[1:][doc]
    h = np.zeros(len(doc), np.uint64)
    padded = np.append(word, np.uint64(0))
    for i in range(n):
        at = start + i
        inside = at < end
        h = h * np.uint64(P) + np.where(inside, padded[np.minimum(at, len(word))], np.uint64(0x51ED270B))
    return mix(h), doc
