"""Words and shingles of whole Arrow columns as numpy arrays; no loop over rows or words.

A word is a maximal run of bytes other than the six ASCII white-space characters. The hash of a word is a sum of
random numbers per byte times a power of its place, so that one running sum over a block of texts gives the hashes
of all its words.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U = np.uint64
BLOCK_BYTES = 1 << 21  # texts are handled in blocks of about this size; a longer text is a block of its own
STEP = U(0x9E3779B97F4A7C15)
BASE = U(0xD1342543DE82EF95)
BASE_INVERSE = U(pow(int(BASE), -1, 1 << 64))


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every bit of 64-bit integers over all others."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U(27))
    x = x * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def salt(n: int) -> np.uint64:
    """A constant for each small number."""
    return U(n * int(STEP) % (1 << 64))


BYTE_VALUE = mix(np.arange(1, 257, dtype=U) * STEP)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True

_powers: list[np.ndarray] = [np.ones(1, U), np.ones(1, U)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE ** 0..n-1 and the same of its inverse, modulo 2 ** 64."""
    if len(_powers[0]) < n:
        size = 1 << (n - 1).bit_length()
        for k, base in enumerate((BASE, BASE_INVERSE)):
            x = np.full(size, base)
            x[0] = 1
            _powers[k] = np.multiply.accumulate(x)
    return _powers[0][:n], _powers[1][:n]


class Block(NamedTuple):
    """Consecutive rows: their bytes, and the words in them."""

    first: int  # number of the first row in the batch
    rows: int
    data: np.ndarray  # bytes of the texts
    offsets: np.ndarray  # of the rows in data, rows + 1 values
    start: np.ndarray  # of the words in data
    end: np.ndarray
    row: np.ndarray  # of the words, from 0
    first_word: np.ndarray  # of the rows, rows + 1 values


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and the offsets of its rows; null counts as empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def spans(offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """Row ranges of about BLOCK_BYTES."""
    n, at = len(offsets) - 1, 0
    while at < n:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + BLOCK_BYTES, "right")) - 1)
        to = min(to, n, at + 60_000)
        yield at, to
        at = to


def blocks(column: pa.Array, lower: bool = False) -> Iterator[Block]:
    data, offsets = text_bytes(column)
    for a, b in spans(offsets):
        own = data[offsets[a] : offsets[b]]
        own = LOWER[own] if lower else own
        at = offsets[a : b + 1] - offsets[a]
        word = np.zeros(len(own) + 2, bool)
        word[1:-1] = ~SPACE[own]
        cut = np.zeros(len(own) + 1, bool)
        cut[at] = True
        start = np.flatnonzero(word[1:-1] & (~word[:-2] | cut[:-1]))
        end = np.flatnonzero(word[1:-1] & (~word[2:] | cut[1:])) + 1
        first_word = np.searchsorted(start, at)
        row = np.repeat(np.arange(b - a), np.diff(first_word))
        yield Block(a, b - a, own, at, start, end, row, first_word)


def word_hashes(block: Block) -> np.ndarray:
    if not len(block.start):
        return np.zeros(0, U)
    up, down = powers(len(block.data))
    total = np.zeros(len(block.data) + 1, U)
    np.cumsum(BYTE_VALUE[block.data] * up, out=total[1:])
    return mix((total[block.end] - total[block.start]) * down[block.start] + (block.end - block.start).astype(U) * STEP)


def shingles(block: Block, k: int, whole: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Row and hash of every run of ``k`` words; with ``whole``, a row with fewer words gives one shingle of all."""
    h = word_hashes(block)
    n = len(h)
    count = np.diff(block.first_word)
    rows, values = [], []
    if n >= k:
        acc = np.zeros(n - k + 1, U)
        for j in range(k):
            acc = acc * BASE + h[j : n - k + 1 + j]
        inside = block.row[: n - k + 1] == block.row[k - 1 :]
        rows.append(block.row[: n - k + 1][inside])
        values.append(mix(acc[inside]))
    if whole:
        short = np.flatnonzero((count > 0) & (count < k))
        for length in np.unique(count[short]):
            own = short[count[short] == length]
            acc = np.full(len(own), salt(int(length)))
            for j in range(int(length)):
                acc = acc * BASE + h[block.first_word[own] + j]
            rows.append(own)
            values.append(mix(acc ^ STEP))
    if not rows:
        return np.zeros(0, np.int64), np.zeros(0, U)
    return np.concatenate(rows), np.concatenate(values)


def distinct(row: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (row, value), sorted by both. Rows are below 65,536."""
    order = np.argsort(value)
    order = order[np.argsort(row[order].astype(np.uint16), kind="stable")]
    row, value = row[order], value[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (value[1:] != value[:-1])
    return row[new], value[new]


def joined(block: Block, keep: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The kept words of each row joined by one space: bytes, offsets of the rows, and offset of every kept word."""
    start, end, row = (block.start, block.end, block.row) if keep is None else (block.start[keep], block.end[keep], block.row[keep])
    edge = np.zeros(len(block.data) + 1, np.int8)
    edge[start] += 1
    edge[end] -= 1
    held = np.cumsum(edge[:-1], dtype=np.int8).astype(bool)
    data = block.data.copy()
    after = np.zeros(len(start), bool)
    after[1:] = row[1:] == row[:-1]
    blank = start[after] - 1
    held[blank] = True
    data[blank] = 32
    before = np.zeros(len(data) + 1, np.int64)
    np.cumsum(held, out=before[1:])
    return data[held], before[block.offsets], before[start]
