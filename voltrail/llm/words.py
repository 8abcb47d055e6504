"""Words of many texts at once, as numpy arrays.

A word is a maximal run of bytes other than ASCII white space (``[^\\x20\\x09-\\x0D]+``), which on
UTF-8 is the same run of code points.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SPACE = np.zeros(256, dtype=bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
_rng = np.random.Generator(np.random.PCG64(20240229))
BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))
_powers: dict[int, np.ndarray] = {}


def powers(base: np.uint64, n: int) -> np.ndarray:
    """``base ** 0 .. base ** (n-1)`` modulo 2**64, kept for the next call."""
    have = _powers.get(int(base))
    if have is None or len(have) < n:
        step = np.full(max(n, 1 << 12), base, dtype=np.uint64)
        step[0] = 1
        have = np.cumprod(step, dtype=np.uint64)
        if n <= 1 << 20:  # what a very long text needs isn't kept
            _powers[int(base)] = have
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """splitmix64's finisher: spreads every bit of a 64-bit value over all others."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def run_hash(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of ``values[s:e]`` for each pair: equal runs have equal hashes wherever they stand."""
    total = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * powers(_BASE, len(values)), out=total[1:])
    back = powers(_INVERSE, len(values) + 1)
    return mix((total[ends] - total[starts]) * back[starts] + (ends - starts).astype(np.uint64))


def stretch_hash(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of ``values[s:e]`` for stretches in order that don't overlap; none is empty."""
    if not len(starts):
        return np.empty(0, dtype=np.uint64)
    size = (ends - starts).astype(np.int32)
    first = np.cumsum(size, dtype=np.int32) - size
    place = np.arange(int(size.sum()), dtype=np.int32)
    v = values[place + np.repeat((starts - first).astype(np.int32), size)]
    place -= np.repeat(first, size)
    v *= powers(_BASE, int(size.max()))[place]
    return mix(np.add.reduceat(v, first) + size.astype(np.uint64))


@dataclass
class Words:
    """Words of a batch of texts, in order; ``first[d]:first[d + 1]`` are those of text ``d``."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray
    at: np.ndarray  # where each text's bytes start; the last element is past the last text

    def per_text(self, flags: np.ndarray) -> np.ndarray:
        """How many bytes of each text have their flag set."""
        total = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
        return total[self.at[1:]] - total[self.at[:-1]]

    def per_text_words(self, flags: np.ndarray) -> np.ndarray:
        """How many words of each text have their flag set."""
        total = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
        return total[self.first[1:]] - total[self.first[:-1]]

    @property
    def text_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def hashes(self) -> np.ndarray:
        return stretch_hash(BYTE[self.data], self.starts, self.ends)

    def windows(self, n: int) -> np.ndarray:
        """Where windows of ``n`` words within one text start."""
        count = np.diff(self.first)
        ok = np.arange(len(self.starts)) + n <= np.repeat(self.first[1:], count)
        return np.flatnonzero(ok)


def split(texts: list[bytes], between: np.ndarray = SPACE) -> Words:
    """``between`` flags the bytes that words don't hold; a space must be one of them."""
    joined = np.frombuffer(b" " + b" ".join(texts) + b" ", dtype=np.uint8)
    blank = between[joined]
    starts = np.flatnonzero(blank[:-1] & ~blank[1:]) + 1
    ends = np.flatnonzero(~blank[:-1] & blank[1:]) + 1
    at = np.concatenate(([1], 1 + np.cumsum([len(t) + 1 for t in texts], dtype=np.int64))) if texts else np.array([1])
    return Words(joined, starts, ends, np.searchsorted(starts, at), at)


def as_bytes(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    """UTF-8 of each text; null is empty."""
    return [v or b"" for v in column.cast(pa.binary()).to_pylist()]


def parts(batches: Iterable[pa.RecordBatch], column: str, limit: int = 2 << 20) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Each batch in slices of about ``limit`` bytes of text (one text at least), which bounds a task's memory."""
    for batch in batches:
        texts = batch.column(batch.schema.get_field_index(column))
        size = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
        at = 0
        while at < len(texts):
            before = int(size[at - 1]) if at else 0
            n = max(1, int(np.searchsorted(size, before + limit, side="right")) - at)
            yield batch.slice(at, n), as_bytes(texts.slice(at, n))
            at += n


class Table:
    """64-bit key -> non-negative number, looked up for many keys at once; -1 where there is none."""

    EMPTY = np.uint64(2**64 - 1)

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        bits = max(4, int(4 * len(keys)).bit_length())
        self.shift = np.uint64(64 - bits)
        self.keys = np.full(1 << bits, self.EMPTY, dtype=np.uint64)
        self.values = np.full(1 << bits, -1, dtype=np.int64)
        keys = keys.astype(np.uint64)
        left, slot = np.arange(len(keys)), self.slots(keys)
        while len(left):
            free = self.keys[slot[left]] == self.EMPTY
            _, one = np.unique(slot[left[free]], return_index=True)
            put = left[free][one]
            self.keys[slot[put]], self.values[slot[put]] = keys[put], values[put]
            left = np.setdiff1d(left, put)
            slot[left] = (slot[left] + 1) & (len(self.keys) - 1)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * _BASE) >> self.shift).astype(np.int64)

    def get(self, keys: np.ndarray) -> np.ndarray:
        slot = self.slots(keys)
        there = self.keys[slot]
        out = np.where(there == keys, self.values[slot], -1)
        left = np.flatnonzero((there != keys) & (there != self.EMPTY))
        slot = slot[left]
        while len(left):
            slot = (slot + 1) & (len(self.keys) - 1)
            there = self.keys[slot]
            same = there == keys[left]
            out[left[same]] = self.values[slot[same]]
            go = ~same & (there != self.EMPTY)
            left, slot = left[go], slot[go]
        return out


def spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The positions of many stretches, one after another."""
    return np.repeat(starts - np.cumsum(sizes) + sizes, sizes) + np.arange(int(sizes.sum()))
