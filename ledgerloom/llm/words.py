"""Words of whole text columns as numpy arrays, and hashes of word windows.

A word is a longest run of bytes other than space and the controls 9 to 13
(``[^\\x20\\x09-\\x0D]+``). All functions work on one slice of rows at a time;
``slices`` cuts Arrow batches so that a slice holds a bounded number of bytes
(or one row, if that row alone is longer).
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import types as T

WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"

_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_KEEP = np.array([(1 << (8 * n)) - 1 for n in range(8)] + [2**64 - 1], dtype=np.uint64)
_K1, _K2, _K3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))
_LONG_WORD = 512


class Words(NamedTuple):
    """Words of consecutive texts: word ``i`` is ``data[start[i]:end[i]]``, the
    words of text ``t`` are ``first[t]`` to ``first[t + 1]``."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    def text_of(self) -> np.ndarray:
        """The text that each word belongs to."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def as_bytes(column) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column, one after the other, and their offsets (null: empty)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    cuts = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    if not len(cuts):
        cuts = np.zeros(1, np.int64)
    held = np.frombuffer(data, np.uint8)[cuts[0] : cuts[-1]] if data else np.zeros(0, np.uint8)
    return held, cuts - cuts[0]


def split_words(column, lower: bool = False) -> Words:
    """Words of each text; ``lower`` lower-cases A to Z first."""
    data, cuts = as_bytes(column)
    if lower:
        data = _LOWER[data]
    inside = ~_IS_SPACE[data]
    before, after = np.zeros(len(data), bool), np.zeros(len(data), bool)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    inner = cuts[(cuts > 0) & (cuts < len(data))]
    before[inner] = False
    after[inner - 1] = False
    start = np.flatnonzero(inside & ~before)
    end = np.flatnonzero(inside & ~after) + 1
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    return Words(padded, start, end, np.searchsorted(start, cuts))


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * _K2
    x = (x ^ (x >> np.uint64(27))) * _K3
    return x ^ (x >> np.uint64(31))


def word_hashes(words: Words, seed: int = 0) -> np.ndarray:
    """A 64-bit hash of each word's bytes."""
    lanes = np.ndarray(len(words.data) - 7, "<u8", words.data, strides=(1,))
    size = words.end - words.start
    h = mixed(size.astype(np.uint64) * _K1 + np.uint64(seed * 2 + 1))
    short = size <= _LONG_WORD
    rows = np.flatnonzero(short)
    done = 0
    while len(rows):
        left = size[rows] - done
        h[rows] = mixed(h[rows] * _K1 + (lanes[words.start[rows] + done] & _KEEP[np.minimum(left, 8)]))
        rows = rows[left > 8]
        done += 8
    for i in np.flatnonzero(~short):
        held = words.data[words.start[i] : words.end[i]].tobytes()
        h[i] = np.uint64(xxhash.xxh3_64_intdigest(held, seed))
    return h


def joined(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hash of two neighbouring windows from the hashes of both."""
    return mixed(a * _K1 + b)


def window_hashes(h: np.ndarray, size: int) -> np.ndarray:
    """Hash of ``h[i:i + size]`` for each ``i``, in about 2 log2(size) passes."""
    out, covered, power, step = None, 0, h, 1
    rest = size
    while rest:
        if rest & 1:
            if out is None:
                out, covered = power, step
            else:
                n = max(0, len(h) - covered - step + 1)
                out = joined(out[:n], power[covered : covered + n])
                covered += step
        rest >>= 1
        if rest:
            n = max(0, len(h) - 2 * step + 1)
            power = joined(power[:n], power[step : step + n])
            step *= 2
    return out


def window_minima(values: np.ndarray, size: int) -> np.ndarray:
    """Place of the leftmost least value among ``values[i:i + size]``, for each ``i``."""
    least, place, covered = values, np.arange(len(values)), 1
    while covered < size:
        step = min(covered, size - covered)
        n = max(0, len(least) - step)
        left, right = least[:n], least[step : step + n]
        take = right < left
        least, place = np.where(take, right, left), np.where(take, place[step : step + n], place[:n])
        covered += step
    return place


def spaced(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """All words in a row with one space before each and one at the end, and
    where each word starts in that."""
    size = words.end - words.start
    start = np.cumsum(size + 1) - size
    out = np.full(int(size.sum()) + len(size) + 1, 32, np.uint8)
    total = int(size.sum())
    if total:
        before = np.repeat(np.cumsum(size) - size, size)
        step = np.arange(total) - before
        out[np.repeat(start, size) + step] = words.data[np.repeat(words.start, size) + step]
    return out, start


def widened(schema: T.StructType, columns: str) -> T.StructType:
    """A new schema: that one and columns given as in DDL."""
    return T.StructType([*schema.fields, *T.StructType.fromDDL(columns).fields])


def slices(batch: pa.RecordBatch, *columns: str, limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Consecutive slices whose texts in these columns hold ``limit`` bytes at most (one row at least)."""
    if not batch.num_rows:
        return
    sizes = [pc.fill_null(pc.binary_length(batch.column(c)), 0).to_numpy(zero_copy_only=False) for c in columns]
    total = np.cumsum(sum(s.astype(np.int64) for s in sizes))
    begin = 0
    while begin < len(total):
        base = total[begin - 1] if begin else 0
        stop = max(begin + 1, int(np.searchsorted(total, base + limit, side="right")))
        yield batch.slice(begin, stop - begin)
        begin = stop

