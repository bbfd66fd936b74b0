"""Whole Arrow batches of texts as flat numpy arrays: words, word hashes, hashes of word runs.

A word is a maximal run of bytes other than space and 0x09 to 0x0D, which is the pattern
``[^\\x20\\x09-\\x0D]+`` on UTF-8.  Hashes are 64-bit, fixed by constants, and equal in every task and run.
Work per byte is done in pieces of a few MB, so a batch of long texts needs little memory beyond itself.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text that are handled at once, and words that are hashed at once.
CHUNK_BYTES = 4 << 20
HASH_BYTES = 1 << 20

_random = np.random.Generator(np.random.PCG64(20260217))
_BYTE_VALUE = _random.integers(0, 2**64, 256, dtype=np.uint64)
_STEP = np.uint64(0x9E3779B97F4A7C15 | 1)
_STEP_INVERSE = np.uint64(pow(int(_STEP), -1, 2**64))
_SEPARATOR = np.zeros(256, dtype=bool)
_SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_powers: dict[str, np.ndarray] = {}


def _power(step: np.uint64, name: str, count: int) -> np.ndarray:
    known = _powers.get(name)
    if known is None or len(known) < count:
        known = np.full(max(count, 1 << 12), step, dtype=np.uint64)
        known[0] = 1
        _powers[name] = known = np.cumprod(known, dtype=np.uint64)
    return known[:count]


def mix(values: np.ndarray, salt: int = 0) -> np.ndarray:
    """A bijective scramble of 64-bit values (the finaliser of splitmix64), varied by ``salt``."""
    x = values ^ np.uint64((salt * 0xD1342543DE82EF95) % 2**64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return _LOWER[data]


class Texts:
    """Some texts of a batch: UTF-8 bytes and the offsets of each text.  A null text is empty."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data, self.offsets = data, offsets

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def text_bytes(self, i: int) -> memoryview:
        return memoryview(self.data)[self.offsets[i] : self.offsets[i + 1]]

    def words(self, separator: np.ndarray = _SEPARATOR) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start and end of every word, and the bounds of each text's words in those arrays."""
        gap = separator[self.data]
        edge = np.empty(len(gap) + 1, dtype=bool)
        edge[1:-1] = gap[1:] != gap[:-1]
        edge[0] = len(gap) > 0 and not gap[0]
        edge[-1] = len(gap) > 0 and not gap[-1]
        # Texts follow each other without a gap: a text's first byte starts a word of its own.
        inner = self.offsets[1:-1]
        inner = np.unique(inner[(inner > 0) & (inner < len(gap))])
        touching = inner[~gap[inner] & ~gap[inner - 1]]
        borders = np.flatnonzero(edge)
        if len(touching):
            borders = np.sort(np.concatenate([borders, touching, touching]))
        starts, ends = borders[0::2], borders[1::2]
        return starts, ends, np.searchsorted(starts, self.offsets)


def read_texts(column: pa.Array | pa.ChunkedArray, piece_bytes: int | None = None) -> Iterator[tuple[int, Texts]]:
    """The texts of a string column in pieces of about CHUNK_BYTES or the bytes given, with the row of each piece's first.

    A text is never cut: one that is longer makes a piece by itself.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    count = len(column)
    if not count:
        return
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + count + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.zeros(0, dtype=np.uint8)
    first, most = 0, piece_bytes or CHUNK_BYTES
    while first < count:
        after = int(np.searchsorted(offsets, offsets[first] + most, side="right")) - 1
        after = min(max(after, first + 1), count)
        piece = data[offsets[first] : offsets[after]]
        yield first, Texts(piece, offsets[first : after + 1] - offsets[first])
        first = after


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte span; spans are in order and do not overlap."""
    out = np.empty(len(starts), dtype=np.uint64)
    first = 0
    while first < len(starts):
        after = int(np.searchsorted(ends, starts[first] + HASH_BYTES, side="right"))
        after = max(after, first + 1)
        low, high = int(starts[first]), int(ends[after - 1])
        # Every byte counts by its place; dividing by the power of the start makes places relative.
        terms = _BYTE_VALUE[data[low:high]] * _power(_STEP, "step", high - low)
        total = np.zeros(high - low + 1, dtype=np.uint64)
        np.cumsum(terms, out=total[1:])
        at, to = starts[first:after] - low, ends[first:after] - low
        sums = (total[to] - total[at]) * _power(_STEP_INVERSE, "inverse", high - low)[at]
        out[first:after] = mix(sums + (to - at).astype(np.uint64) * _STEP)
        first = after
    return out


def hash_runs(words: np.ndarray, length: int, salt: int = 0) -> np.ndarray:
    """A hash of every run of ``length`` consecutive word hashes, across text borders too."""
    if len(words) < length:
        return np.zeros(0, dtype=np.uint64)
    scrambled = mix(words, salt + 1)
    terms = scrambled * _power(_STEP, "step", len(words))
    total = np.zeros(len(words) + 1, dtype=np.uint64)
    np.cumsum(terms, out=total[1:])
    count = len(words) - length + 1
    return mix((total[length:] - total[:-length]) * _power(_STEP_INVERSE, "inverse", count), salt + 7)


def ragged(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For segments of these lengths: the segment of every element, and its place in the segment."""
    segment = np.repeat(np.arange(len(lengths)), lengths)
    begin = np.cumsum(lengths) - lengths
    return segment, np.arange(len(segment)) - begin[segment]
