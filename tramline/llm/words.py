"""Words of Arrow text columns as numpy arrays, for use inside Spark tasks.

A word is a maximal run of bytes other than space and U+0009 to U+000D. All functions work on
whole columns at once; a task never holds more than ``SLICE_BYTES`` of text as arrays, or one text
where a single text is longer.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash

SLICE_BYTES = 4 << 20
LONG_WORD = 64  # bytes; longer words are hashed one by one

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_ALL = np.uint64(0xFFFFFFFFFFFFFFFF)
_M1, _M2, _M3 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53), np.uint64(0x9E3779B97F4A7C15)
_SHIFT = np.uint64(33)


def text_slices(
    batches: Iterator[pa.RecordBatch], column: str, most: int = SLICE_BYTES
) -> Iterator[pa.RecordBatch]:
    """The batches cut so that each holds at most ``most`` bytes of text, or one row."""
    for batch in batches:
        _, offsets = utf8(batch.column(column))
        at = 0
        while at < batch.num_rows:
            end = int(np.searchsorted(offsets, offsets[at] + most, "right")) - 1
            end = min(max(end, at + 1), batch.num_rows)
            yield batch.slice(at, end - at)
            at = end


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts one after the other, and where each begins; null is empty."""
    column = column.fill_null("").cast(pa.large_string())
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def mix(h: np.ndarray) -> np.ndarray:
    """A one-to-one scramble of 64-bit values."""
    h = (h ^ (h >> _SHIFT)) * _M1
    h = (h ^ (h >> _SHIFT)) * _M2
    return h ^ (h >> _SHIFT)


def join_hashes(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Hash of the sequence that ``left`` and ``right`` stand for."""
    return mix(left * _M3 + right)


class Words:
    """Words of a text column: byte buffer, begin and end of each word, first word of each row."""

    def __init__(self, column: pa.Array, lower: bool):
        data, offsets = utf8(column)
        self.bytes = np.zeros(len(data) + 8, np.uint8)
        self.bytes[: len(data)] = _LOWER[data] if lower else data
        space = _SPACE[data]
        before, after = np.ones(len(data), bool), np.ones(len(data), bool)
        before[1:], after[:-1] = space[:-1], space[1:]
        before[offsets[:-1][offsets[:-1] < len(data)]] = True
        after[offsets[1:][offsets[1:] > 0] - 1] = True
        self.starts = np.flatnonzero(~space & before)
        self.ends = np.flatnonzero(~space & after) + 1
        self.first = np.searchsorted(self.starts, offsets)

    def __len__(self) -> int:
        return len(self.starts)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def row(self) -> np.ndarray:
        """Row of each word."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def text(self, i: int) -> bytes:
        return self.bytes[self.starts[i] : self.ends[i]].tobytes()

    def hashes(self) -> np.ndarray:
        """64-bit hash of each word; words of up to 8 bytes and one length never collide."""
        length = self.ends - self.starts
        view = np.ndarray((len(self.bytes) - 7,), "<u8", self.bytes, 0, (1,))
        h = mix(length.astype(np.uint64) * _M3)
        for k in range(0, LONG_WORD, 8):
            at = np.flatnonzero((length > k) & (length <= LONG_WORD))
            if not len(at):
                continue
            left = np.minimum(length[at] - k, 8).astype(np.uint64)
            chunk = view[self.starts[at] + k] & (_ALL >> (np.uint64(64) - left * np.uint64(8)))
            h[at] = mix((h[at] ^ chunk) + _M3)
        for i in np.flatnonzero(length > LONG_WORD):
            h[i] = xxhash.xxh64_intdigest(self.text(i))
        return h


def windows(h: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` consecutive values (rows are not kept apart)."""
    n = len(h) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    result, done, power, width = None, 0, h, 1
    while width <= size:
        if size & width:
            part = power[done : done + n]
            result = mix(part + np.uint64(width)) if result is None else join_hashes(result, part)
            done += width
        if width * 2 <= size:
            power = join_hashes(power[:-width], power[width:])
        width *= 2
    return result


def within_rows(first: np.ndarray, size: int) -> np.ndarray:
    """Index of every word at which a run of ``size`` words of one row begins."""
    n = np.maximum(np.diff(first) - size + 1, 0)
    total = int(n.sum())
    begin = np.cumsum(n) - n
    return np.repeat(first[:-1] - begin, n) + np.arange(total)
