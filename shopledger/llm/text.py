"""Whole texts as numpy arrays: words found and hashed for many documents in one pass.

A word is a run of `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]` after A-Z became a-z; in UTF-8 these are the digits,
the ASCII letters and every byte from 0x80 on, so bytes can be looked at one by one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20

_BYTES = np.arange(256)
LOWER = np.where((_BYTES >= 65) & (_BYTES <= 90), _BYTES + 32, _BYTES).astype(np.uint8)
IS_WORD = (
    (_BYTES >= 128)
    | ((_BYTES >= 48) & (_BYTES <= 57))
    | ((LOWER >= 97) & (LOWER <= 122))
)

_GRAM_BASE = np.uint64(0xD6E8FEB86659FD93)
_VALUE = np.uint64(0x9E3779B97F4A7C15)
_PLACE = np.uint64(0xC2B2AE3D27D4EB4F)
_BLOCK = 1 << 18


def mixed(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of `values[start:end]` for each span, the same wherever the span lies. Spans are in order.

    A value and its place in the span are mixed together before they are added up, so that no regular words, such as those
    that a polynomial can't tell apart, share a hash.
    """
    counts = np.asarray(ends, np.int64) - starts
    at = np.concatenate([[0], np.cumsum(counts)])
    sums = np.zeros(len(counts), np.uint64)
    for begin in range(0, int(at[-1]), _BLOCK):
        end = min(begin + _BLOCK, int(at[-1]))
        first, last = np.searchsorted(at, begin, "right") - 1, np.searchsorted(at, end, "left")
        low, high = np.maximum(at[first:last], begin), np.minimum(at[first + 1 : last + 1], end)
        span = np.repeat(np.arange(first, last), high - low)
        place = np.arange(begin, end) - at[span]
        value = values[starts[span] + place].astype(np.uint64) + np.uint64(1)
        h = mixed(mixed(value * _VALUE) + place.astype(np.uint64) * _PLACE)
        held = np.flatnonzero(high > low)
        sums[first + held] += np.add.reduceat(h, low[held] - begin)
    return mixed(sums + counts.astype(np.uint64))


@dataclass
class Slice:
    """Rows `first` to `first + len(bounds) - 1` of a batch; row i holds bytes bounds[i] to bounds[i + 1]."""

    first: int
    data: np.ndarray
    bounds: np.ndarray

    @property
    def rows(self) -> int:
        return len(self.bounds) - 1


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[Slice]:
    """Neighbouring texts of about `limit` bytes together; a longer text makes a slice of its own. Null: empty."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    column = column.cast(pa.large_string()).fill_null("")
    if not len(column):
        return
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        stop = int(np.searchsorted(bounds, bounds[first] + limit, "right")) - 1
        stop = min(max(stop, first + 1), len(column))
        yield Slice(first, data[bounds[first] : bounds[stop]], bounds[first : stop + 1] - bounds[first])
        first = stop


def _pieces(data: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[int, int]]:
    """Cuts of a long slice that fall between words."""
    at = 0
    while at < len(data):
        end = min(at + 2 * SLICE_BYTES, len(data))
        while end < len(data):
            gaps = np.flatnonzero(~IS_WORD[data[max(at, end - SLICE_BYTES) : end]])
            if len(gaps):
                end = max(at, end - SLICE_BYTES) + int(gaps[-1]) + 1
                break
            end = min(end + SLICE_BYTES, len(data))
        yield at, end
        at = end


def words(part: Slice) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash and first byte of each word, and for each row the number of words before it (one entry more than rows)."""
    if len(part.data) > 2 * SLICE_BYTES:
        cuts = list(_pieces(part.data, part.bounds))
    else:
        cuts = [(0, len(part.data))]
    hashes, places = [], []
    for at, end in cuts:
        data = part.data[at:end]
        if not len(data):
            continue
        inside = IS_WORD[data]
        edges = part.bounds[(part.bounds > at) & (part.bounds < end)] - at
        begins = inside.copy()
        begins[1:] &= ~inside[:-1]
        begins[edges] = inside[edges]
        stops = inside.copy()
        stops[:-1] &= ~inside[1:]
        stops[edges - 1] = inside[edges - 1]
        starts = np.flatnonzero(begins)
        hashes.append(span_hashes(LOWER[data], starts, np.flatnonzero(stops) + 1))
        places.append(starts + at)
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(len(part.bounds), np.int64)
    places = np.concatenate(places)
    return np.concatenate(hashes), places, np.searchsorted(places, part.bounds)


def grams(hashes: np.ndarray, k: int) -> np.ndarray:
    """A hash of the k words from each position on; shorter than the input by k - 1."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = hashes[:n].copy()
    for i in range(1, k):
        out *= _GRAM_BASE
        out += hashes[i : i + n]
    return mixed(out + np.uint64(k))


def flat(counts: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The positions start, start + 1, ... for each count, one after the other."""
    counts = np.asarray(counts, np.int64)
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(np.asarray(starts) - (ends - counts), counts)
