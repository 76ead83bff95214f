"""Vectorised scanning of UTF-8 text in Arrow batches (numpy; no per-word Python).

A batch's string column is one byte buffer with row offsets. Words, lines and n-gram windows are
found with array operations over that buffer and identified by 64-bit hashes:

* a span's hash is the polynomial ``sum(T[byte_j] * B**j) mod 2**64`` over a table ``T`` of random
  words and an odd base, taken from one running sum, then mixed (splitmix64 finaliser);
* a window's hash is a mixed linear form of its words' hashes.

Two different strings share a hash with probability about 2**-64 a pair; the operators that must
be exact compare within one document or one pair of documents, where that is negligible.
Rows are taken in chunks of at most ``CHUNK_BYTES`` (a longer text is a chunk of its own), so memory
is bounded by the longest text. Null texts count as empty.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 19
_U = np.uint64
_rng = np.random.Generator(np.random.PCG64(20240229))
BYTE_VALUE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * _U(2) + _U(1)
WINDOW_FACTOR = _rng.integers(1, 1 << 63, 64, dtype=np.uint64) * _U(2) + _U(1)
BASE = _U(0x9E3779B97F4A7C15 | 1)
BASE_INVERSE = _U(pow(int(BASE), -1, 1 << 64))


def byte_set(chars: bytes) -> np.ndarray:
    """A 256-entry membership table."""
    t = np.zeros(256, bool)
    t[list(chars)] = True
    return t


#: Space and U+0009 to U+000D: what separates words.
SPACE = byte_set(b" \t\n\x0b\x0c\r")
#: Everything in ASCII but letters and digits: separates words where punctuation doesn't count.
NOT_ALNUM = byte_set(bytes(b for b in range(128) if not chr(b).isalnum()))
#: Bytes that continue a character of several bytes.
CONTINUES = byte_set(bytes(range(0x80, 0xC0)))
NEWLINE = byte_set(b"\n")
IDENTITY = np.arange(256, dtype=np.uint8)
#: A-Z to a-z, all else unchanged.
ASCII_LOWER = np.where((IDENTITY >= 65) & (IDENTITY <= 90), IDENTITY + 32, IDENTITY).astype(np.uint8)

_powers = np.ones(1, np.uint64)
_inverses = np.ones(1, np.uint64)


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers, _inverses
    if len(_powers) < n:
        size = max(n, CHUNK_BYTES + 1)
        with np.errstate(over="ignore"):
            _powers = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(size, BASE)]))
            _inverses = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(size, BASE_INVERSE)]))
    return _powers, _inverses


def mix(h: np.ndarray) -> np.ndarray:
    """splitmix64's finaliser."""
    with np.errstate(over="ignore"):
        h = (h ^ (h >> _U(30))) * _U(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> _U(27))) * _U(0x94D049BB133111EB)
        return h ^ (h >> _U(31))


def chunks(column: pa.Array, max_bytes: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, row offsets into bytes) for runs of rows of at most max_bytes."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "").cast(pa.large_binary())
    n = len(column)
    if not n:
        return
    _, off, data = column.buffers()
    offsets = np.frombuffer(off, np.int64)[column.offset:column.offset + n + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    at = 0
    while at < n:
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + max_bytes, "right")) - 1)
        end = min(end, n)
        yield at, end, raw[offsets[at]:offsets[end]], offsets[at:end + 1] - offsets[at]
        at = end


def per_row(mask: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many positions of each row are set."""
    total = np.zeros(len(mask) + 1, np.int64)
    np.cumsum(mask, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]


def running_hash(data: np.ndarray) -> np.ndarray:
    powers, _ = _power_tables(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(BYTE_VALUE[data] * powers[:len(data)], out=total[1:])
    return total


def span_hash(total: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    _, inverses = _power_tables(len(total))
    return mix((total[ends] - total[starts]) * inverses[starts])


@dataclass
class Spans:
    """Words (or lines) of a chunk: byte starts and ends, and for each row its first span's number."""

    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray  # one more than rows

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def rows(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts)


def words(data: np.ndarray, offsets: np.ndarray, separators: np.ndarray = SPACE) -> Spans:
    """Maximal runs of bytes outside ``separators`` that don't cross a row's end."""
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = ~separators[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    starts = np.flatnonzero(inside[1:-1] & (~inside[:-2] | edge[:-1]))
    ends = np.flatnonzero(inside[1:-1] & (~inside[2:] | edge[1:])) + 1
    return Spans(starts, ends, np.searchsorted(starts, offsets))


def lines(data: np.ndarray, offsets: np.ndarray) -> Spans:
    """The rows split at newlines; a row without any is one line, an empty row one empty line."""
    cut = np.flatnonzero(data == 10)
    starts = np.sort(np.concatenate([offsets[:-1], cut + 1]), kind="stable")
    rows = np.searchsorted(cut, offsets)  # newlines before each row
    first = rows + np.arange(len(offsets))
    ends = np.sort(np.concatenate([offsets[1:], cut]), kind="stable")
    return Spans(starts, ends, first)


def word_hashes(data: np.ndarray, spans: Spans, fold: np.ndarray = IDENTITY) -> np.ndarray:
    return span_hash(running_hash(fold[data]), spans.starts, spans.ends)


def windows(hashes: np.ndarray, first: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all n-word windows and, for each row, its first window's number. Rows of fewer
    than n words have none."""
    counts = np.maximum(np.diff(first) - (n - 1), 0)
    begin = np.concatenate([[0], np.cumsum(counts)])
    total = len(hashes) - n + 1
    if total <= 0 or not begin[-1]:
        return np.zeros(0, np.uint64), np.zeros(len(first), np.int64)
    h = np.zeros(total, np.uint64)
    for k in range(n):
        h += hashes[k:k + total] * WINDOW_FACTOR[k]
    at = np.repeat(first[:-1] - begin[:-1], counts) + np.arange(begin[-1])
    return mix(h[at]), begin
