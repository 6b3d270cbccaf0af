"""Flat-array text primitives shared by the operators of this subpackage.

A batch of texts is one byte buffer with row offsets (Arrow's own layout).
Words are found and hashed with NumPy over that buffer, never one by one.
All hashes are fixed functions of the bytes: the same word has the same hash
in every task, run and table.
"""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Texts are worked on in blocks of about this many bytes (a longer text is a block of its own).
BLOCK_BYTES = 8 << 20
#: Inside a block, words are found in segments of about this many bytes.
SEGMENT_BYTES = 1 << 20

ODD = np.uint64(0x9E3779B97F4A7C15)
ASCII_SPACE = frozenset([0x20, *range(0x09, 0x0E)])


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit mixer (xor-shift and multiply)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def seeded(n: int, seed: int) -> np.ndarray:
    """``n`` fixed pseudo-random 64-bit values."""
    return mix(np.arange(1, n + 1, dtype=np.uint64) * ODD + np.uint64(seed))


@dataclass(frozen=True)
class WordRule:
    """Which bytes belong to words, and the value each byte counts as."""

    inside: np.ndarray  # bool[256]
    value: np.ndarray  # uint64[256]
    #: Bytes of kind 1 and of kind 2 don't share a word (None: no such cuts).
    kind: np.ndarray | None = None


def word_rule(separators, lower: bool, kinds: tuple[bytes, bytes] | None = None) -> WordRule:
    inside = np.ones(256, dtype=bool)
    inside[list(separators)] = False
    value = seeded(256, 11)
    if lower:
        value[0x41:0x5B] = value[0x61:0x7B]
    kind = None
    if kinds:
        kind = np.zeros(256, np.uint8)
        for k, members in enumerate(kinds, 1):
            kind[list(members)] = k
    return WordRule(inside, value, kind)


#: ``[^\x20\x09-\x0D]+``, letters as they are, and with A-Z lower-cased.
SPACED = word_rule(ASCII_SPACE, lower=False)
SPACED_LOWER = word_rule(ASCII_SPACE, lower=True)
#: ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` after lower-casing A-Z (so A-Z count as word bytes).
ALNUM_LOWER = word_rule([*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)], lower=True)


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets (int64, n + 1, from 0) of a string column; NULL is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    if len(column) == 0 or data is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    off = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    return np.frombuffer(data, np.uint8)[off[0] : off[-1]], off - off[0]


def blocks(batches: Iterator[pa.RecordBatch], text: str = "text", size: int = BLOCK_BYTES, rows: int = 1 << 30) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that each holds about ``size`` bytes of text and at most ``rows`` rows, one row at least."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, off = text_buffer(batch.column(batch.schema.get_field_index(text)))
        at = 0
        while at < batch.num_rows:
            end = min(at + rows, max(at + 1, int(np.searchsorted(off, off[at] + size, "right")) - 1))
            yield batch.slice(at, end - at)
            at = end
    give_back()


def give_back() -> None:
    """Return freed memory to the system at the end of a task: Python workers live on and serve other stages.

    Tables that are quickly made again go too, and Arrow's pool gives up what it holds in reserve.
    """
    _POWERS.clear()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # other C libraries have no such call
        ctypes.CDLL("libc.so.6").malloc_trim(0)


@dataclass
class Words:
    """Words of a block: byte ranges, hashes, and per row the range of its words."""

    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    row_first: np.ndarray  # int64[n + 1]

    @property
    def row(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.row_first) - 1), np.diff(self.row_first))


_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2^64."""
    size = 1 << max(int(n).bit_length(), 21)
    if size not in _POWERS:
        base = 0xD1342543DE82EF95
        _POWERS.clear()
        with np.errstate(over="ignore"):
            _POWERS[size] = tuple(np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(size - 1, b, np.uint64)]))
                                  for b in (base, pow(base, -1, 1 << 64)))
    return _POWERS[size]


def find_words(buf: np.ndarray, off: np.ndarray, rule: WordRule) -> Words:
    """All words of all rows; no word spans two rows."""
    starts, ends, hashes = [], [], []
    at, n = 0, len(buf)
    while at < n:
        end = min(n, at + SEGMENT_BYTES)
        if end < n:  # cut at a byte outside words or at a row's end
            gap = np.flatnonzero(~rule.inside[buf[end - 1 : end + SEGMENT_BYTES]])
            row_end = off[np.searchsorted(off, end)]
            end = int(min(end + gap[0] if len(gap) else n, row_end))
        s, e, h = _segment(buf[at:end], off[np.searchsorted(off, at, "left") : np.searchsorted(off, end, "right")] - at, rule)
        starts.append(s + at)
        ends.append(e + at)
        hashes.append(h)
        at = end
    start = np.concatenate(starts) if starts else np.zeros(0, np.int64)
    end = np.concatenate(ends) if ends else np.zeros(0, np.int64)
    hash_ = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
    return Words(start, end, hash_, np.searchsorted(start, off, "left").astype(np.int64))


def _segment(buf: np.ndarray, cuts: np.ndarray, rule: WordRule):
    """Words of one segment; ``cuts`` are the row boundaries inside it."""
    n = len(buf)
    inside = rule.inside[buf]
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = inside[:-1]
    before[cuts[(cuts >= 0) & (cuts < n)]] = False
    first = inside & ~before
    if rule.kind is not None and n:
        kind = rule.kind[buf]
        first[1:] |= inside[1:] & inside[:-1] & (kind[1:] + kind[:-1] == 3) & (kind[1:] > 0) & (kind[:-1] > 0)
    # a word ends where the next byte is outside, or starts another word
    last = inside.copy()
    last[:-1] &= ~inside[1:] | first[1:]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    power, inverse = _powers(n)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(rule.value[buf] * power[:n], out=total[1:])
    return start, end, mix((total[end] - total[start]) * inverse[start] + ODD)


def window_hashes(words: Words, width: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Rabin-Karp hash of every ``width`` consecutive words of a row.

    Returns (index of the first word, hash). The hash is the polynomial of the
    word hashes in an odd base given by ``seed``, modulo 2^64, then mixed.
    """
    n = len(words.hash)
    if n < width:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    base = seeded(1, seed)[0] | np.uint64(1)
    row = words.row
    at = np.flatnonzero(row[: n - width + 1] == row[width - 1 :])
    total = np.zeros(n - width + 1, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(width):
            total *= base
            total += words.hash[k : n - width + 1 + k]
    return at, mix(total[at])


def narrow(values: np.ndarray) -> bytes:
    """Whole numbers in the smallest width that holds them: one byte for the width, then the values."""
    kind = next(k for k in (np.uint8, np.uint16, np.uint32, np.uint64) if not len(values) or values.max() <= np.iinfo(k).max)
    return bytes([np.dtype(kind).itemsize]) + values.astype(kind).tobytes()


def wide(data: bytes) -> np.ndarray:
    return np.frombuffer(data, f"u{data[0]}", offset=1).astype(np.int64)


def cut_by(key: np.ndarray, *columns: np.ndarray) -> Iterator[tuple]:
    """Columns cut where a sorted key changes: (key, parts ...)."""
    cuts = np.flatnonzero(np.diff(key)) + 1
    for k, *parts in zip(np.split(key, cuts), *(np.split(c, cuts) for c in columns), strict=True):
        if len(k):
            yield (int(k[0]), *parts)
