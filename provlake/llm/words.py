"""Words of many texts at once, as 64-bit hashes, inside Arrow-batched tasks.

A batch of texts is one byte buffer. Word borders come from a table of 256 byte classes
(bytes above 0x7F always belong to words, so UTF-8 needs no decoding), and a word's hash is a
polynomial over its bytes, taken from running sums modulo 2**64. Texts are worked on in pieces
of bounded size, cut between words, so one very long text needs no more than its word list.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text turned into words at once; bounds the memory of a task, not what is read.
PIECE = 1 << 19


def _spread(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that mixes all bits (splitmix64's finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BYTE = _spread(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_BASE, _STEP = 0xD1342543DE82EF95, np.uint64(0x9FB21C651E98DF25)
_powers: dict[str, np.ndarray] = {}


def _byte_class(inside) -> np.ndarray:
    return np.array([b > 0x7F or inside(b) for b in range(256)])


#: Letters and digits; what `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` takes after lower-casing.
ALNUM = _byte_class(lambda b: 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A)
#: All but ASCII white space; what `[^\x20\x09-\x0D]+` takes.
SPACED = _byte_class(lambda b: b != 0x20 and not 0x09 <= b <= 0x0D)


class Words(NamedTuple):
    """Words of some consecutive rows; ``row`` counts from the first of them, bytes from ``data``."""

    data: np.ndarray
    row: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers.get("up", ())) < n:
        size = max(n, PIECE + 4096)
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            factors = np.full(size, base, np.uint64)
            factors[0] = 1
            _powers[name] = np.multiply.accumulate(factors)
    return _powers["up"], _powers["down"]


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a string column; null counts as empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8)[at[0]:at[-1]] if data is not None and at[-1] > at[0] else np.zeros(0, np.uint8)
    return raw, at - at[0]


def _borders(low: np.ndarray, cuts: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    word = inside[low]
    first, last = word.copy(), word.copy()
    first[1:] &= ~word[:-1]
    last[:-1] &= ~word[1:]
    cuts = cuts[(cuts > 0) & (cuts < len(low))]
    first[cuts] = word[cuts]
    last[cuts - 1] = word[cuts - 1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each span; equal bytes, equal hash."""
    up, down = _power(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * up[:len(data)], out=total[1:])
    value = (total[end] - total[start]) * down[start]
    return _spread(value ^ ((end - start).astype(np.uint64) * _STEP))


def words(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> Words:
    parts, at, n = [], 0, len(data)
    while at < n:
        to = min(n, at + PIECE)
        while to < n and inside[_LOWER[data[to]]]:  # only between words
            ahead = np.flatnonzero(~inside[_LOWER[data[to:to + 4096]]])
            to = to + int(ahead[0]) if len(ahead) else min(n, to + 4096)
        low = _LOWER[data[at:to]]
        cuts = offsets[np.searchsorted(offsets, at, "right"):np.searchsorted(offsets, to, "left")] - at
        start, end = _borders(low, np.unique(cuts), inside)
        parts.append((start + at, end + at, span_hashes(low, start, end)))
        at = to
    start, end, value = (np.concatenate(x) for x in zip(*parts, strict=True)) if parts else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64))
    row = np.searchsorted(offsets, start, "right") - 1
    return Words(data, row, start, end, value)


def part_hashes(found: Words, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of parts of the words, lower-cased; one part for each word, in order."""
    out, at = [], 0
    while at < len(start):
        to = max(at + 1, int(np.searchsorted(found.end, found.start[at] + PIECE)))
        low = _LOWER[found.data[found.start[at]:found.end[to - 1]]]
        out.append(span_hashes(low, start[at:to] - found.start[at], end[at:to] - found.start[at]))
        at = to
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def grams(value: np.ndarray, row: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of every k words in a row of one text, and the index of their first word."""
    n = len(value) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    whole = np.flatnonzero(row[:n] == row[k - 1:])
    out = np.full(len(whole), k, np.uint64)
    for j in range(k):
        out = out * _STEP + value[whole + j]
    return _spread(out), whole


def pieces(batch: pa.RecordBatch, text: str = "text", size: int = PIECE) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of rows of about ``size`` bytes: first row, row after the last, bytes, offsets."""
    data, offsets = utf8(batch.column(batch.schema.get_field_index(text)))
    at, n = 0, len(offsets) - 1
    while at < n:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + size, "right")) - 1)
        yield at, to, data[offsets[at]:offsets[to]], offsets[at:to + 1] - offsets[at]
        at = to
    pa.default_memory_pool().release_unused()  # a worker is kept for later tasks, its spare memory need not be


def word_text(found: Words, first: int, k: int) -> bytes:
    """k words from ``first`` on, lower-cased, with single blanks between."""
    low = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
    return b" ".join(found.data[found.start[i]:found.end[i]].tobytes().translate(low) for i in range(first, first + k))
