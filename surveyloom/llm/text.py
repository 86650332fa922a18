"""Words, shingles and their hashes over Arrow text columns, in numpy.

Everything works on the UTF-8 bytes of a batch. A separator is always an ASCII byte, so a word never ends inside a character.
Hashes are 64 bits wide and the same on every machine and run.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes looked at together; the temporaries of a window take about 40 bytes for each.
WINDOW = 1 << 20

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


class WordKind(NamedTuple):
    """member: which bytes belong to words; value: what a byte adds to the hash of its word."""

    member: np.ndarray
    value: np.ndarray


def _kind(separators: set[int], folded: bool) -> WordKind:
    member = np.array([b not in separators for b in range(256)])
    value = np.random.default_rng(20240229).integers(1, 2**64, 256, dtype=np.uint64) | np.uint64(1)
    if folded:
        value[65:91] = value[97:123]
    return WordKind(member, value)


_SPACE = {0x20, *range(0x09, 0x0E)}
#: `[^\x20\x09-\x0D]+`, A-Z read as a-z.
SPACED_WORDS = _kind(_SPACE, True)
#: The same words with their case.
EXACT_WORDS = _kind(_SPACE, False)
#: `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` of text in which A-Z is lower-cased.
ALNUM_WORDS = _kind({*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)}, True)
#: Letters only; every byte of a character beyond ASCII counts as one.
LETTER_WORDS = _kind({*range(0x00, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)}, False)

#: The same words with A-Z read as a-z.
FOLDED_LETTERS = _kind({*range(0x00, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)}, True)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts and where each begins (one more offset than rows). A null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, ends, data = column.buffers()
    offsets = np.frombuffer(ends, np.int64)[column.offset : column.offset + len(column) + 1]
    bytes_ = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return bytes_[offsets[0] : offsets[-1]], offsets - offsets[0]


def row_groups(offsets: np.ndarray, limit: int = 4 * WINDOW) -> Iterator[tuple[int, int]]:
    """Row ranges of at most about `limit` bytes; a longer text is a range of its own."""
    low, rows = 0, len(offsets) - 1
    while low < rows:
        high = int(np.searchsorted(offsets, offsets[low] + limit, side="right")) - 1
        high = min(max(high, low + 1), rows)
        yield low, high
        low = high


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection that spreads every bit."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


class Words(NamedTuple):
    """Byte range and hash of each word, and the number of the first word of each text (one more entry than texts)."""

    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    first: np.ndarray


def _windows(data: np.ndarray, member: np.ndarray) -> Iterator[tuple[int, int]]:
    low, size = 0, len(data)
    while low < size:
        high = min(low + WINDOW, size)
        while high < size:
            back = np.flatnonzero(~member[data[max(low, high - 4096) : high]])
            if len(back):
                high = max(low, high - 4096) + int(back[-1]) + 1
                break
            high = min(high + 4096, size)
        yield low, high
        low = high


def words(data: np.ndarray, offsets: np.ndarray, kind: WordKind) -> Words:
    """All words of all texts. A text begins a new word even where no separator precedes it."""
    begins, ends, hashes = [], [], []
    for low, high in _windows(data, kind.member):
        part = data[low:high]
        member = kind.member[part]
        inside = offsets[np.searchsorted(offsets, low, side="left") : np.searchsorted(offsets, high, side="left")] - low
        opens = member.copy()
        opens[1:] &= ~member[:-1]
        opens[inside] = member[inside]
        closes = member.copy()
        closes[:-1] &= ~member[1:]
        before = inside[inside > 0] - 1
        closes[before] = member[before]
        start, end = np.flatnonzero(opens), np.flatnonzero(closes) + 1
        if not len(start):
            continue
        length = end - start
        origin = np.cumsum(length) - length
        place = np.arange(int(length.sum())) - np.repeat(origin, length)
        with np.errstate(over="ignore"):
            powers = np.multiply.accumulate(np.full(int(length.max()), _MULTIPLIER))
            value = kind.value[part[member]] * powers[place]
            hashes.append(mix(np.add.reduceat(value, origin)))
        begins.append(start + low)
        ends.append(end + low)
    if not begins:
        none = np.zeros(0, np.int64)
        return Words(none, none, np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64))
    start = np.concatenate(begins)
    first = np.searchsorted(start, offsets, side="left")
    return Words(start, np.concatenate(ends), np.concatenate(hashes), first)


def shingles(found: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of `size` words, and the first shingle of each text.

    A text with fewer words, but not none, has its whole sequence as one shingle.
    """
    count = np.diff(found.first)
    runs = np.where(count > 0, np.maximum(count - size + 1, 1), 0)
    first = np.concatenate([[0], np.cumsum(runs)])
    at = np.arange(int(first[-1])) - np.repeat(first[:-1] - found.first[:-1], runs)
    stop = np.repeat(found.first[1:], runs)
    with np.errstate(over="ignore"):
        h = np.zeros(len(at), np.uint64)
        for j in range(size):
            here = at + j
            ok = here < stop
            if ok.all():
                h = h * _MULTIPLIER + found.hash[here]
            else:
                h = np.where(ok, h * _MULTIPLIER + found.hash[np.minimum(here, len(found.hash) - 1)], h)
        return mix(h), first


def has_letter(text: str | None) -> bool:
    return bool(text) and any(c.isalpha() for c in text)
