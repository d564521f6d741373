"""Words of whole texts as arrays: positions and 64-bit hashes, computed for many texts at once.

A word is a longest run of ASCII digits, ASCII letters (A-Z counted as a-z) and characters
beyond ASCII: ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text with A-Z lower-cased. In UTF-8
every byte of a character beyond ASCII is above 0x7F, so bytes decide.
"""

from __future__ import annotations

import hashlib
from typing import NamedTuple

import numpy as np
import pyarrow as pa

#: Longer words have a hash of another kind: long words can be made whose sums modulo 2**64 agree whatever the base.
LONG = 64
#: Bytes treated at a time; bounds the working arrays, not the texts.
BLOCK = 1 << 20

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
IN_WORD = np.zeros(256, dtype=bool)
IN_WORD[48:58] = IN_WORD[65:91] = IN_WORD[97:123] = IN_WORD[128:] = True


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits that spreads every bit (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_VALUE = _mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_BASE = 0x9E6C63D0876A9A47 | 1
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64, for i below n."""
    size = -(-n // 65536) * 65536
    if not any(held >= n for held in _POWERS):
        ups = []
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            a = np.full(size, base, dtype=np.uint64)
            a[0] = 1
            ups.append(np.cumprod(a, dtype=np.uint64))
        _POWERS.clear()
        _POWERS[size] = tuple(ups)
    return next(iter(_POWERS.values()))


def _long_hash(word: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(word.tobytes(), digest_size=8).digest(), "little")


class Words(NamedTuple):
    """Words of consecutive texts: text i owns words first[i]:first[i + 1]."""

    data: np.ndarray  # all bytes, as given
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    first: np.ndarray

    def text(self, k: int) -> str:
        return LOWER[self.data[self.start[k] : self.end[k]]].tobytes().decode("utf-8", "replace")

    def span(self, a: int, b: int) -> str:
        """Words a to b - 1 in one string, single spaces between."""
        return " ".join(self.text(k) for k in range(a, b))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column and where each text begins; a null is an empty text."""
    column = column.cast(pa.large_binary()).fill_null(b"")
    if not len(column):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    buffer = column.buffers()[2]
    data = np.frombuffer(buffer, dtype=np.uint8) if buffer is not None else np.empty(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def find_words(data: np.ndarray, offsets: np.ndarray, kinds: np.ndarray = IN_WORD, fold: np.ndarray = LOWER) -> Words:
    """Longest runs of bytes of one kind; kind 0 is outside words. Hashes are of the folded bytes."""
    starts, ends, hashes = [], [], []
    at, total = 0, len(data)
    edge = np.zeros(0, np.int64)
    values = _VALUE[fold]  # of bytes as given
    while at < total:
        stop = min(at + BLOCK, total)
        if stop < total:  # never cut a word in two: go on to the next byte outside a word, or the next text
            tail = stop
            while True:
                run = kinds[data[tail : tail + 4096]] > 0
                if not run.all() or tail + 4096 >= total:
                    tail += int(np.argmin(run)) if not run.all() else len(run)
                    break
                tail += 4096
            after = offsets[np.searchsorted(offsets, stop)]
            stop = int(min(tail, after, total))
        part = data[at:stop]
        kind = np.take(kinds, part)
        inside = kind > 0
        edge = offsets[np.searchsorted(offsets, at) : np.searchsorted(offsets, stop)] - at
        new = inside.copy()
        new[1:] &= kind[1:] != kind[:-1]
        new[edge] = inside[edge]
        last = inside.copy()
        last[:-1] &= ~inside[1:] | new[1:]
        s, e = np.flatnonzero(new), np.flatnonzero(last) + 1
        up, down = _powers(len(part) + 1)
        sums = np.zeros(len(part) + 1, np.uint64)
        powers = np.take(values, part)
        powers *= up[: len(part)]
        np.cumsum(powers, out=sums[1:])
        found = _mixed((np.take(sums, e) - np.take(sums, s)) * np.take(down, s))
        for k in np.flatnonzero(e - s > LONG).tolist():
            found[k] = _long_hash(fold[part[s[k] : e[k]]])
        hashes.append(found)
        starts.append(s + at)
        ends.append(e + at)
        at = stop
    start = np.concatenate(starts) if starts else np.zeros(0, np.int64)
    end = np.concatenate(ends) if ends else np.zeros(0, np.int64)
    hashed = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
    return Words(data, start, end, hashed, np.searchsorted(start, offsets))


def words_of(column: pa.Array) -> Words:
    return find_words(*text_bytes(column))


#: Words (1) and runs of ASCII punctuation (2).
MARKS = IN_WORD.astype(np.uint8)
MARKS[33:127] = np.where(IN_WORD[33:127], 1, 2)


def tokens_of(column: pa.Array) -> Words:
    """Words and runs of punctuation, with upper and lower case told apart."""
    return find_words(*text_bytes(column), MARKS, np.arange(256, dtype=np.uint8))


class Lookup:
    """Values by 64-bit key for many keys at once: sorted keys, entered by their leading bits."""

    def __init__(self, keys: np.ndarray, values: np.ndarray, missing: float):
        order = np.argsort(keys)
        self.keys, self.values, self.missing = keys[order], values[order], missing
        bits = max(4, int(len(keys)).bit_length())
        self.shift = np.uint64(64 - bits)
        self.first = np.searchsorted(self.keys >> self.shift, np.arange((1 << bits) + 1, dtype=np.uint64)).astype(np.int32)

    def __call__(self, asked: np.ndarray) -> np.ndarray:
        out = np.full(len(asked), self.missing, self.values.dtype)
        known, at = self._find(asked)
        out[known] = self.values[at]
        return out

    def has(self, asked: np.ndarray) -> np.ndarray:
        out = np.zeros(len(asked), bool)
        out[self._find(asked)[0]] = True
        return out

    def _find(self, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the asked keys there are, and where."""
        bucket = (asked >> self.shift).astype(np.int64)
        at, end = np.take(self.first, bucket), np.take(self.first[1:], bucket)
        open_ = np.flatnonzero(at < end)
        at, end, asked = np.take(at, open_), np.take(end, open_), np.take(asked, open_)
        known, places = [np.zeros(0, np.int64)], [np.zeros(0, np.int32)]
        while len(open_):
            found = np.take(self.keys, at) == asked
            hit = np.flatnonzero(found)
            known.append(np.take(open_, hit))
            places.append(np.take(at, hit))
            at += 1
            more = np.flatnonzero(~found & (at < end))
            open_, at, end, asked = np.take(open_, more), np.take(at, more), np.take(end, more), np.take(asked, more)
        return np.concatenate(known), np.concatenate(places)


def pieces(column: pa.Array, most: int = 2 * BLOCK):
    """(first, last) rows of consecutive slices of about ``most`` bytes; a longer text is a slice by itself."""
    column = column.cast(pa.large_binary()).fill_null(b"")
    if not len(column):
        return
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    a = 0
    while a < len(column):
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + most, side="right")) - 1)
        yield a, min(b, len(column))
        a = min(b, len(column))


def grams(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of k words, in order; (len - k + 1) of them, none if there are fewer words."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for j in range(k):
        out = (out * np.uint64(0x9FB21C651E98DF25)) ^ (hashes[j : j + n] + np.uint64(j + 1))
        out ^= out >> np.uint64(29)
    return _mixed(out)
