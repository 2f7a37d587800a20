"""Words and word shingles of whole batches of texts, with numpy on the UTF-8 bytes."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_ODD = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0x5851F42D4C957F2D
_MASK = (1 << 64) - 1


def _word_bytes() -> np.ndarray:
    """Bytes of words: digits, letters and everything beyond ASCII."""
    out = np.zeros(256, bool)
    for first, last in ((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF)):
        out[first : last + 1] = True
    return out


def _lower_bytes() -> np.ndarray:
    out = np.arange(256, dtype=np.uint8)
    out[0x41:0x5B] += 0x20
    return out


IS_WORD, LOWER = _word_bytes(), _lower_bytes()


class _Powers:
    """Powers of an odd base modulo 2**64 and their inverses, as many as were needed so far."""

    def __init__(self):
        self.up, self.down = np.ones(1, np.uint64), np.ones(1, np.uint64)

    def of(self, n: int):
        if n > len(self.up):
            size = max(n, 2 * len(self.up))
            self.up, self.down = (
                np.cumprod(np.r_[np.uint64(1), np.full(size - 1, base, np.uint64)], dtype=np.uint64)
                for base in (_BASE, pow(_BASE, -1, 1 << 64))
            )
        return self.up[:n], self.down[:n]


_POWERS = _Powers()


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of an Arrow string array and the offsets of its texts; null counts as empty."""
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if data is None:
        return np.zeros(0, np.uint8), at - at[0]
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


@dataclass
class Words:
    """The words of some texts: byte ranges in `low`, hashes, and the first word of each text."""

    low: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray
    hashes: np.ndarray

    def text(self, a: int, b: int) -> str:
        """What stands from word a to before word b."""
        return self.low[self.starts[a] : self.ends[b - 1]].tobytes().decode()

    def shingles(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all runs of so many words within a text, and the words they start at."""
        n = len(self.starts) - length + 1
        if n <= 0:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        total = self.hashes[:n].copy()
        for j in range(1, length):
            total *= _ODD
            total += self.hashes[j : j + n]
        end = np.repeat(self.first[1:], np.diff(self.first))[:n]
        at = np.flatnonzero(np.arange(n) + length <= end)
        return mixed(total[at] + np.uint64(length)), at


PIECE = 1 << 20  # bytes that are looked at at once


def words_of(data: np.ndarray, offsets: np.ndarray, piece: int = PIECE) -> Words:
    """Words of the texts data[offsets[i]:offsets[i + 1]], A-Z lower-cased.

    Work arrays, many times as large as the text, are made for a piece at a time.
    """
    if len(data) <= 2 * piece:
        return _words_of(data, offsets)
    places = cuts_between_words(data, piece)
    parts = []
    for a, b in zip(places[:-1], places[1:], strict=True):
        inner = offsets[(offsets > a) & (offsets < b)] - a
        part = _words_of(data[a:b], np.concatenate([[0], inner, [b - a]]))
        parts.append((part.starts + a, part.ends + a, part.hashes))
    starts, ends, hashes = (np.concatenate(arrays) for arrays in zip(*parts, strict=True))
    return Words(LOWER[data], starts, ends, np.searchsorted(starts, offsets), hashes)


def _words_of(data: np.ndarray, offsets: np.ndarray) -> Words:
    low = LOWER[data]
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = IS_WORD[data]
    opens = inside[1:-1] & ~inside[:-2]
    closes = inside[1:-1] & ~inside[2:]
    # A border between texts ends a word as well.
    borders = offsets[1:-1][(offsets[1:-1] > 0) & (offsets[1:-1] < len(data))]
    opens[borders] = inside[1:-1][borders]
    closes[borders - 1] = inside[1:-1][borders - 1]
    starts, ends = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    up, down = _POWERS.of(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((low.astype(np.uint64) + np.uint64(1)) * up[:-1], out=sums[1:])
    hashes = mixed((sums[ends] - sums[starts]) * down[starts])
    return Words(low, starts, ends, np.searchsorted(starts, offsets), hashes)


def cuts_between_words(data: np.ndarray, limit: int) -> list[int]:
    """Places that cut a text into pieces of about `limit` bytes, never within a word.

    A piece is longer only where a word is.
    """
    at, places = 0, [0]
    while at + limit < len(data):
        at += limit
        while at < len(data):
            outside = np.flatnonzero(~IS_WORD[data[at : at + limit]])
            if len(outside):
                at += int(outside[0])
                break
            at = min(at + limit, len(data))
        places.append(at)
    if places[-1] < len(data):
        places.append(len(data))
    return places
