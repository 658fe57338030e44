"""Words and word shingles of whole Arrow text columns as 64-bit hashes, computed for a run of texts at a time.

A word is a maximal run of bytes that are digits, ASCII letters (A-Z lower-cased) or above 7F, which for UTF-8 is the
run of characters outside \\x00-\\x2F, \\x3A-\\x60 (after lower-casing) and \\x7B-\\x7F.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

PIECE = 1 << 18  # bytes hashed at once, so that working arrays stay at a few MB however long a text is

_LUT = np.zeros(256, dtype=np.uint8)  # byte → lower-cased byte of a word, 0 between words
_LUT[0x30:0x3A] = np.arange(0x30, 0x3A)
_LUT[0x61:0x7B] = np.arange(0x61, 0x7B)
_LUT[0x41:0x5B] = np.arange(0x61, 0x7B)
_LUT[0x80:] = np.arange(0x80, 0x100)

_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse mod 2^64
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse mod 2^64, at least ``n`` of each; kept for the sizes that come again."""
    size = max(PIECE, n)
    if size not in _POWERS:
        def run(b: int) -> np.ndarray:
            out = np.full(size, b & (2 ** 64 - 1), dtype=np.uint64)
            out[0] = 1
            return np.multiply.accumulate(out)
        made = run(_BASE), run(pow(_BASE, -1, 2 ** 64))
        if size > PIECE:
            return made  # one giant word: not kept
        _POWERS[size] = made
    return _POWERS[size]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (the finaliser of splitmix64)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def words_of_bytes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, start, end) of every word of one text's bytes; equal words have equal hashes."""
    hashes, starts, ends = [], [], []
    at, n = 0, len(data)
    while at < n:
        to = min(n, at + PIECE)
        low = _LUT[data[at:to]]
        while to < n and low[-1]:  # the piece ends inside a word: leave the word to the next piece, or read on
            gaps = np.flatnonzero(low == 0)
            if len(gaps):
                to = at + int(gaps[-1]) + 1
                low = low[:to - at]
            else:
                to = min(n, to + PIECE)
                low = _LUT[data[at:to]]
        inside = np.concatenate(([0], (low != 0).view(np.int8), [0]))
        edge = np.diff(inside)
        s, e = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        if len(s):
            up, down = _powers(len(low))
            total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(low.astype(np.uint64) * up[:len(low)])))
            hashes.append(mix((total[e] - total[s]) * down[s]))
            starts.append(s + at)
            ends.append(e + at)
        at = to
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(hashes), np.concatenate(starts), np.concatenate(ends)


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of ``size`` consecutive words."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    h = np.full(n, size, dtype=np.uint64)
    for i in range(size):
        h = mix(h * np.uint64(0xD6E8FEB86659FD93) + words[i:i + n])
    return h


def texts(column: pa.Array) -> Iterator[np.ndarray]:
    """The UTF-8 bytes of each text of a string column, without copies; a null is empty."""
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    for start, end in zip(ends[:-1].tolist(), ends[1:].tolist()):
        yield raw[start:end]


def words_text(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, first: int, last: int) -> str:
    """Words ``first`` to ``last`` (exclusive) joined by one space."""
    return b" ".join(_LUT[data[s:e]].tobytes() for s, e in zip(starts[first:last].tolist(), ends[first:last].tolist())).decode("utf-8", "replace")
