"""Numpy views of Arrow text columns and vectorised 64-bit hashing of words and shingles."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Words are split at these bytes: space and 9 to 13.
SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_RNG = np.random.Generator(np.random.PCG64(20240521))
_BYTE_VALUE = _RNG.integers(0, 2**64, 256, dtype=np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))
#: Texts are hashed in blocks of about so many bytes, cut between words.
BLOCK = 1 << 18
_powers = {}


def utf8(column) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text or binary column and the offsets of its rows; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    n = len(column)
    offsets = np.frombuffer(column.buffers()[1], np.int64, n + 1, column.offset * 8) if n else np.zeros(1, np.int64)
    data = column.buffers()[2]
    return (np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)), offsets


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(base: np.uint64, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        have = np.full(max(n, BLOCK + 1), base, np.uint64)
        have[0] = 1
        have = np.multiply.accumulate(have)
        if n <= 4 * BLOCK:
            _powers[base] = have
    return have[:n]


def _hash_block(data: np.ndarray, cuts: np.ndarray, lower: bool) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of one block; `cuts` are row starts inside it. Returns hashes and word starts."""
    gap = SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[cuts] = True
    before = np.concatenate(([True], gap[:-1])) | edge[:-1]
    after = np.concatenate((gap[1:], [True])) | edge[1:]
    starts = np.flatnonzero(~gap & before)
    ends = np.flatnonzero(~gap & after) + 1
    value = _BYTE_VALUE[LOWER[data] if lower else data] * powers(_BASE, len(data))
    total = np.concatenate((np.zeros(1, np.uint64), np.add.accumulate(value)))
    h = (total[ends] - total[starts]) * powers(_BASE_INVERSE, len(data))[starts]
    return mix(h + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)), starts


def word_hashes(data: np.ndarray, offsets: np.ndarray, lower: bool = True) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Yields (first row, row after the last, hashes of their words, word offsets by row) for runs of rows.

    A row longer than BLOCK comes alone; its words are hashed piece by piece, so memory holds eight bytes
    a word plus some blocks. Equal words have equal hashes wherever they stand.
    """
    n, row = len(offsets) - 1, 0
    with np.errstate(over="ignore"):
        while row < n:
            last = max(row + 1, int(np.searchsorted(offsets, offsets[row] + BLOCK, "right")) - 1)
            part = data[offsets[row] : offsets[last]]
            if len(part) <= BLOCK:
                if len(part):
                    h, starts = _hash_block(part, offsets[row:last] - offsets[row], lower)
                else:
                    h, starts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
                bounds = np.searchsorted(starts, offsets[row : last + 1] - offsets[row])
            else:
                found, at = [], 0
                while at < len(part):
                    stop = min(at + BLOCK, len(part))
                    if stop < len(part):
                        gaps = np.flatnonzero(SPACE[part[at:stop]])
                        while not len(gaps) and stop < len(part):  # a word longer than a block
                            stop = min(stop + BLOCK, len(part))
                            gaps = np.flatnonzero(SPACE[part[at:stop]])
                        if len(gaps) and stop < len(part):
                            stop = at + int(gaps[-1]) + 1
                    found.append(_hash_block(part[at:stop], np.zeros(1, np.int64), lower)[0])
                    at = stop
                h = np.concatenate(found)
                bounds = np.array([0, len(h)])
            yield row, last, h, bounds
            row = last


def shingle_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all runs of `width` words; of fewer words, one hash of the whole sequence; of none, none."""
    with np.errstate(over="ignore"):
        factors = powers(np.uint64(0xA0761D6478BD642F), width)
        if not len(words):
            return words
        if len(words) < width:
            return mix(np.atleast_1d((words * factors[: len(words)]).sum(dtype=np.uint64) + np.uint64(len(words))))
        n = len(words) - width + 1
        total = words[:n] * factors[0]
        for i in range(1, width):
            total = total + words[i : i + n] * factors[i]
        return mix(total)
