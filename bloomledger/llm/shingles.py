"""Words and word shingles of UTF-8 text as 64-bit hashes, in bulk."""

from __future__ import annotations

import numpy as np

from bloomledger.llm.common import mix64

SHINGLE_WORDS = 5

_RANDOM = np.random.default_rng(20240229)
_BYTE_CODES = _RANDOM.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_STEP = np.uint64(0xD1342543DE82EF95)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
IS_BLANK = np.zeros(256, bool)
IS_BLANK[[32, *range(9, 14)]] = True


def _powers(n: int) -> np.ndarray:
    out = np.full(max(n, 1), _STEP, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, row and start of every word (a run without ASCII white space, A-Z lowered)."""
    n_rows = len(offsets) - 1
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    letter = ~IS_BLANK[data]
    first = letter.copy()
    first[1:] &= ~letter[:-1]
    row_starts = offsets[:-1][np.diff(offsets) > 0]
    first[row_starts] = letter[row_starts]
    starts = np.flatnonzero(first)
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    number = np.cumsum(first) - 1
    place = np.arange(len(data)) - starts[np.maximum(number, 0)]
    np.maximum(place, 0, out=place)
    place[~letter] = 0
    values = _BYTE_CODES[LOWER[data]] * _powers(int(place.max()) + 1)[place]
    values[~letter] = 0
    hashes = mix64(np.add.reduceat(values, starts))
    rows = np.searchsorted(offsets, starts, side="right") - 1
    return hashes, np.minimum(rows, n_rows - 1), starts


def _chain(words: np.ndarray, length: int) -> np.ndarray:
    """Hash of each run of `length` words."""
    n = len(words) - length + 1
    out = np.full(max(n, 0), np.uint64(length), np.uint64)
    for j in range(length):
        out = mix64(out * _STEP + words[j : j + n])
    return out


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of every row.

    A row with fewer words than a shingle has its whole sequence as the one shingle; a
    row without words has none.
    """
    hashes, rows, _ = word_hashes(data, offsets)
    n_rows = len(offsets) - 1
    bounds = np.searchsorted(rows, np.arange(n_rows + 1))
    chained = _chain(hashes, SHINGLE_WORDS)
    out = []
    for start, end in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        n = end - start
        if n >= SHINGLE_WORDS:
            out.append(np.unique(chained[start : end - SHINGLE_WORDS + 1]))
        elif n:
            out.append(_chain(hashes[start:end], n))
        else:
            out.append(np.zeros(0, np.uint64))
    return out
