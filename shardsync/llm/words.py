"""Words and word shingles of many texts at once, as 64-bit hashes."""

from __future__ import annotations

import numpy as np
import xxhash

#: Bytes beyond which a word's polynomial hash is not used: it has equal values for
#: some words of a thousand bytes and more.
LONG_WORD = 64
_STEP = 0x9E3779B97F4A7C15
_STEP_BACK = pow(_STEP, -1, 1 << 64)
_powers = (np.ones(1, np.uint64), np.ones(1, np.uint64))

#: A-Z in lower case, every other byte as it is.
FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32

#: Bytes that separate words: blank and the control blanks.
BLANKS = np.zeros(256, bool)
BLANKS[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

#: Bytes that separate words made of letters, digits and everything beyond ASCII.
NOT_WORD = np.ones(256, bool)
NOT_WORD[0x30:0x3A] = NOT_WORD[0x41:0x5B] = NOT_WORD[0x61:0x7B] = False
NOT_WORD[0x80:] = False


def mix(h: np.ndarray) -> np.ndarray:
    """Scramble 64-bit numbers one to one, so that all bits depend on all bits."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _steps(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers
    if len(_powers[0]) < n:
        size = max(n, 1 << 16)
        _powers = tuple(
            np.multiply.accumulate(
                np.concatenate([np.ones(1, np.uint64), np.full(size - 1, s, np.uint64)])
            )
            for s in (_STEP, _STEP_BACK)
        )
    return _powers[0][:n], _powers[1]


def words(
    data: np.ndarray, offsets: np.ndarray, separators: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and hash of every word of the texts that ``offsets`` cuts out of
    ``data``. Upper and lower case of A-Z hash alike."""
    if not len(data):
        none = np.empty(0, np.int64)
        return none, none, none.astype(np.uint64)
    inside = ~separators[data]
    cut = np.zeros(len(data) + 1, bool)
    cut[offsets] = True
    before = np.concatenate([[False], inside[:-1]])
    after = np.concatenate([inside[1:], [False]])
    starts = np.flatnonzero(inside & (~before | cut[:-1]))
    ends = np.flatnonzero(inside & (~after | cut[1:])) + 1
    up, down = _steps(len(data))
    total = np.concatenate(
        [np.zeros(1, np.uint64), np.cumsum((FOLD[data].astype(np.uint64) + np.uint64(1)) * up)]
    )
    hashes = (total[ends] - total[starts]) * down[starts]
    for i in np.flatnonzero(ends - starts > LONG_WORD):
        hashes[i] = xxhash.xxh3_64_intdigest(FOLD[data[starts[i] : ends[i]]].tobytes())
    return starts, ends, mix(hashes + (ends - starts).astype(np.uint64))


def shingles(word_hashes: np.ndarray, size: int = 5) -> np.ndarray:
    """The distinct shingles of one text, sorted. With fewer words than ``size``,
    the whole sequence is the only one; no words, none."""
    n = len(word_hashes)
    if not n:
        return word_hashes
    width = min(n, size)
    out = np.full(n - width + 1, width, np.uint64)
    for k in range(width):
        out = mix(out ^ word_hashes[k : n - width + 1 + k])
    return np.unique(out)
