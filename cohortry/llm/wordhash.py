"""Hashes of all words of a batch of texts at once, in numpy over the UTF-8 bytes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from cohortry.llm.common import offsets, raw_bytes

#: Odd factor of the rolling hash and its inverse modulo 2^64.
FACTOR = 0x9E3779B97F4A7C15
INVERSE = pow(FACTOR, -1, 2**64)


def _byte_tables(keep_punctuation: bool) -> tuple[np.ndarray, np.ndarray]:
    """What each byte counts as (A-Z lower-cased, 0 for a break), and a spread value for each byte."""
    seen = np.arange(256, dtype=np.uint8)
    seen[65:91] += 32
    seen[[9, 10, 11, 12, 13, 32]] = 0
    if not keep_punctuation:
        for low, high in ((33, 48), (58, 65), (91, 97), (123, 127)):
            seen[low:high] = 0
    return seen, mix(np.arange(256, dtype=np.uint64))


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: equal inputs to equal outputs, all bits spread."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_POWERS: dict[int, np.ndarray] = {}


def _powers(n: int, base: int) -> np.ndarray:
    """The first ``n`` powers of ``base``; kept for the next batch."""
    if base not in _POWERS or len(_POWERS[base]) < n:
        _POWERS[base] = np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(n, base, np.uint64))])
    return _POWERS[base][:n]


TABLES = {True: _byte_tables(True), False: _byte_tables(False)}


def word_hashes(column: pa.Array, keep_punctuation: bool = False, prefixes: tuple[int, ...] = ()) -> tuple[np.ndarray, ...]:
    """Of a string column without nulls: word hashes, first word of each text (one entry more than texts), each word's first
    byte and the byte after its last among all bytes of the column, and for each length in ``prefixes`` the hashes of the
    words' first bytes (0 for shorter words).

    Words are lower-cased in A-Z and end at ASCII blanks, and unless ``keep_punctuation`` at ASCII punctuation; a text's
    end ends a word. Words of equal bytes have equal hashes wherever they stand; a prefix never equals a whole word.
    """
    ends, data = offsets(column), raw_bytes(column)
    seen, values = TABLES[keep_punctuation]
    chars = seen[data]
    inside = np.zeros(len(chars) + 1, bool)
    inside[:-1] = chars > 0
    starts_mask = inside.copy()
    starts_mask[1:] &= ~inside[:-1]
    heads = ends[:-1][ends[:-1] < len(chars)]
    starts_mask[heads] |= inside[heads]
    starts = np.flatnonzero(starts_mask)
    stops = np.flatnonzero(inside[:-1] & (~inside[1:] | starts_mask[1:])) + 1
    sums = np.zeros(len(chars) + 1, np.uint64)
    np.cumsum(values[chars] * _powers(len(chars), FACTOR), out=sums[1:])
    back = _powers(len(chars) + 1, INVERSE)[starts]
    lengths = (stops - starts).astype(np.uint64)
    hashes = mix((sums[stops] - sums[starts]) * back + lengths)
    more = [np.where(lengths >= n, mix((sums[np.minimum(starts + n, stops)] - sums[starts]) * back + np.uint64(n << 32)), np.uint64(0)) for n in prefixes]
    return hashes, np.searchsorted(starts, ends).astype(np.int64), starts, stops, *more


def ngram_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the n consecutive words from each position on (the last n - 1 positions fall away)."""
    count = max(len(hashes) - n + 1, 0)
    out = np.zeros(count, np.uint64)
    for i in range(n):
        out = mix(out * np.uint64(FACTOR) + hashes[i : i + count])
    return out
