"""Character n-grams of words as hashed ids, for many words at a time (numpy)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

_U = np.uint64
_MULT, _MIX = _U(0x9E3779B97F4A7C15), _U(0xD6E8FEB86659FD93)
_PLACE = np.random.default_rng(41).integers(1, 1 << 62, 64, dtype=np.uint64) | _U(1)


def grams(words: list[str], n_min: int, n_max: int, buckets: int, whole: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(buckets of n-grams, their words' indices), for each n; words stand between two marks.

    `whole` adds the word itself as one more feature. `buckets` is a power of 2.
    """
    if not words:
        return
    text = "\x02" + "\x03\x02".join(words) + "\x03"
    chars = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32).astype(np.uint64)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 2)
    starts = np.concatenate(([0], ends[:-1]))
    word = np.repeat(np.arange(len(words), dtype=np.int32), ends - starts)
    left = (ends[word] - np.arange(len(chars))).astype(np.int32)  # characters up to the word's end
    shift, mask = _U(33), _U(buckets - 1)
    h = np.zeros(len(chars), np.uint64)
    for n in range(1, n_max + 1):
        h = h[:len(chars) - n + 1] * _MULT  # names chars[i : i + n]
        h += chars[n - 1:]
        if n < n_min:
            continue
        ok = np.flatnonzero(left[:len(h)] >= n)
        x = h[ok]
        x ^= x >> _U(29)
        x *= _MIX + _U(2 * n)
        yield ((x >> shift) & mask).astype(np.int32), word[ok]
    if whole:
        place = (np.arange(len(chars)) - starts[word]) & 63
        x = np.add.reduceat(chars * _PLACE[place], starts)
        x ^= x >> _U(31)
        x *= _MIX
        yield ((x >> shift) & mask).astype(np.int32), np.arange(len(words), dtype=np.int32)


def word_ngrams(words: list[str], n_min: int, n_max: int, buckets: int, whole: bool) -> tuple[np.ndarray, np.ndarray]:
    """All of `grams` at once."""
    made = list(grams(words, n_min, n_max, buckets, whole))
    if not made:
        return np.empty(0, np.int32), np.empty(0, np.int32)
    return np.concatenate([m[0] for m in made]), np.concatenate([m[1] for m in made])
