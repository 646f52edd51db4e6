"""Bucket names of byte strings, built by bucket-pointer refinement.

The q-gram buckets of a text are named first; longer strings are then named by
the pair (bucket at i, bucket at a later offset), and those names are the
pointers of the next refinement: 1 -> 2 -> 4 -> 8 -> 16 -> 32 -> 64 -> 100
bytes. A name is a 64-bit hash, so that tasks agree on it without a global
numbering; strings are only called equal on two independent names (128 bits).
"""

from __future__ import annotations

import numpy as np

STRING_BYTES = 100  # the contract's repeated string
GRAM = 32  # bytes of an initial bucket
PIECE = 1 << 20  # bytes of text named at a time

_U = np.uint64
_BYTE = np.random.default_rng(20240607).integers(1, 1 << 63, 256, dtype=np.uint64)
_C = [_U(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD)]


def refine(near: np.ndarray, later: np.ndarray, salt: int = 0) -> np.ndarray:
    """Names of longer strings from the buckets at an offset and at a later one."""
    x = near * _C[salt & 1]
    x ^= x >> _U(31)
    x += later * _C[2 + (salt & 1)]
    x ^= x >> _U(29)
    x *= _C[1 - (salt & 1)]
    x ^= x >> _U(32)
    return x


def grams(data: np.ndarray) -> np.ndarray:
    """The q-gram bucket at each offset of `data`, which is at least as long as one."""
    at, width = _BYTE[data], 1
    while width < GRAM:
        at = refine(at[:-width], at[width:])
        width *= 2
    return at


def names(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(q-gram bucket, first and second name of the 100-byte string) at each offset.

    The arrays hold an entry for each offset at which the string fits.
    """
    n = len(data)
    if n < STRING_BYTES:
        none = np.empty(0, np.uint64)
        return none, none, none
    gram = grams(data)
    twice = refine(gram[:-GRAM], gram[GRAM:])
    rest = STRING_BYTES - 2 * GRAM
    return gram, refine(twice[:-rest], twice[rest:]), refine(twice[:-rest], twice[rest:], 1)


def owners(gram: np.ndarray, n_windows: int) -> np.ndarray:
    """For each 100-byte string, the offset of the smallest q-gram bucket inside it.

    The leftmost one counts in a tie, so that equal strings have their owner at
    the same place whatever stands around them.
    """
    bits = _U(max(1, int(len(gram)).bit_length()))
    key = ((gram >> bits) << bits) | np.arange(len(gram), dtype=np.uint64)
    span, width = STRING_BYTES - GRAM + 1, 1
    while 2 * width <= span:
        key = np.minimum(key[:-width], key[width:])
        width *= 2
    if width < span:
        key = np.minimum(key[:width - span], key[span - width:])
    return (key[:n_windows] & _U((1 << int(bits)) - 1)).astype(np.int64)


def _runs(gram: np.ndarray, ends: np.ndarray, n_windows: int):
    """(owner of each string, text of each string, first string of each run, strings, whether they lie in one text)."""
    own = owners(gram, n_windows)
    starts = np.concatenate(([0], ends[:-1]))
    text = np.repeat(np.arange(len(ends)), ends - starts)[:n_windows]
    fits = np.arange(n_windows) + STRING_BYTES <= ends[text]
    new = np.empty(n_windows, bool)
    new[0] = True
    new[1:] = (own[1:] != own[:-1]) | (text[1:] != text[:-1]) | (fits[1:] != fits[:-1])
    first = np.flatnonzero(new)
    return own, text, first, np.diff(np.append(first, n_windows)), fits[first]


def run_buckets(data: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The buckets of the owners of all `runs`, without the names of the strings."""
    if len(data) < STRING_BYTES:
        return np.empty(0, np.int64)
    gram = grams(data)
    own, _, first, _, keep = _runs(gram, ends, len(data) - STRING_BYTES + 1)
    return gram[own[first[keep]]].view(np.int64)


def runs(data: np.ndarray, ends: np.ndarray):
    """Runs of neighbouring strings that share their owner.

    `data` holds texts one after another, `ends` where each ends. Returns arrays
    (text, first string's offset in data, strings, owner's distance, bucket of
    the owner, two names of the run as a whole), and the two names of every string.
    """
    gram, one, two = names(data)
    if not len(one):
        none = np.empty(0, np.int64)
        return (none,) * 7, one, two
    own, text, first, count, keep = _runs(gram, ends, len(one))
    a, b = np.add.reduceat(one * _C[0], first), np.add.reduceat(two ^ (two >> _U(7)), first)
    first, count, a, b = first[keep], count[keep], a[keep], b[keep]
    return (text[first], first, count, own[first] - first, gram[own[first]].view(np.int64),
            a.view(np.int64), b.view(np.int64)), one, two
