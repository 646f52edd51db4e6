"""Plain Python versions that tests compare with."""

from collections import defaultdict
from functools import lru_cache

from tidemark.llm.decontaminate import BUDGET, MIN_CHARS, normalise, whole_words


def brute_classes(rows, threshold=0.8):
    """doc_id -> least id of its class of texts that are alike in word 5-grams."""
    sets = {}
    for d, t in rows:
        w = (t or "").split()
        sets[d] = frozenset(tuple(w[i:i + 5]) for i in range(max(len(w) - 4, 1))) if w else None
    root = {d: d for d, _ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    holders = defaultdict(list)
    for d, s in sets.items():
        for g in s or ():
            holders[g].append(d)
    for pair in {(a, b) for h in holders.values() for a in h for b in h if a < b}:
        a, b = (sets[x] for x in pair)
        if len(a & b) >= threshold * len(a | b) - 1e-9:
            x, y = sorted(map(find, pair))
            root[y] = x
    return {d: find(d) for d in root}


def brute_kept(rows, n=100):
    """doc_id -> the bytes left of its text without those of n-byte strings that start earlier."""
    first = {}
    for d, t in sorted(rows):
        b = (t or "").encode()
        for p in range(len(b) - n + 1):
            first.setdefault(b[p:p + n], (d, p))
    out = {}
    for d, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for p in range(len(b) - n + 1):
            if first[b[p:p + n]] < (d, p):
                gone[p:p + n] = b"\1" * n
        out[d] = bytes(x for x, g in zip(b, gone) if not g)
    return out


@lru_cache(maxsize=4)
def _grams(text):
    return {text[i:i + 4] for i in range(len(text) - 3)}


def holds_item(text, item):
    """Whether the text holds the item within the budget, by a table of edit distances."""
    text, item = normalise(text), normalise(item)
    if not text or not item:
        return False
    if len(item) < MIN_CHARS:
        return any(whole_words(text, i, i + len(item)) for i in range(len(text)) if text.startswith(item, i))
    k = int(len(item) * BUDGET)
    row = list(range(len(item) + 1))
    # An edit spoils four 4-grams of the item at most.
    held = _grams(text)
    if sum(item[i:i + 4] in held for i in range(len(item) - 3)) < len(item) - 3 - 4 * k:
        return False
    best = row[-1]
    for c in text:
        last, row[0] = row[0], 0
        for i, x in enumerate(item, 1):
            last, row[i] = row[i], min(row[i] + 1, row[i - 1] + 1, last + (c != x))
        best = min(best, row[-1])
        if best <= k:
            return True
    return best <= k
