"""Pure-Python models used as oracles by the property tests."""

from __future__ import annotations

import random


def random_changes(seed: int, n: int, ids: int, sides=("t1", "t2", "t3"), groups=("a", "b", "c", None),
                   p_delete: float = 0.15):
    """Random tagged changes (side, id, op, gender, name, score, ts, pos): ties, nulls, deletes."""
    rnd = random.Random(seed)
    out = []
    for pos in range(n):
        side = rnd.choice(sides)
        i = rnd.randrange(ids)
        op = "d" if rnd.random() < p_delete else rnd.choice(["c", "u", "r"])
        gender = name = score = None
        if side == "t1":
            gender = rnd.choice(groups)
        elif side == "t2":
            name = f"n{rnd.randrange(5)}"
        else:
            score = None if rnd.random() < 0.1 else float(rnd.randrange(6))   # many ties
        ts = pos // 3   # several changes share a timestamp; pos breaks the tie
        out.append((side, i, op, gender, name, score, ts, pos))
    return out


def lww(changes):
    """side -> id -> last change (by (ts, pos))."""
    state = {}
    for ch in sorted(changes, key=lambda c: (c[6], c[7])):
        state.setdefault(ch[0], {})[ch[1]] = ch
    return state


def joined(changes, sides=("t1", "t2", "t3")):
    st = lww(changes)
    rows = []
    ids = set.intersection(*[set(st.get(s, {})) for s in sides]) if st else set()
    for i in ids:
        parts = [st[s][i] for s in sides]
        if any(p[2] == "d" for p in parts):
            continue
        rows.append((i, parts[1][4], parts[0][3], parts[2][5]))   # id, name, gender, score
    return rows


def top_n(rows, n=2):
    def key(r):
        return (r[3] is None, -(r[3] or 0.0), r[0])
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append(r)
    out = []
    for g, rs in groups.items():
        for rn, r in enumerate(sorted(rs, key=key)[:n], start=1):
            out.append((*r, rn))
    return sorted(out, key=lambda r: r[0])
