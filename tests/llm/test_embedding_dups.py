"""Near-duplicate embeddings against all pairs."""

from collections import Counter

import numpy as np
import pytest

from tidemark.llm import embedding_dups as ed

VEC = "vec_id bigint, embedding array<float>, label int, key int, weight string"


def brute(rows, threshold=ed.THRESHOLD):
    """(vec_id, n_links, component_id, kept) of (vec_id, embedding, label) rows, by all pairs."""
    ok = [v is not None and lab is not None and len(v) > 0 and all(c is not None and np.isfinite(c) for c in v) and any(v) for _, v, lab in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    links = Counter()
    unit = [ed.unit(np.array([v], np.float32))[0] if k else None for (_, v, _), k in zip(rows, ok)]
    for i in range(len(rows)):
        for j in range(i):
            if ok[i] and ok[j] and rows[i][2] == rows[j][2] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= threshold:
                links[i] += 1
                links[j] += 1
                root[find(i)] = find(j)
    least = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[find(i)] = min(least.get(find(i), r[0]), r[0])
    return sorted(((r[0], links[i], least.get(find(i)), r[0] == least.get(find(i))) for i, r in enumerate(rows)), key=str)


def test_recall_at_the_threshold():
    rng = np.random.default_rng(5)
    a, b = rng.normal(size=(4000, 64)), rng.normal(size=(4000, 64))
    a = ed.unit(a)
    b = ed.unit(b - (a * b).sum(1, keepdims=True) * a)
    near = ed.unit(0.98 * a + np.sqrt(1 - 0.98 ** 2) * b)
    meet = (ed.bucket_keys(a)[:, :, None] == ed.bucket_keys(near)[:, None, :]).any((1, 2))
    assert meet.mean() >= 0.99
    assert (ed.bucket_keys(a)[:, :, None] == ed.bucket_keys(ed.unit(b))[:, None, :]).any((1, 2)).mean() < 0.05


def test_hadamard_is_orthogonal():
    h = ed.hadamard(np.eye(16))
    assert np.array_equal(h @ h.T, 16 * np.eye(16))


def rows_with_groups(n=300, dim=24, seed=3):
    rng = np.random.default_rng(seed)
    out = []
    for i in range(n):
        if i % 3 == 0 and out:  # a third of the rows around one vector
            v = np.array(out[0][1]) + rng.normal(size=dim) * 0.03 * (i % 2)
        elif i % 5 == 0 and out:
            v = np.array(out[rng.integers(len(out))][1]) + rng.normal(size=dim) * rng.choice([0, 0.01, 0.1, 0.2])
        else:
            v = rng.normal(size=dim)
        out.append((int(i * 7 % 301), [float(x) for x in v.astype(np.float32)], int(rng.integers(3)) if i % 3 else 0))
    return out


@pytest.mark.parametrize("block", [16, 1024])
def test_matches_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(ed, "BLOCK", block)
    rows = rows_with_groups()
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], VEC).repartition(4)
    got = sorted((tuple(r) for r in ed.near_duplicates(df).collect()), key=str)
    assert got == brute(rows)


def test_odd_rows(spark):
    one, nan, inf = [1.0, 2.0, 3.0], float("nan"), float("inf")
    rows = [(1, None, 0), (2, [], 0), (3, [0.0, 0.0, 0.0], 0), (4, [1.0, nan, 1.0], 0), (5, [inf, 1.0, 1.0], 0), (6, [1.0, None, 1.0], 0),
            (7, one, None), (8, one, 1), (8, one, 1), (9, [2.0, 4.0, 6.0], 1), (None, one, 1), (None, [5.0, 0.0, -1.0], 2), (10, one, 3),
            (11, [1e30, 2e30, 3e30], 1), (12, [1.0, 2.0], 1), (13, [-1.0, -2.0, -3.0], 1), (14, [7.0], 1), (15, [3.0], 1)]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], VEC)
    got = sorted((tuple(r) for r in ed.near_duplicates(df).collect()), key=str)
    want = [(i, n, c, k or (i is None and c is None)) for i, n, c, k in brute(rows)]
    assert got == sorted(want, key=str)
    assert ed.near_duplicates(df.limit(0)).count() == 0


def test_query_finds_the_links(spark):
    sf = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    got = {r["vec_id"]: r for r in ed.op12_embedding_dups(spark, sf).collect()}
    want = {r[0]: r for r in brute(rows)}
    assert got.keys() == want.keys() and all(got[i]["n_links"] <= want[i][1] for i in want)
    assert sum(r["n_links"] for r in got.values()) >= 0.99 * sum(r[1] for r in want.values())
    assert np.mean([got[i]["component_id"] == want[i][2] for i in want]) >= 0.99
