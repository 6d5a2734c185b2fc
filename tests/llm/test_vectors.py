"""Exact top-k search and embedding near-dedup against all pairs."""

import math

import numpy as np
import pytest

from pairsignal.llm import embedding_dedup, top_k

SCHEMA = "vec_id long, embedding array<double>, label int, n long, rank string"


def frame(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 1, 2, "x") for i, v in rows], SCHEMA)


def good(v):
    return v is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v)


def best(queries, rows, k):
    """(query id, vector) -> [(rank, id, score)] by looking at every row."""
    out = set()
    for q, x in queries:
        if q is None or not good(x):
            continue
        scores = sorted(
            (-sum(math.floor(256 * a) * math.floor(256 * b) for a, b in zip(x, y)), i)
            for i, y in rows if i is not None and i != q and good(y) and len(y) == len(x)
        )
        out |= {(q, r + 1, i, -s) for r, (s, i) in enumerate(scores[:k])}
    return out


@pytest.mark.parametrize("seed,scale", [(0, 1.0), (1, 1e4), (2, 1e6)])
def test_top_k_against_all_rows(spark, monkeypatch, seed, scale):
    monkeypatch.setattr(top_k, "QUERY_BLOCK", 7)
    monkeypatch.setattr(top_k, "VECTOR_BLOCK", 40)
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((4, 6))
    rows = [(i, (centres[i % 4] + 0.3 * rng.standard_normal(6)) * scale) for i in range(150)]
    rows += [(200 + i, rows[3][1]) for i in range(12)]  # ties
    rows += [(5, rows[9][1]), (300, [0.0] * 6), (301, [1.0, 2.0]), (302, [2.0, 1.0])]
    rows += [(400, None), (401, []), (402, [None] * 6), (403, [math.inf] + [1.0] * 5), (404, [math.nan] * 6), (None, rows[0][1])]
    queries = [r for r in rows if r[0] is None or r[0] % 5 == 0 or r[0] > 299]
    seen, got = set(), top_k.top_k(frame(spark, queries), frame(spark, rows)).collect()
    for r in got:
        seen.add((r.query_id, r["rank"], r.vec_id, r.score))
    assert seen == best(queries, rows, 5)


def test_top_k_of_odd_tables(spark):
    empty, one = frame(spark, []), frame(spark, [(1, [1.0, 2.0])])
    assert top_k.top_k(empty, one).collect() == [] and top_k.top_k(one, empty).collect() == []
    assert top_k.top_k(one, one).collect() == []


def near(rows, limit=0.95):
    n = len(rows)
    links, root = [0] * n, list(range(n))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(n):
        for j in range(i):
            x, y = rows[i][1], rows[j][1]
            if good(x) and good(y) and len(x) == len(y) and any(x) and any(y):
                x, y = np.array(x), np.array(y)
                if x @ y / (np.sqrt(x @ x) * np.sqrt(y @ y)) >= limit:
                    links[i] += 1
                    links[j] += 1
                    root[find(i)] = find(j)
    least = {}
    for i in range(n):
        if rows[i][0] is not None:
            least[find(i)] = min(least.get(find(i), rows[i][0]), rows[i][0])
    return sorted((-1 if rows[i][0] is None else rows[i][0], links[i], least.get(find(i), -1)) for i in range(n))


@pytest.mark.parametrize("block", [8, 1024])
def test_links_against_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(embedding_dedup, "BLOCK", block)
    monkeypatch.setattr(embedding_dedup, "MISSED", 1e-5)
    rng = np.random.default_rng(3)
    rows = []
    for c in range(12):
        centre = rng.standard_normal(16)
        for _ in range(int(rng.integers(1, 9))):
            rows.append((len(rows), list((centre + 0.12 * rng.standard_normal(16)) * rng.uniform(0.1, 1e3))))
    base = rng.standard_normal(16)
    step = rng.standard_normal(16) * 0.2
    for i in range(12):  # a chain
        rows.append((len(rows), list(base + i * step)))
    for i in range(40):  # copies
        rows.append((len(rows), rows[2][1]))
    rows += [(7, rows[4][1]), (7, rows[4][1]), (None, rows[4][1]), (900, [0.0] * 16), (901, None), (902, []), (903, [None] * 16),
             (904, [math.nan] * 16), (905, [1.0]), (906, [2.0]), (907, [-1.0]), (908, [-0.0, 1.0]), (909, [0.0, 1.0]), (910, [1e200, 1e200]), (911, [2e200, 2e200])]
    got = embedding_dedup.near_vectors(frame(spark, rows)).collect()
    want = near([(i, [x / 1e200 for x in v] if i in (910, 911) else v) for i, v in rows])
    number = lambda x: -1 if x is None else x
    assert sorted((number(r.vec_id), r.n_links, number(r.component_id)) for r in got) == want
    assert all(r.kept == (r.vec_id == r.component_id) for r in got if r.vec_id is not None)


def test_recall_at_the_limit(spark):
    """Pairs with a cosine of just 0.95, the hardest ones, are found at the planned rate."""
    rng = np.random.default_rng(5)
    rows = []
    for i in range(400):
        x = rng.standard_normal(64)
        x /= np.sqrt(x @ x)
        y = rng.standard_normal(64)
        y -= (x @ y) * x
        y /= np.sqrt(y @ y)
        rows += [(2 * i, list(x)), (2 * i + 1, list(0.9502 * x + math.sqrt(1 - 0.9502**2) * y))]
    found = embedding_dedup.near_vectors(frame(spark, rows)).filter("n_links = 1").count() / 800
    assert found >= 0.95
    assert embedding_dedup.near_vectors(frame(spark, [])).collect() == []
