"""Operators over embeddings against brute force."""

import numpy as np
import pytest

from vigilo.llm import components, embedding_dedup, topk_search
from vigilo.llm.common import Scratch


@pytest.fixture(scope="module")
def vectors(spark):
    r = np.random.default_rng(7)
    rows = [(i, r.normal(size=16).tolist(), i % 4) for i in range(300)]
    centre = r.normal(size=16)
    rows += [(400 + i, (centre + 0.05 * r.normal(size=16)).tolist(), 0) for i in range(60)]      # near copies
    rows += [(500 + i, rows[3][1], 1) for i in range(20)]                                          # equal vectors
    rows += [(600, (3 * np.array(rows[3][1])).tolist(), 1), (601, [0.0] * 16, 1), (602, None, 1), (603, [], 1),
             (604, [float("nan")] * 16, 1), (605, [None] * 16, 1), (606, [float("inf")] * 16, 1), (607, [0.5] * 4, 1),
             (None, rows[9][1], 2), rows[9]]
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, node int").repartition(3)


def _usable(rows):
    out = []
    for r in rows:
        v = r.embedding
        if v and all(x is not None and np.isfinite(x) for x in v):
            out.append((r.vec_id, np.array(v + [0.0] * (16 - len(v)), float)))
    return out


def test_embedding_near_duplicates(vectors):
    rows = vectors.collect()
    fit = [(i, v) for i, v in _usable(rows) if np.abs(v).max() > 0]
    x = np.array([v for _, v in fit])
    cos = (x @ x.T) / np.outer(np.linalg.norm(x, axis=1), np.linalg.norm(x, axis=1))
    linked = cos >= 0.95
    np.fill_diagonal(linked, False)
    got = embedding_dedup.near_duplicates(vectors).collect()
    assert len(got) == len(rows)
    found = {r.vec_id: r for r in got}
    assert sum(r.n_links for r in got) >= 0.97 * linked.sum()
    for k, (i, _) in enumerate(fit):
        assert found[i].n_links <= linked[k].sum() + (i == 9)
        group = [j for j, _ in (fit[m] for m in np.flatnonzero(linked[k])) if j is not None]
        if group and i is not None:
            assert found[i].component_id <= min(i, *group)
        assert found[i].kept == (found[i].component_id == i)
    for i in (601, 602, 603, 604, 605, 606):
        assert (found[i].n_links, found[i].component_id, found[i].kept) == (0, i, True)
    assert found[519].n_links == 21 and found[519].component_id == 3 and found[600].n_links == 21
    assert embedding_dedup.near_duplicates(vectors.limit(0)).count() == 0


def test_blocks_of_a_large_bucket_give_the_same(vectors, monkeypatch):
    want = {r.vec_id: r for r in embedding_dedup.near_duplicates(vectors).collect()}
    monkeypatch.setattr(embedding_dedup, "BLOCK", 8)
    got = {r.vec_id: r for r in embedding_dedup.near_duplicates(vectors).collect()}
    assert got == want


def test_shape_reaches_its_recall():
    for rows in (100, 10_000, 1_000_000):
        k, tables = embedding_dedup.shape(rows, 0.95)
        near = embedding_dedup.share_chance(np.sqrt(2 - 2 * 0.95))
        assert (1 - near ** k) ** tables <= embedding_dedup.MISS * 1.01


@pytest.mark.parametrize("k, bucket", [(3, 4096), (10, 32)])
def test_top_k(vectors, monkeypatch, k, bucket):
    monkeypatch.setattr(topk_search, "BUCKET", bucket)
    fit = [(i, np.floor(1024 * v).astype(np.int64) * (np.arange(16) < 16)) for i, v in _usable(vectors.collect())]
    x = np.array([v for _, v in fit])
    short = [n for n, (i, _) in enumerate(fit) if i == 607]
    assert len(short) == 1 and (x[short[0]][4:] == 0).all()
    want = []
    for n, (i, v) in enumerate(fit):
        if i is not None and i % 100 == 0:
            order = sorted((m for m in range(len(fit)) if m != n),
                           key=lambda m: (-(x[m] @ v), fit[m][0] is not None, fit[m][0] or 0))[:k]
            want += [(i, rank + 1, fit[m][0], int(x[m] @ v)) for rank, m in enumerate(order)]
    got = [tuple(r) for r in topk_search.top_k(vectors, k=k).collect()]
    assert sorted(got, key=str) == sorted(want, key=str) and len(got) > 5 * k
    assert topk_search.top_k(vectors.limit(0)).count() == 0


def test_components(spark):
    r = np.random.default_rng(3)
    edges = [(int(a), int(b)) for a, b in r.integers(0, 400, (260, 2))] + [(1000 + i, 1001 + i) for i in range(60)]
    edges += [(2000, 2000 + i) for i in range(1, 200)]
    root = {}
    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x
    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    want = {x: find(x) for x in list(root) if find(x) != x}
    df = spark.createDataFrame(edges, "a long, b long")
    got = {x.node: x.root for x in components.components(df, Scratch(spark, "test")).collect()}
    assert got == want
    assert components.components(df.limit(0), Scratch(spark, "test")).count() == 0
