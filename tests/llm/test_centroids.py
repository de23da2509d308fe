"""Centroid clustering against plain integer arithmetic."""

import hashlib
import math

import numpy as np
import pytest

from vigilo.llm import centroids

COLUMNS = ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


def brute(rows, k, rounds, dims, seed=3, scale=1024):
    kept = [(i, [math.floor(scale * float(x)) for x in e]) for i, e in rows
            if e is not None and len(e) == dims and all(x is not None and math.isfinite(x) for x in e)]
    order = sorted(kept, key=lambda r: ("z" if r[0] is None else hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest(), r[1]))
    centre = [x for _, x in order[:k]]

    def near(x):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), j) for j, c in enumerate(centre))

    for _ in range(rounds):
        member = [near(x)[1] for _, x in kept]
        for j in range(len(centre)):
            mine = [x for (_, x), m in zip(kept, member) if m == j]
            if mine:
                centre[j] = [sum(col) // len(mine) for col in zip(*mine)]
    last = [near(x) for _, x in kept]
    own = {j: sum(d for d, m in last if m == j) for j in range(len(centre))}
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centre]
    return sorted(((i, j, d, own[j], sum(own.values()), sha[j]) for (i, _), (d, j) in zip(kept, last)), key=repr)


def table(spark, rows):
    full = [(i, e, 1, "x", 0, 2.5) for i, e in rows]
    return spark.createDataFrame(full, "vec_id long, embedding array<double>, label int, cluster string, dots int, "
                                       "distance double").repartition(3)


def got(df):
    assert df.columns == COLUMNS
    return sorted((tuple(r) for r in df.collect()), key=repr)


def vectors(n, dims, seed=5):
    r = np.random.default_rng(seed)
    return [(i, (r.normal(size=dims) + 3 * r.integers(0, 3)).tolist()) for i in range(n)]


def test_equals_brute_force(spark):
    nan, inf = float("nan"), float("inf")
    rows = vectors(150, 6) + [(1, [0.5] * 6)] * 3 + [(None, [0.1] * 6), (500, None), (501, []), (502, [1.0] * 5), (503, [1.0] * 7),
                                                     (504, [nan] * 6), (505, [inf] * 6), (506, [None] * 6), (507, [0.0] * 6), (508, [-0.0] * 6)]
    rows += [(600 + i, rows[0][1]) for i in range(60)]       # a hot vector, and ties
    for k, rounds in ((5, 10), (3, 2), (8, 0)):
        assert got(centroids.cluster(table(spark, rows), k, rounds, 6)) == brute(rows, k, rounds, 6)


def test_few_equal_and_no_vectors(spark):
    rows = [(1, [0.5, 0.25]), (2, [0.5, 0.25]), (3, [-1.0, 4.0])]
    assert got(centroids.cluster(table(spark, rows), 8, 4, 2)) == brute(rows, 8, 4, 2)
    for none in (rows[:0], [(1, None), (2, [1.0])]):
        assert got(centroids.cluster(table(spark, none), 8, 4, 2)) == []


def test_stored_products_equal_new_ones():
    r = np.random.default_rng(2)
    x, c = r.integers(-2000, 2000, (50, 16)), r.integers(-2000, 2000, (4, 16))
    steps = r.integers(-3, 4, (4, 16)) * (r.random((4, 16)) < 0.3)
    steps[2] = 0
    assert (centroids.moved(x, x @ c.T, steps) == x @ (c + steps).T).all()


def test_components_out_of_range_are_an_error(spark):
    with pytest.raises(Exception, match="a component reaches"):
        centroids.cluster(table(spark, [(1, [1e9, 0.0])]), 2, 1, 2).collect()


def test_registered_query_equals_its_sql(spark):
    import duckdb
    from vigilo.llm import queries
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    for key in ("op11_polynomial_exact_dedup", "op13_incremental_centroids"):
        df = queries.QUERIES[key](spark, sf)
        want = con.sql(queries.ORACLE[key])
        assert df.columns == want.columns
        assert sorted(map(tuple, df.collect())) == sorted(want.fetchall())
