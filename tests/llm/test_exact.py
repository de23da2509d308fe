"""Exact duplicates: fingerprints, collisions, what stays; rows found again by place."""

import hashlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from vigilo.llm import exact_dedup as X
from vigilo.llm import located
from vigilo.llm.common import Scratch

COLUMNS = ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]


def _hash(data: bytes) -> list[int]:
    return [int(x[0]) for x in X.fingerprints(np.frombuffer(data, np.uint8), np.array([0, len(data)]))]


def _slow(data: bytes, base: int, prime: int) -> int:
    out = 0
    for b in data:
        out = (out * base + b + 1) % prime
    return out


@given(st.binary(max_size=300), st.binary(max_size=300))
def test_fingerprints_compose(x, y):
    for h, left, right, base, prime in zip(_hash(x + y), _hash(x), _hash(y), X.BASES, X.PRIMES):
        assert h == _slow(x + y, base, prime) == X.combine(left, right, len(y), base, prime)


def test_cells_and_shifts(monkeypatch):
    data = np.random.default_rng(1).integers(0, 256, 20_000).astype(np.uint8).tobytes()
    whole = _hash(data)
    assert whole == [_slow(data, b, p) for b, p in zip(X.BASES, X.PRIMES)]
    parts = [data[:7000], data[7000:7001], data[7001:]]
    offsets = np.cumsum([0, *map(len, parts)])
    pieces = X.fingerprints(np.frombuffer(data, np.uint8), offsets, after=len(data) - offsets[1:])
    assert [int(x.sum()) % p for x, p in zip(pieces, X.PRIMES)] == whole


def brute(rows) -> list[tuple]:
    groups = defaultdict(list)
    for r in rows:
        groups[r.text or ""].append(r.doc_id)
    out = []
    for text, ids in groups.items():
        sha = hashlib.sha256(text.encode()).hexdigest()
        some = [i for i in ids if i is not None]
        keep = max(some) if some else None
        out += [(i, keep, len(ids), False, sha) for i in ids]
        one = out.index((keep, keep, len(ids), False, sha))
        out[one] = (keep, keep, len(ids), True, sha)
    return sorted(out, key=repr)


def got(df) -> list[tuple]:
    assert df.columns == COLUMNS
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("options", [{}, {"huge": 100}, {"primes": (2, 3)}, {"primes": (2, 3), "huge": 900}])
def test_groups_equal_brute_force(corpus, rows, options):
    assert got(X.exact_groups(corpus, **options)) == brute(rows)


def test_hot_group_and_nulls(spark):
    rows = [(i if i % 5 else None, "same") for i in range(4000)] + [(i, f"own {i}") for i in range(3000)] \
        + [(None, "lonely"), (None, "both"), (None, "both"), (7, None), (8, ""), (8, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert got(X.exact_groups(docs)) == brute(docs.collect())


def test_empty_table(empty):
    result = X.exact_groups(empty)
    assert result.columns == COLUMNS and result.count() == 0
    assert X.drop_copies(empty).count() == 0


def test_drop_copies_keeps_columns_and_texts(spark, corpus, rows, workdir):
    corpus.write.parquet(f"{workdir}/docs")
    docs = spark.read.parquet(f"{workdir}/docs")
    for table in (docs, corpus):        # read where it stands, or written first
        kept = X.drop_copies(table)
        assert kept.columns == corpus.columns
        assert sorted((r.doc_id or -1, r.text or "") for r in kept.collect()) == sorted(
            (b[0] or -1, "") if not b[4] else (b[0] or -1, t) for b in brute(rows) if b[3]
            for t in {r.text or "" for r in rows} if hashlib.sha256(t.encode()).hexdigest() == b[4])
    plan = X.drop_copies(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan


def test_marks_are_found_again(spark, workdir, monkeypatch):
    spark.range(5000).repartition(3).write.parquet(f"{workdir}/t")
    table = spark.read.parquet(f"{workdir}/t").withColumn("_file", F.lit("taken")).withColumn("_ROW", F.lit(1))
    scratch = Scratch(spark, "marks")
    file, row = located.names(table)
    assert (file, row) == ("_file_", "_row_")
    monkeypatch.setattr(located, "BLOCK", 700)
    marks = located.place(table).where("id % 7 = 0").select(F.col(file).alias("file"), F.col(row).alias("row"))
    left = located.without(located.scanned(table, scratch), marks, scratch)
    assert left.columns == table.columns
    assert sorted(r.id for r in left.collect()) == [i for i in range(5000) if i % 7]
