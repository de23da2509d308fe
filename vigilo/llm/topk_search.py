"""Exact top-k inner products by norm-bucketed retrieval (operator 10).

Candidate vectors are ordered by length and dealt into buckets of neighbours in that order.
A query's threshold is its k-th best product so far; divided by the lengths of the query and
of a bucket's longest vector it is a local cosine threshold. A bucket whose threshold is
above 1 is skipped. Else a high threshold prunes by coordinates (a vector at that cosine has
to lie in an interval around the query on the query's largest coordinates), a low one by
length (only a head of the bucket is long enough). What is left is verified by its product.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from vigilo.llm import common
from vigilo.llm.common import Scratch
from vigilo.llm.embedding_dedup import usable

#: Vectors of a bucket, and queries of a block.
BUCKET, QUERIES = 4096, 512
#: Local cosine threshold from which coordinates prune better than length, and coordinates looked at.
COORD_FROM, FOCUS = 0.3, 4
_SLACK = 1e-9


def _stack(vectors, d: int) -> np.ndarray:
    out = np.zeros((len(vectors), d), np.int64)
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


def _products(q: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Exact integer products of rows with rows; beyond 64 bits they stop at the limits."""
    top = float(np.abs(q).max(initial=0)) * float(np.abs(p).max(initial=0)) * max(q.shape[1], 1)
    if top < 2 ** 53:
        return (q.astype(np.float64) @ p.T.astype(np.float64)).astype(np.int64)
    if top < 2 ** 63:
        return q @ p.T
    exact = q.astype(object) @ p.T.astype(object)
    return np.clip(exact, -2 ** 63, 2 ** 63 - 1).astype(np.int64)


def _length(x: np.ndarray) -> np.ndarray:
    return np.sqrt((x.astype(np.float64) ** 2).sum(axis=1))


def _seed(columns: dict, k: int):
    """Per query the k-th best product among the longest vectors, a first threshold."""
    def run(frames):
        for frame in frames:
            d = max(max((len(v) for v in frame.vector), default=0), columns["d"])
            q, p = _stack(frame.vector, d), _stack(columns["vectors"], d)
            low = np.full(len(q), np.iinfo(np.int64).min)
            for lo in range(0, len(q), QUERIES):
                scores = _products(q[lo: lo + QUERIES], p)
                own = frame.row.to_numpy()[lo: lo + QUERIES, None] == columns["rows"][None, :]
                scores[own] = np.iinfo(np.int64).min
                if scores.shape[1] > k:
                    low[lo: lo + QUERIES] = -np.partition(-scores.astype(np.float64), k - 1, axis=1)[:, k - 1]
            yield frame.assign(low=low, length=_length(q))
    return run


def _search(k: int):
    def run(key, queries: pd.DataFrame, bucket: pd.DataFrame) -> pd.DataFrame:
        bucket = bucket.sort_values("row")
        d = max(len(v) for v in [*queries.vector, *bucket.vector]) if len(queries) and len(bucket) else 0
        if not d:
            return pd.DataFrame({c: pd.Series(dtype="int64") for c in ("query_row", "query_id", "vec_id", "score")})
        q, p = _stack(queries.vector, d), _stack(bucket.vector, d)
        q_len, p_len = _length(q), _length(p)
        rows, ids = bucket.row.to_numpy(), bucket.vec_id
        unit = np.ascontiguousarray((p / np.maximum(p_len, 1e-300)[:, None]).T)
        out = []
        for i, (row, query_id, low) in enumerate(zip(queries.row, queries.query_id, queries.low)):
            reach = q_len[i] * p_len
            # lengths fall along the bucket: those long enough are a head of it
            head = len(p) if low <= 0 else int(np.searchsorted(-reach, -low * (1 - _SLACK), "right"))
            if not head:
                continue
            at = None
            cosine = low / reach[0] if low > 0 and reach[0] else 0
            if cosine >= COORD_FROM:
                turn = np.arccos(min(1.0, cosine))  # how far a vector may turn away from the query
                for f in np.argsort(-np.abs(q[i]))[:FOCUS]:
                    angle = np.arccos(q[i, f] / q_len[i])
                    least, most = np.cos(min(np.pi, angle + turn)), np.cos(max(0.0, angle - turn))
                    x = unit[f, :head] if at is None else unit[f, at]
                    fits = (x >= least - _SLACK) & (x <= most + _SLACK)
                    at = np.flatnonzero(fits) if at is None else at[fits]
            at = np.arange(head) if at is None else at
            scores = _products(q[i: i + 1], p[at])[0]
            good = np.flatnonzero((scores >= low) & (rows[at] != row))
            if len(good) > 4 * k:  # the k best and all that tie with the last of them
                last = np.partition(scores[good], len(good) - k)[len(good) - k]
                good = good[scores[good] >= last]
            found = pd.DataFrame({"vec_id": ids.iloc[at[good]].to_numpy(), "score": scores[good]})
            found = found.sort_values(["score", "vec_id"], ascending=[False, True], na_position="first").head(k)
            out.append(found.assign(query_row=row, query_id=query_id))
        if not out:
            return pd.DataFrame({c: pd.Series(dtype="int64") for c in ("query_row", "query_id", "vec_id", "score")})
        return pd.concat(out)[["query_row", "query_id", "vec_id", "score"]]
    return run


def top_k(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 10,
          every: int = 100, scale: float = 1024.0) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` best inner products of each query.

    Components are ``floor(scale * x)``. Queries are the rows whose id is divisible by
    ``every``; candidates are all rows but the query's own. Ties go to the smaller id (a null
    id counts as smallest). Null, empty and non-finite vectors take no part; zero vectors do.
    Shorter vectors count as filled with zeros, repeated rows are candidates and queries of
    their own, other columns are ignored, an empty table gives an empty result. Components
    and products beyond 64 bits stop at the limits.
    """
    spark = vectors.sparkSession
    common.ship(spark)
    scratch = Scratch(spark, "topk")
    whole = F.transform("embedding", lambda x: F.floor(F.lit(scale) * x.cast("double")))
    ints = (vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("embedding"))
            .where(usable(F.col("embedding"))).select("vec_id", whole.alias("vector"))
            .withColumn("shorter", -F.aggregate("vector", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))))
    numbered, n = common.with_row_number(ints, ["shorter", "vec_id", "vector"], "row", scratch)
    rows = scratch.written(numbered.select("vec_id", "vector", "row", "shorter",
                                           F.floor(F.col("row") / F.lit(BUCKET)).alias("bucket")), "rows")
    # the longest vectors, at most BUCKET of them
    longest = rows.where("bucket = 0").select("row", "vector").toPandas()
    seed = {"rows": longest.row.to_numpy(), "vectors": list(longest.vector),
            "d": max((len(v) for v in longest.vector), default=0)}
    queries = (rows.where(F.col("vec_id") % every == 0).select("row", F.col("vec_id").alias("query_id"), "vector")
               .mapInPandas(_seed(seed, k), "row long, query_id long, vector array<long>, low long, length double"))
    asked = rows.where(F.col("vec_id") % every == 0).count()
    blocks, buckets = max(1, -(-asked // QUERIES)), max(1, -(-n // BUCKET))
    queries = scratch.written(queries.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int")), "queries")
    lengths = scratch.written(rows.groupBy("bucket").agg(F.sqrt(-F.min("shorter")).alias("longest")), "lengths")
    # buckets that a query can't skip: product at most length times length
    visits = (queries.withColumn("bucket", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(buckets - 1).cast("long"))))
              .join(lengths, "bucket")
              .where((F.col("low") <= 0) | (F.col("length") * F.col("longest") >= F.col("low") * (1 - _SLACK)))
              .select("block", "bucket", "row", "query_id", "vector", "low"))
    needed = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    copies = rows.select("bucket", "row", "vec_id", "vector", needed.alias("block"))
    found = (visits.groupBy("block", "bucket").cogroup(copies.groupBy("block", "bucket"))
             .applyInPandas(_search(k), "query_row long, query_id long, vec_id long, score long"))
    best = Window.partitionBy("query_row").orderBy(F.col("score").desc(), F.col("vec_id"))
    out = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return scratch.finish(out.select("query_id", "rank", "vec_id", "score"))
