"""Centroid clustering with an incremental distance matrix (operator 13).

Components are integers, so everything is exact. Each vector keeps its squared length and its
dot product with every centroid; its squared distance to centroid ``c`` is
``|x|^2 - 2 x.c + |c|^2``. A round moves centroid ``c`` by an integer step ``d``: the stored
product grows by ``x.d``, which reads only the components of ``x`` at which ``d`` isn't zero,
and a centroid that stands still costs nothing. Then the nearest centroid is taken anew. The
products are written to the shared folder each round and the round before is removed.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigilo.llm import common
from vigilo.llm.common import Scratch
from vigilo.llm.embedding_dedup import usable

#: Largest magnitude of an integer component: 64 squared differences then fit a long.
MOST = 1 << 27

_STATE = "vec_id long, x array<int>, square long, dots array<long>, cluster int, distance long"


def _flat(column: pa.Array, rows: int) -> np.ndarray:
    return column.flatten().to_numpy().astype(np.int64).reshape(rows, -1)


def nearest(square: np.ndarray, dots: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest centroid (ties: smaller number) and squared distance from stored products."""
    every = square[:, None] - 2 * dots + lengths
    best = every.argmin(axis=1)
    return best, every[np.arange(len(best)), best]


def _assigned(batch: pa.RecordBatch, square, dots, lengths) -> pa.RecordBatch:
    best, distance = nearest(square, dots, lengths)
    at = np.arange(0, dots.size + 1, dots.shape[1], dtype=np.int32)
    return pa.RecordBatch.from_arrays(
        [batch.column("vec_id"), batch.column("x"), pa.array(square), pa.ListArray.from_arrays(pa.array(at), pa.array(dots.ravel())),
         pa.array(best.astype(np.int32)), pa.array(distance)], names=["vec_id", "x", "square", "dots", "cluster", "distance"])


def _first(centroids: np.ndarray):
    lengths = (centroids * centroids).sum(axis=1)

    def run(batches):
        for batch in batches:
            if len(batch):
                x = _flat(batch.column("x"), len(batch))
                yield _assigned(batch, (x * x).sum(axis=1), x @ centroids.T, lengths)
    return run


def moved(x: np.ndarray, dots: np.ndarray, steps: np.ndarray) -> np.ndarray:
    """Stored products after the centroids moved by ``steps``."""
    out = dots.copy()
    for k, step in enumerate(steps):
        some = np.flatnonzero(step)
        if len(some):
            out[:, k] += x[:, some] @ step[some]
    return out


def _again(centroids: np.ndarray, steps: np.ndarray):
    lengths = (centroids * centroids).sum(axis=1)

    def run(batches):
        for batch in batches:
            if len(batch):
                x, dots = _flat(batch.column("x"), len(batch)), _flat(batch.column("dots"), len(batch))
                yield _assigned(batch, batch.column("square").to_numpy(), moved(x, dots, steps), lengths)
    return run


def cluster(vectors: DataFrame, k: int = 8, rounds: int = 10, dims: int = 64, scale: int = 1024, seed: int = 3,
            id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Per vector with exactly ``dims`` finite components: ``vec_id, cluster, distance,
    cluster_inertia, inertia, centroid_sha256``.

    Components become ``floor(scale * x)``. Centroids start as the ``k`` vectors with the
    smallest SHA-256 of ``seed:vec_id`` (null ids last; ties by components), fewer if there are
    fewer vectors. A round assigns every vector and replaces each centroid that has vectors by
    their componentwise floored mean; after the rounds vectors are assigned once more. Ties go
    to the smaller centroid. Rounds end early once no centroid moves, as the others would change
    nothing. Vectors that are null, of another length or hold null or non-finite components
    aren't returned; rows with equal ids are rows of their own; other columns are ignored; an
    empty table gives an empty result. A component of magnitude ``MOST`` or above is an error.
    """
    spark = vectors.sparkSession
    common.ship(spark)
    scratch = Scratch(spark, "centroids")
    whole = lambda x: F.floor(F.lit(float(scale)) * x.cast("double"))
    fit = usable(F.col("embedding")) & (F.size("embedding") == dims)
    far = F.exists("embedding", lambda x: F.abs(F.lit(float(scale)) * x.cast("double")) >= MOST)
    kept = (vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("embedding")).where(fit)
            .select("vec_id", F.when(far, F.raise_error(F.lit(f"a component reaches {MOST}")).cast("array<int>"))
                    .otherwise(F.transform("embedding", lambda x: whole(x).cast("int"))).alias("x")))
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    drawn = kept.orderBy(order.asc_nulls_last(), "x").limit(k).select("x").collect()     # k rows
    if not drawn:
        return scratch.finish(kept.select("vec_id", F.lit(0).alias("cluster"), *[F.lit(0).cast("long").alias(c) for c in
                              ("distance", "cluster_inertia", "inertia")], F.lit("").alias("centroid_sha256")))
    centroids = np.array([r[0] for r in drawn], np.int64)
    state, path = _kept(kept.mapInArrow(common.lean(_first(centroids)), _STATE), scratch)
    for _ in range(rounds):
        steps = means(state, centroids) - centroids
        if not steps.any():
            break
        centroids = centroids + steps
        before = path
        state, path = _kept(state.mapInArrow(common.lean(_again(centroids, steps)), _STATE), scratch)
        scratch.remove(before)
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    # one row per centroid
    own = {r["cluster"]: int(r["own"]) for r in state.groupBy("cluster")
           .agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("own")).collect()}
    of = lambda values: F.element_at(F.array(*[F.lit(v) for v in values]), F.col("cluster") + 1)
    return scratch.finish(state.select(
        "vec_id", "cluster", "distance",
        of([own.get(c, 0) for c in range(len(names))]).cast("long").alias("cluster_inertia"),
        F.lit(sum(own.values())).cast("long").alias("inertia"), of(names).alias("centroid_sha256")))


def _kept(df: DataFrame, scratch: Scratch) -> tuple[DataFrame, str]:
    path = scratch.path("state")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def means(state: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Floored means of the vectors of each cluster; a cluster without vectors stays."""
    dims = centroids.shape[1]
    sums = state.groupBy("cluster").agg(F.count("*").alias("n"), *[F.sum(F.col("x")[i].cast("long")).alias(f"s{i}") for i in range(dims)])
    out = centroids.copy()
    for r in sums.collect():     # one row per centroid
        out[r["cluster"]] = [r[f"s{i}"] // r["n"] for i in range(dims)]
    return out
