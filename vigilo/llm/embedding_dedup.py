"""Embedding near-duplicates by Euclidean p-stable hashing (operator 6).

Vectors are scaled to unit length; then a cosine of ``c`` is a distance of ``sqrt(2 - 2c)``.
A table's key is a set of Gaussian projections, shifted and cut into steps of ``WIDTH``; near
vectors share the keys of some tables. Vectors that share a key are compared by their exact
cosine. Equal vectors are one class, large buckets are dealt out in blocks, and a task emits
link counts and a spanning forest, never the pairs.
"""

from __future__ import annotations

import math
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigilo.llm import common
from vigilo.llm.common import Scratch, mix64
from vigilo.llm.components import components

WIDTH = 1.2
#: Chance that a pair at the threshold itself shares no key (closer pairs: far less).
MISS = 0.002
#: Members of a bucket per block.
BLOCK = 512


def usable(vector: Column) -> Column:
    """Neither null nor empty, and only finite components."""
    odd = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & ~F.exists(vector, odd)


def share_chance(distance: float, width: float = WIDTH) -> float:
    """Chance that one projection puts two vectors at a distance into one step."""
    t = width / distance
    return 1 - 2 * NormalDist().cdf(-t) - 2 / (math.sqrt(2 * math.pi) * t) * (1 - math.exp(-t * t / 2))


def shape(rows: int, cosine: float) -> tuple[int, int]:
    """Projections of a key and number of tables: unrelated vectors share a key about once
    per table, pairs at the threshold miss all tables with a chance of ``MISS``."""
    far, near = share_chance(math.sqrt(2)), share_chance(math.sqrt(2 - 2 * cosine))
    k = max(4, math.ceil(math.log(max(rows, 2)) / -math.log(far)) + 1)
    return k, math.ceil(math.log(MISS) / math.log(1 - near ** k))


def _matrix(vectors: pa.Array) -> np.ndarray:
    """Rows of a list column as doubles; shorter ones are filled with zeros."""
    sizes = np.diff(vectors.offsets.to_numpy())
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if len(sizes) and (sizes == sizes[0]).all():
        return flat.reshape(len(sizes), -1)
    out = np.zeros((len(sizes), int(sizes.max()) if len(sizes) else 0))
    out[np.arange(out.shape[1]) < sizes[:, None]] = flat
    return out


def _keys(k: int, tables: int, seed: int):
    def run(batches):
        planes = shifts = None
        for batch in batches:
            x = _matrix(batch.column("embedding"))
            if planes is None or planes.shape[0] < x.shape[1]:
                random = np.random.Generator(np.random.PCG64(seed))
                shifts = random.uniform(0, WIDTH, k * tables)
                planes = random.standard_normal((x.shape[1], k * tables))
            scale = np.abs(x).max(axis=1, keepdims=True)
            x = x / scale
            x /= np.sqrt((x * x).sum(axis=1, keepdims=True))
            out = np.empty((len(x), tables), np.int32)
            for lo in range(0, len(x), 512):
                steps = np.floor((x[lo: lo + 512] @ planes[: x.shape[1]] + shifts) / WIDTH).astype(np.int64)
                steps = steps.astype(np.uint64).reshape(-1, tables, k)
                key = np.zeros(steps.shape[:2], np.uint64)
                for j in range(k):
                    key = mix64(key * np.uint64(0x9E3779B97F4A7C15) + steps[:, :, j])
                out[lo: lo + 512] = (key >> np.uint64(32)).astype(np.uint32).view(np.int32)
            at = pa.array(np.arange(0, out.size + 1, tables, dtype=np.int32))
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.ListArray.from_arrays(at, pa.array(out.ravel()))],
                                             names=["node", "keys"])
    return run


def _links(cosine: float):
    """Exact cosines inside the units of a sorted partition.

    Two members are looked at in the first table whose key they share, so a link counts once.
    """
    def pairs(unit, table, block, mixed, x, norm, keys):
        n = len(unit)
        for step in range(1, n):
            i = np.flatnonzero(unit[step:] == unit[:-step])
            if not len(i):
                return
            i = i[~mixed[i] | (block[i] != block[i + step])]
            for lo in range(0, len(i), 4096):
                a = i[lo: lo + 4096]
                b = a + step
                near = np.einsum("ij,ij->i", x[a], x[b]) / (norm[a] * norm[b]) >= cosine
                a, b = a[near], b[near]
                if len(a):
                    first = (keys[a] == keys[b]).argmax(axis=1) == table[a]
                    yield a[first], b[first]

    def close(rows: pa.Table):
        unit = rows.column("unit").to_numpy()
        node, size = rows.column("node").to_numpy(), rows.column("size").to_numpy()
        x = _matrix(rows.column("embedding").combine_chunks())
        norm = np.sqrt((x * x).sum(axis=1))
        keys = rows.column("keys").combine_chunks().flatten().to_numpy().reshape(len(unit), -1)
        found = list(pairs(unit, rows.column("table").to_numpy(), rows.column("block").to_numpy(),
                           rows.column("mixed").to_numpy(zero_copy_only=False), x, norm, keys))
        if not found:
            return None
        a, b = (np.concatenate(p) for p in zip(*found))
        every, at = np.unique(node, return_inverse=True)
        a, b, weight = at[a], at[b], np.zeros(len(every), np.int64)
        weight[at] = size
        count = np.zeros(len(every), np.int64)
        np.add.at(count, a, weight[b])
        np.add.at(count, b, weight[a])
        root = np.arange(len(every))
        while True:
            low = np.minimum(root[a], root[b])
            new = root.copy()
            np.minimum.at(new, a, low)
            np.minimum.at(new, b, low)
            new = new[new]
            if (new == root).all():
                break
            root = new
        some = np.flatnonzero(count)
        return pa.RecordBatch.from_arrays([pa.array(every[some]), pa.array(count[some]), pa.array(every[root[some]])],
                                          names=["node", "links", "peer"])

    def run(batches):
        held = None
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            held = rows if held is None else pa.concat_tables([held, rows])
            unit = held.column("unit").to_numpy()
            cut = int(np.searchsorted(unit, unit[-1])) if len(unit) else 0
            if cut:
                out = close(held.slice(0, cut).combine_chunks())
                if out is not None:
                    yield out
                held = held.slice(cut).combine_chunks()
        if held is not None and len(held):
            out = close(held.combine_chunks())
            if out is not None:
                yield out
    return run


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                    cosine: float = 0.95, seed: int = 6) -> DataFrame:
    """One row per row of ``vectors``: ``vec_id, n_links, component_id, kept``.

    Two rows are linked if their cosine in double precision is at least ``cosine`` and they
    share a key (pairs at the threshold miss all tables once in ``1 / MISS``, closer pairs
    less often). Null, empty and zero vectors and vectors with null or non-finite components
    link with nothing and are kept. Vectors of different lengths compare as if filled with
    zeros. Equal vectors, repeated rows among them, are always linked with each other; rows
    with equal ids get rows of their own. Other columns are ignored, an empty table gives
    an empty result.
    """
    spark = vectors.sparkSession
    common.ship(spark)
    scratch = Scratch(spark, "vectors")
    every = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("embedding"))
    fit = usable(F.col("embedding")) & F.exists("embedding", lambda x: x != 0)
    classes = scratch.written(every.where(fit).groupBy("embedding")
                              .agg(F.min("vec_id").alias("least"), F.count("*").alias("size"))
                              .withColumn("node", F.monotonically_increasing_id()), "classes")
    k, tables = shape(classes.count(), cosine)
    keyed = scratch.written(classes.select("node", "embedding")
                            .mapInArrow(common.lean(_keys(k, tables, seed)), "node long, keys array<int>"), "keys")
    placed = keyed.select("node", F.posexplode("keys").alias("table", "key"))
    buckets = scratch.written(placed.groupBy("table", "key").agg(F.count("*").alias("members")).where("members > 1"),
                              "buckets")
    blocks = F.ceil(F.col("members") / F.lit(BLOCK)).cast("int")
    inside = (placed.join(buckets, ["table", "key"])
              .withColumn("blocks", blocks)
              .withColumn("block", F.pmod(F.xxhash64("node", "table"), F.col("blocks")).cast("int"))
              .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
              .select("node", "table", "block", (F.col("block") != F.col("other")).alias("mixed"),
                      F.xxhash64("table", "key", F.least("block", "other"), F.greatest("block", "other")).alias("unit")))
    inside = scratch.written(inside, "inside")
    full = classes.select("node", "size", "embedding").join(keyed, "node")
    linked = scratch.written(
        inside.join(full, "node").select("unit", "table", "block", "mixed", "node", "size", "embedding", "keys")
        .repartition("unit").sortWithinPartitions("unit")
        .mapInArrow(common.lean(_links(cosine)), "node long, links long, peer long"), "links")
    found = components(linked.where("node != peer").select(F.col("node").alias("a"), F.col("peer").alias("b")), scratch)
    counts = linked.groupBy("node").agg(F.sum("links").alias("links"))
    named = (classes.select("node", "embedding", "least", "size").join(counts, "node", "left").join(found, "node", "left")
             .withColumn("root", F.coalesce("root", "node"))
             .withColumn("n_links", F.col("size") - 1 + F.coalesce("links", F.lit(0))))
    named = scratch.written(named.select("embedding", "root", "least", "n_links"), "named")
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    named = scratch.written(named.join(least, "root").select(
        F.xxhash64("embedding").alias("hash"), F.col("embedding").alias("vector"), "n_links", "component_id"), "classes")
    out = every.withColumn("own", F.when(fit, F.xxhash64("embedding")))
    same = (F.col("own") == F.col("hash")) & (F.col("embedding") == F.col("vector"))
    out = out.join(named, same, "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.when(F.col("hash").isNull(), F.col("vec_id")).otherwise(F.col("component_id")).alias("component_id"))
    return scratch.finish(out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id"))))
