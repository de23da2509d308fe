"""Reproducible shuffle into shards by a Feistel permutation (operator 2).

Rows are numbered 0..n-1 in the order of their ids. A keyed Feistel network permutes the
least power of four that is not below n; values at n or above walk on along their cycle
until they fall below n, which makes it a permutation of the row numbers. The place of a
row in the shuffle gives its shard (place mod shards) and slot (place div shards), so both
can be computed from the row number alone, and the row number from shard and slot.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigilo.llm import common
from vigilo.llm.common import Scratch, mix64

ROUNDS = 4


def _network(x: np.ndarray, half: int, seed: int, rounds: range) -> np.ndarray:
    mask = np.uint64((1 << half) - 1)
    left, right = x >> np.uint64(half), x & mask
    for r in rounds:
        if rounds.step > 0:
            left, right = right, left ^ (_round(right, seed, r) & mask)
        else:
            left, right = right ^ (_round(left, seed, r) & mask), left
    return (left << np.uint64(half)) | right


def _round(x: np.ndarray, seed: int, r: int) -> np.ndarray:
    key = np.uint64(((2 * seed + 1) * 0x9E3779B97F4A7C15 + r * 0xD1B54A32D192ED03) % 2 ** 64)
    return mix64(mix64(x + key))


def permute(x: np.ndarray, n: int, seed: int = 0, inverse: bool = False) -> np.ndarray:
    """The place of each row number of ``x`` in a shuffle of ``n`` rows; ``inverse`` goes back."""
    half = max(1, (max(n - 1, 1).bit_length() + 1) // 2)
    rounds = range(ROUNDS - 1, -1, -1) if inverse else range(ROUNDS)
    out = _network(np.asarray(x).astype(np.uint64), half, seed, rounds)
    walking = np.flatnonzero(out >= n)
    while len(walking):
        out[walking] = _network(out[walking], half, seed, rounds)
        walking = walking[out[walking] >= n]
    return out.astype(np.int64)


def shard_and_slot(row: int, n: int, shards: int, seed: int = 0) -> tuple[int, int]:
    place = int(permute(np.array([row]), n, seed)[0])
    return place % shards, place // shards


def row_at(shard: int, slot: int, n: int, shards: int, seed: int = 0) -> int:
    """The row number that lies in ``slot`` of ``shard``."""
    return int(permute(np.array([slot * shards + shard]), n, seed, inverse=True)[0])


def assign_shards(docs: DataFrame, order: list[str], shards: int, seed: int = 0) -> DataFrame:
    """``docs`` plus ``shard`` (int) and ``slot`` (long, gapless from 0 in each shard).

    ``order`` numbers the rows (nulls first); rows equal in all of it are interchangeable.
    Shard sizes differ by one row at most, whatever the ids, sources or copies. An empty
    table gives an empty result. Columns of ``docs`` named shard or slot are replaced.
    """
    common.ship(docs.sparkSession)
    docs = docs.drop("shard", "slot")
    scratch = Scratch(docs.sparkSession, "shards")
    number = common.unused(docs, "_row")
    numbered, n = common.with_row_number(docs, order, number, scratch)

    @F.pandas_udf("long")
    def place(rows: pd.Series) -> pd.Series:
        return pd.Series(permute(rows.to_numpy(), n, seed))

    return (numbered.withColumn(number, place(number))
            .withColumn("shard", F.pmod(F.col(number), F.lit(shards)).cast("int"))
            .withColumn("slot", F.floor(F.col(number) / F.lit(shards)).cast("long"))
            .drop(number))


def write_shards(docs: DataFrame, path: str, order: list[str], shards: int, seed: int = 0) -> None:
    """``docs`` as Parquet folders ``shard=N`` with the rows of each file in slot order."""
    placed = assign_shards(docs, order, shards, seed)
    (placed.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
     .write.partitionBy("shard").parquet(path))
