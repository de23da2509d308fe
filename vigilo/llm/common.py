"""Helpers shared by the operators: written tables, row numbers, vectorised word hashing."""

from __future__ import annotations

import contextlib
import ctypes
import functools
import os
import tempfile
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from vigilo.session import fresh_path, remove

#: Text bytes handled by one numpy pass; a longer text is a pass of its own.
CHUNK_BYTES = 1 << 20

# The white space of the words of documents.
SPACES = b" \t\n\x0b\x0c\r"

_U64 = np.uint64
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[list(SPACES)] = True
_LOWER = np.arange(256, dtype=np.uint64)
_LOWER[65:91] += np.uint64(32)
_BASE = _U64(0x9E3779B97F4A7C55)
_powers = np.ones(1, np.uint64)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/embeddings.parquet")


def ship(spark: SparkSession) -> None:
    """Makes this package importable in the Python workers of a session started without it."""
    sc = spark.sparkContext
    if getattr(sc, "_vigilo_shipped", False):
        return
    root = Path(__file__).resolve().parents[2]
    fd, name = tempfile.mkstemp(prefix="vigilo-", suffix=".zip")
    os.close(fd)
    with zipfile.ZipFile(name, "w") as z:
        for f in sorted((root / "vigilo").rglob("*.py")):
            z.write(f, f.relative_to(root))
    sc.addPyFile(name)
    sc._vigilo_shipped = True


class Scratch:
    """Intermediate tables of one operator call below the shared folder.

    ``written`` cuts the lineage with Parquet files that every executor sees, so a lost
    executor costs no recomputation of what lies before. ``finish`` writes the result and
    removes the other tables.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark, self.root, self.count = spark, fresh_path(spark, label), 0

    def path(self, name: str) -> str:
        self.count += 1
        return f"{self.root}/{self.count}-{name}"

    def written(self, df: DataFrame, name: str) -> DataFrame:
        path = self.path(name)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def finish(self, df: DataFrame) -> DataFrame:
        path = f"{self.root}-result"
        df.write.parquet(path)
        self.remove(self.root)
        return self.spark.read.schema(df.schema).parquet(path)

    def remove(self, path: str) -> None:
        remove(self.spark, path)


def unused(df: DataFrame, name: str) -> str:
    """``name``, with underscores appended until ``df`` has no such column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def with_row_number(df: DataFrame, order: list[str], name: str, scratch: Scratch) -> tuple[DataFrame, int]:
    """``df`` (written) plus a gapless 0-based row number by ``order``, and the row count.

    A range partitioning orders the rows, each partition counts its own rows, and only one
    count per partition is prefix-summed; the rows themselves never meet in one task.
    """
    mid = unused(df, "_at")
    # rows equal in all of ``order`` are spread by their place in the input
    ranged = (df.withColumn(mid, F.monotonically_increasing_id())
              .repartitionByRange(*order, mid).sortWithinPartitions(*order, mid)
              .withColumn(mid, F.monotonically_increasing_id()))
    table = scratch.written(ranged, "ordered")
    part = F.shiftright(F.col(mid), 33)
    counts = (table.groupBy(part.alias("_part")).agg(F.count("*").alias("_rows"))
              .withColumn("_before", F.sum("_rows").over(Window.orderBy("_part")) - F.col("_rows")))
    # one row per partition of the table
    counts = scratch.written(counts, "counts")
    total = counts.agg(F.sum("_rows")).first()[0] or 0
    inside = F.col(mid).bitwiseAND(F.lit((1 << 33) - 1))
    numbered = (table.withColumn("_part", part)
                .join(counts.select("_part", "_before"), "_part", "left")
                .withColumn(name, F.col("_before") + inside)
                .select(*df.columns, name))
    return numbered, int(total)


def bounded_sample(rows: DataFrame, draw: str, most: int, scratch: Scratch) -> DataFrame:
    """The rows with the ``most`` least values of ``draw``, one of those with equal values (so
    repeated rows count once); written. The bound holds whatever the values are."""
    # equal ones are merged before they are shuffled; dealt to tasks again, as the sample is small
    once = scratch.written(rows.dropDuplicates([draw]).repartition(32, draw), "drawn")
    # narrow, and at most that many
    found = once.select(draw).orderBy(draw).limit(most + 1).agg(F.count("*").alias("n"), F.max(draw).alias("last")).first()
    return once.where(F.col(draw) < found["last"]) if found["n"] > most else once


def release() -> None:
    """Gives freed memory back to the system; C libraries keep it otherwise, and a worker
    process lives through many tasks."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):   # not every C library has it
        ctypes.CDLL(None).malloc_trim(0)


def lean(run):
    """A function over the batches of a partition that releases memory between batches."""
    @functools.wraps(run)
    def released(batches):
        try:
            for out in run(batches):
                yield out
                del out
                release()
        finally:
            release()
    return released


def mix64(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser, in place on a fresh array."""
    x = x ^ (x >> _U64(30))
    x *= _U64(0xBF58476D1CE4E5B9)
    x ^= x >> _U64(27)
    x *= _U64(0x94D049BB133111EB)
    x ^= x >> _U64(31)
    return x


def powers(n: int) -> np.ndarray:
    """The first ``n`` powers of the hash base (modulo 2**64)."""
    global _powers
    if len(_powers) < n:
        grown = np.full(max(n, 2 * len(_powers), 256), _BASE, np.uint64)
        grown[0] = 1
        _powers = np.cumprod(grown, dtype=np.uint64)
    return _powers[:n]


def text_chunks(column: pa.Array, max_bytes: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(first row, end row, UTF-8 bytes, row offsets)`` per chunk of a string column.

    Null texts count as empty. The bytes are a view of Arrow's buffer.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    n = len(column)
    if not n:
        return
    _, offs, data = column.buffers()
    offsets = np.frombuffer(offs, np.int64)[column.offset: column.offset + n + 1]
    buf = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + max_bytes, "right")) - 1
        hi = min(max(hi, lo + 1), n)
        yield lo, hi, buf[offsets[lo]: offsets[hi]], offsets[lo: hi + 1] - offsets[lo]
        lo = hi


def word_hashes(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the lower-cased (A-Z) words of a chunk, and each row's first word.

    Row ``r`` has the words ``first[r]:first[r + 1]``.
    """
    rows = len(offsets) - 1
    at = np.flatnonzero(~_IS_SPACE[buf])
    if not len(at):
        return np.zeros(0, np.uint64), np.zeros(rows + 1, np.int64)
    starts = np.empty(len(at), bool)
    starts[0] = True
    np.not_equal(at[1:], at[:-1] + 1, out=starts[1:])
    # a text starts a word even if the text before it ends in one
    heads = np.searchsorted(at, offsets[:-1])
    starts[heads[heads < len(at)]] = True
    begin = np.flatnonzero(starts)
    length = np.diff(np.append(begin, len(at)))
    place = np.arange(len(at)) - np.repeat(begin, length)
    part = (_LOWER[buf[at]] + _U64(1)) * powers(int(length.max()))[place]
    hashes = mix64(np.add.reduceat(part, begin) + length.astype(np.uint64))
    return hashes, np.searchsorted(at[begin], offsets)
