"""Exact duplicates by composable polynomial fingerprints (operator 11).

The fingerprint of a byte string is its polynomial in a base modulo two primes, next to its
length. It is composable: ``H(x + y) = H(x) * base ** len(y) + H(y)``. Texts are hashed in
cells of ``CELL`` bytes, all cells of a block of rows at once, and the cell hashes are shifted
by the bytes that follow and added. The pieces of huge texts are dealt to all tasks and
their shifted hashes added by an aggregation, in any order.

Rows with equal fingerprints are then compared in full, chunk by chunk: every task streams
the chunks of its rows and keeps each distinct (group, chunk number, bytes) once, so a
group of any size shuffles little more than its different texts. A group with two different
chunks at one place (a collision) is split by whole texts.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigilo.llm import common, located
from vigilo.llm.common import Scratch

#: Moduli below 2**31, so that products fit 63 bits, and the bases.
PRIMES = (2_147_483_647, 2_147_483_629)
BASES = (1_103_515_245, 1_664_525_213)
CELL = 1 << 12
#: Texts with more bytes are hashed in pieces of so many, by several tasks.
HUGE = 1 << 20
#: Bytes of a chunk that is compared.
CHUNK = 1 << 15
#: A group with more than this share of all rows is hot; there are fewer than ``1 / HOT`` of them.
HOT = 1e-3

_FINGER = ["bytes", "f1", "f2"]


def powers(base: int, n: np.ndarray, prime: int) -> np.ndarray:
    """``base ** n`` modulo ``prime`` by squaring."""
    out, square, n = np.ones(len(n), np.int64), base % prime, n.copy()
    while n.any():
        odd = n & 1 == 1
        out[odd] = out[odd] * square % prime
        square = square * square % prime
        n >>= 1
    return out


def combine(left: int, right: int, right_bytes: int, base: int, prime: int) -> int:
    """The hash of two strings one after the other."""
    return (left * pow(base, right_bytes, prime) + right) % prime


def fingerprints(buf: np.ndarray, offsets: np.ndarray, after: np.ndarray | None = None,
                 primes: tuple[int, int] = PRIMES) -> list[np.ndarray]:
    """Hashes of the rows of a block modulo each prime, shifted by the ``after`` bytes that
    follow each row in its text."""
    size = np.diff(offsets)
    cells = -(-size // CELL)
    row = np.repeat(np.arange(len(size)), cells)
    number = np.arange(len(row)) - np.repeat(np.cumsum(cells) - cells, cells)
    begin = offsets[:-1][row] + number * CELL
    length = np.minimum(size[row] - number * CELL, CELL)
    rest = size[row] - number * CELL - length
    if after is not None:
        rest = rest + after[row]
    out = []
    for base, prime in zip(BASES, primes):
        own = powers(base, np.arange(CELL), prime)
        total = np.zeros(len(size), np.int64)
        if len(row):
            # the power of a byte is how many bytes of its cell follow
            place = np.repeat(begin + length - 1, length) - np.arange(int(offsets[0]), int(offsets[-1]))
            part = np.add.reduceat((buf.astype(np.int64) + 1) * own[place], begin - offsets[0]) % prime
            np.add.at(total, row, part * powers(base, rest, prime) % prime)
        out.append(total % prime)
    return out


def _hashed(primes):
    def run(batches):
        for batch in batches:
            raw = batch.column("text")
            for lo, hi, buf, offsets in common.text_chunks(raw):
                f1, f2 = fingerprints(buf, offsets, primes=primes)
                here = batch.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays(
                    [here.column(c) for c in ("file", "row", "doc_id", "sha")] + [pa.array(np.diff(offsets)), pa.array(f1), pa.array(f2)],
                    names=["file", "row", "doc_id", "sha", *_FINGER])
    return run


def _pieces(primes):
    def run(batches):
        for batch in batches:
            for i in range(len(batch)):
                piece = np.frombuffer(batch.column("piece")[i].as_buffer(), np.uint8)
                after = np.array([batch.column("after")[i].as_py()])
                f1, f2 = fingerprints(piece, np.array([0, len(piece)]), after, primes)
                yield pa.RecordBatch.from_arrays(
                    [batch.slice(i, 1).column(c) for c in ("file", "row", "doc_id", "sha", "bytes")] + [pa.array(f1), pa.array(f2)],
                    names=["file", "row", "doc_id", "sha", *_FINGER])
    return run


def _cut(raw: Column, size: int) -> Column:
    """The bytes of ``raw`` in parts of ``size``, numbered; an empty one has one empty part."""
    last = F.floor(F.greatest(F.octet_length(raw) - 1, F.lit(0)) / F.lit(size)).cast("int")
    return F.transform(F.sequence(F.lit(0), last),
                       lambda i: F.struct(i.alias("i"), F.substring(raw, i * size + 1, F.lit(size)).alias("part")))


def _fingered(placed: DataFrame, huge: int, primes) -> DataFrame:
    """``file, row, doc_id, sha`` and the fingerprint of every row of ``placed``."""
    sized = placed.withColumn("sha", F.sha2("text", 256))
    long = F.octet_length("text") > huge
    kind = "file string, row long, doc_id long, sha string, bytes long, f1 long, f2 long"
    whole = sized.where(~long).mapInArrow(common.lean(_hashed(primes)), kind)
    raw = F.col("text").cast("binary")
    parts = (sized.where(long)
             .select("file", "row", "doc_id", "sha", F.octet_length("text").cast("long").alias("bytes"), F.explode(_cut(raw, huge)).alias("p"))
             .select("file", "row", "doc_id", "sha", "bytes", F.col("p.part").alias("piece"),
                     F.greatest(F.col("bytes") - (F.col("p.i").cast("long") + 1) * huge, F.lit(0)).alias("after"))
             .repartition("file", "row", "after"))
    added = lambda c, p: (F.sum(c) % F.lit(p)).cast("long").alias(c)
    joined = (parts.mapInArrow(common.lean(_pieces(primes)), kind)
              .groupBy("file", "row", "doc_id", "sha", "bytes").agg(added("f1", primes[0]), added("f2", primes[1])))
    return whole.unionByName(joined)


def _grouped(rows: DataFrame, key: list[str], scratch: Scratch) -> DataFrame:
    """``rows`` plus ``group`` (null if alone), ``size`` and the ``keep`` (id, row number) of
    their group of equal ``key``. Hot groups, of which there are fewer than ``1 / HOT``, meet
    their rows in a broadcast join; in the other join no key is hot."""
    groups = scratch.written(rows.groupBy(*key).agg(F.count("*").alias("size"), F.min("rid").alias("group"),
                                                    F.max(F.struct("doc_id", "rid")).alias("keep"))
                             .where("size > 1"), "groups")
    least = int(rows.count() * HOT)
    hot, others = groups.where(F.col("size") > least), groups.where(F.col("size") <= least)
    first = rows.join(F.broadcast(hot), key)
    rest = rows.join(F.broadcast(hot.select(*key)), key, "left_anti").join(others, key, "left")
    return scratch.written(first.unionByName(rest), "grouped")


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", huge: int = HUGE,
                 primes: tuple[int, int] = PRIMES, with_place: bool = False) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, keep_id, group_size, kept, text_sha256``;
    ``with_place`` adds the row's place (``file``, ``row``) in ``docs``, which must then be of
    :func:`located.scanned`.

    Texts are equal when identical byte for byte; null counts as empty. Of equal texts the row
    with the largest id stays, null being less than any id; of several rows with that id one
    stays. ``group_size`` counts rows, repeated ones too; ``text_sha256`` is of the UTF-8 text.
    Further columns are ignored; an empty table gives an empty result. Texts are read whole.
    """
    spark = docs.sparkSession
    common.ship(spark)
    scratch = Scratch(spark, "exact")
    slim = located.scanned(docs.select(F.col(id_col).cast("long").alias("doc_id"),
                                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")), scratch)
    placed = located.place(slim).withColumnsRenamed(dict(zip(located.names(slim), ("file", "row"))))
    rows = scratch.written(_fingered(placed, huge, primes).withColumn("rid", F.monotonically_increasing_id()), "fingerprints")
    grouped = _grouped(rows, _FINGER, scratch)
    folder = scratch.path("lists")
    located.write_lists(grouped.where("group is not null").select("file", "row", F.col("group").alias("value")), folder)
    again = placed.withColumn("group", located.marked(folder)(F.col("file"), F.col("row"))).where("group is not null")
    chunks = again.select("group", F.explode(_cut(F.col("text").cast("binary"), CHUNK)).alias("c"))
    differ = (chunks.select("group", "c.i", "c.part").distinct().groupBy("group", "i").count().where("count > 1")
              .select("group").distinct())
    collided = scratch.written(differ, "collided")
    if not collided.isEmpty():
        grouped = _split(grouped, again, collided, scratch)
    alone = F.col("group").isNull()
    out = grouped.select(
        "doc_id", F.when(alone, F.col("doc_id")).otherwise(F.col("keep.doc_id")).alias("keep_id"),
        F.coalesce("size", F.lit(1)).cast("long").alias("group_size"),
        (alone | (F.col("rid") == F.col("keep.rid"))).alias("kept"), F.col("sha").alias("text_sha256"),
        *(["file", "row"] if with_place else []))
    return scratch.finish(out)


def _split(grouped: DataFrame, again: DataFrame, collided: DataFrame, scratch: Scratch) -> DataFrame:
    """The rows of collided groups grouped anew by their whole texts."""
    texts = again.join(collided, "group").select("file", "row", "group", "text")
    classes = scratch.written(texts.select("group", "text").distinct()
                              .withColumn("class", F.monotonically_increasing_id()), "classes")
    classed = texts.join(classes, ["group", "text"]).select("file", "row", "class")
    wrong = grouped.join(collided, "group", "left_semi").drop("group", "size", "keep")
    right = grouped.join(collided, "group", "left_anti")
    return right.unionByName(_grouped(wrong.join(classed, ["file", "row"]), ["class"], scratch).drop("class"))


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each group of equal texts (see :func:`exact_groups`), all its
    columns; texts aren't shuffled, each scan task drops its own rows."""
    scratch = Scratch(docs.sparkSession, "exact-drop")
    docs = located.scanned(docs, scratch)
    found = exact_groups(docs, id_col, text_col, with_place=True)
    return located.without(docs, found.where("not kept").select("file", "row"), scratch)
