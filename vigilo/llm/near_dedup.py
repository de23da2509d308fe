"""MinHash near-duplicate detection (operator 4).

A document's set are its distinct word shingles. One-permutation hashing splits the hash
range into bins and keeps the least shingle hash of each; empty bins are filled by optimal
densification (a bin borrows from a filled bin drawn by a hash of bin and attempt). Bands
of bins are bucket keys. In each bucket a hub is compared with every other member (a star),
so the pairs grow with the members and not with their square. Candidate links are confirmed
on the full shingle sets. Buckets whose members still lie in several components get an exact
second pass that compares across components in bounded blocks and emits links only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigilo.llm import common, located
from vigilo.llm.common import Scratch, mix64
from vigilo.llm.components import components

BINS, ROWS = 128, 4
BANDS = BINS // ROWS
#: Buckets above this size get a second hub, in one of several orders: together the bands
#: then connect a loose group through many hubs.
CROWD, HUB_ORDERS = 8, 8
#: Strays and members per unit of the exact second pass.
STRAYS, MEMBERS = 256, 1024

_STEP = np.uint64(0x9E3779B97F4A7C15)
#: Bits flipped in the node numbers to order them anew.
_FLIPS = (mix64(np.arange(1, HUB_ORDERS + 1, dtype=np.uint64)) >> np.uint64(1)).astype(np.int64)


def shingle_sets(column: pa.Array, width: int) -> Iterator[np.ndarray]:
    """Per text the sorted distinct 64-bit hashes of its shingles.

    Fewer than ``width`` words give one shingle of the whole sequence; no word gives none.
    """
    for lo, hi, buf, offsets in common.text_chunks(column):
        h, first = common.word_hashes(buf, offsets)
        m = max(len(h) - width + 1, 0)
        s = h[:m] * _STEP
        for k in range(1, width):
            s = mix64(s + h[k: m + k]) * _STEP
        s = mix64(s)
        for r in range(hi - lo):
            a, b = int(first[r]), int(first[r + 1])
            if b - a >= width:
                yield np.unique(s[a: b - width + 1])
            elif b > a:
                one = np.array([b - a], np.uint64)
                for k in range(a, b):
                    one = mix64(one * _STEP + h[k: k + 1])
                yield one
            else:
                yield np.zeros(0, np.uint64)


def signature(shingles: np.ndarray) -> np.ndarray:
    """The densified one-permutation signature of a non-empty sorted set."""
    shift = np.uint64(64 - BINS.bit_length() + 1)
    bins, at = np.unique((shingles >> shift).astype(np.int64), return_index=True)
    sig = np.zeros(BINS, np.uint64)
    filled = np.zeros(BINS, bool)
    filled[bins] = True
    sig[bins] = shingles[at]
    empty = np.flatnonzero(~filled)
    attempt = 0
    while len(empty):
        attempt += 1
        draw = mix64(empty.astype(np.uint64) * _STEP + np.uint64(attempt))
        lender = (draw % np.uint64(BINS)).astype(np.int64)
        hit = filled[lender]
        sig[empty[hit]] = sig[lender[hit]]
        empty = empty[~hit]
    return sig


def band_keys(sig: np.ndarray) -> np.ndarray:
    parts = sig.reshape(BANDS, ROWS)
    key = np.arange(BANDS, dtype=np.uint64)
    for k in range(ROWS):
        key = mix64(key * _STEP + parts[:, k])
    return key


def _set_key(shingles: np.ndarray) -> tuple[int, int]:
    """128 bits that identify a set."""
    if not len(shingles):
        return 0, 0
    a = mix64(shingles + _STEP).sum(dtype=np.uint64)
    b = np.bitwise_xor.reduce(mix64(shingles ^ _STEP))
    pair = mix64(np.array([a + np.uint64(len(shingles)), b], np.uint64)).astype(np.int64)
    return int(pair[0]), int(pair[1])


def _sketch(width: int, named: list[str]):
    def run(batches):
        for batch in batches:
            n, k1, k2, keys = [], [], [], []
            for s in shingle_sets(batch.column("text"), width):
                n.append(len(s))
                x, y = _set_key(s)
                k1.append(x)
                k2.append(y)
                keys.append(band_keys(signature(s)).astype(np.int64) if len(s) else [])
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in named), pa.array(n, pa.int64()),
                 pa.array(k1, pa.int64()), pa.array(k2, pa.int64()), pa.array(keys, pa.list_(pa.int64()))],
                names=[*named, "n_shingles", "k1", "k2", "bands"])
    return run


def _full_sets(width: int):
    def run(batches):
        for batch in batches:
            keep, sets = [], []
            k1, k2 = batch.column("k1").to_numpy(), batch.column("k2").to_numpy()
            for i, s in enumerate(shingle_sets(batch.column("text"), width)):
                if _set_key(s) == (k1[i], k2[i]):
                    keep.append(i)
                    sets.append(s.tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("node").take(pa.array(keep, pa.int64())), pa.array(sets, pa.binary())],
                names=["node", "shingles"])
    return run


def similar(common_size: int, a: int, b: int, percent: int) -> bool:
    return 100 * common_size >= percent * (a + b - common_size)


def _confirm(percent: int):
    """Keeps the pairs whose full sets are similar."""
    def run(batches):
        for batch in batches:
            keep = []
            left, right = batch.column("sa"), batch.column("sb")
            for i in range(len(batch)):
                a = np.frombuffer(left[i].as_buffer(), np.uint64)
                b = np.frombuffer(right[i].as_buffer(), np.uint64)
                at = np.searchsorted(a, b)
                at[at == len(a)] = 0
                if similar(int(np.count_nonzero(a[at] == b)), len(a), len(b), percent):
                    keep.append(i)
            yield pa.RecordBatch.from_arrays([batch.column(c).take(pa.array(keep, pa.int64())) for c in ("a", "b")],
                                             names=["a", "b"])
    return run


def _across(percent: int):
    """Links between strays of a bucket and its members of other components.

    A link found makes its two components one for the rest of the task, so what comes out
    is at most one link per member and stray.
    """
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        strays, members = frame[frame.stray], frame[~frame.stray]
        out = []
        if len(strays) and len(members):
            sets = [np.frombuffer(x, np.uint64) for x in members.shingles]
            sizes = np.array([len(x) for x in sets], np.int64)
            flat, begin = np.concatenate(sets), np.cumsum(sizes) - sizes
            root, nodes = members.root.to_numpy().copy(), members.node.to_numpy()
            mine = dict(zip(strays.node, strays.root))
            for node, shingles in zip(strays.node, strays.shingles):
                a = np.frombuffer(shingles, np.uint64)
                fits = (root != mine[node]) & (100 * np.minimum(sizes, len(a)) >= percent * np.maximum(sizes, len(a)))
                if not fits.any():
                    continue
                at = np.searchsorted(a, flat)
                at[at == len(a)] = 0
                shared = np.add.reduceat((a[at] == flat).astype(np.int64), begin)
                for j in np.flatnonzero(fits & (100 * shared >= percent * (sizes + len(a) - shared))):
                    own, gone = mine[node], root[j]
                    if gone != own:
                        out.append((node, nodes[j]))
                        root[root == gone] = own
                        mine = {k: own if v == gone else v for k, v in mine.items()}
        return pd.DataFrame(out, columns=["a", "b"], dtype="int64")
    return run


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    width: int = 5, percent: int = 80, with_root: bool = False) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, text_hash, n_shingles, component_id, kept``;
    ``with_root`` adds ``root``, a number of the group that holds with null and repeated ids
    too (null without shingles), and the row's place (``file``, ``row``) in ``docs``, which
    must then be of :func:`located.scanned`.

    Two rows are linked if ``100 * |A & B| >= percent * |A | B|`` for their shingle sets.
    ``component_id`` is the least id reachable by links, ``kept`` marks the row with that id.
    Null and blank texts have no shingles, link with nothing and are kept. Equal texts are
    one node of the graph. Repeated rows (same id and text) get equal rows; a null id counts
    as larger than any other, and a row is kept when its group has only null ids. Further
    columns of ``docs`` are ignored. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    common.ship(spark)
    scratch = Scratch(spark, "near")
    place = ["file", "row"] if with_root else []
    if with_root:
        named = dict(zip(place, located.names(docs)))
        docs = located.place(docs)
    text = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
                       F.xxhash64(F.col(text_col)).alias("text_hash"), *[F.col(named[c]).alias(c) for c in place])
    sketched = scratch.written(text.mapInArrow(common.lean(_sketch(width, ["doc_id", "text_hash", *place])),
                                               "doc_id long, text_hash long, " + ("file string, row long, " if place else "")
                                               + "n_shingles long, k1 long, k2 long, bands array<long>")
                       .withColumn("rid", F.monotonically_increasing_id()), "sketch")
    rows = sketched.drop("bands")
    nodes = scratch.written(rows.where("n_shingles > 0").groupBy("k1", "k2")
                            .agg(F.min("rid").alias("node"), F.min("doc_id").alias("least")), "nodes")
    # the band number is part of a key
    members = scratch.written(sketched.join(nodes.select(F.col("node").alias("rid")), "rid", "left_semi")
                              .select(F.col("rid").alias("node"), F.col("n_shingles").alias("n"),
                                      F.explode("bands").alias("key")), "members")
    buckets = scratch.written(members.groupBy("key")
                              .agg(F.count("*").alias("size"), F.min("node").alias("hub"), F.min_by("n", "node").alias("hub_n"))
                              .where("size > 1"), "buckets")
    inside = scratch.written(members.join(buckets, "key"), "inside")
    fits = F.least("n", "hub_n") * 100 >= F.greatest("n", "hub_n") * percent
    flip = F.element_at(F.array(*[F.lit(int(x)) for x in _FLIPS]), (F.pmod("key", F.lit(HUB_ORDERS)) + 1).cast("int"))
    flipped = F.col("node").bitwiseXOR(flip)
    crowds = inside.where(F.col("size") > CROWD)
    second = scratch.written(crowds.groupBy("key").agg(F.min(flipped).alias("hub"), F.min_by("n", flipped).alias("hub_n"))
                             .withColumn("hub", F.col("hub").bitwiseXOR(flip)), "second")
    spokes = lambda df: (df.where((F.col("node") != F.col("hub")) & fits)
                         .select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b")))
    star = scratch.written(spokes(inside).unionByName(spokes(crowds.drop("hub", "hub_n").join(second, "key"))).distinct(),
                           "star")
    wanted = (star.select(F.explode(F.array("a", "b")).alias("node"))
              .union(inside.where("size > 2").select("node")).distinct())
    where = scratch.written(nodes.join(wanted, "node", "left_semi")
                            .join(rows.select(F.col("rid").alias("node"), "doc_id", "text_hash"), "node")
                            .select("node", F.coalesce("doc_id", F.lit(-1)).alias("id"), "text_hash", "k1", "k2"), "wanted")
    sets = _sets_of(scratch, text, where, width)
    links = scratch.written(star.join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb")), "b")
                            .join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa")), "a")
                            .select("a", "b", "sa", "sb")
                            .mapInArrow(common.lean(_confirm(percent)), "a long, b long"), "links")
    found = components(links, scratch)
    links = links.unionByName(_rest(scratch, inside, found, sets, percent))
    found = components(links, scratch)
    root = F.coalesce("root", "node")
    least = (nodes.join(found, "node", "left").withColumn("root", root)
             .groupBy("root").agg(F.min("least").alias("component_id")))
    grouped = scratch.written(nodes.join(found, "node", "left").withColumn("root", root)
                      .join(least, "root").select("k1", "k2", "component_id", "root"), "grouped")
    out = rows.join(grouped, ["k1", "k2"], "left").select(
        "doc_id", "text_hash", "n_shingles",
        F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
        F.col("doc_id").eqNullSafe(F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))).alias("kept"),
        *(["root", *place] if with_root else []))
    return scratch.finish(out)


def _sets_of(scratch: Scratch, text: DataFrame, where: DataFrame, width: int) -> DataFrame:
    """The full shingle sets of the nodes in ``where``, made again from their texts.

    Only texts that may be wanted are shuffled: Spark's runtime Bloom filter of ids and text
    hashes (bounded by its own settings) drops the others at the scan. Rows with equal id and
    text are one row before they are joined, so a node meets only its own text, however many
    ids are null or equal. Both are only a way to find the texts: a set counts if its key is
    the node's.
    """
    conf, name = scratch.spark.conf, "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold"
    before = conf.get(name)
    conf.set(name, "1b")
    try:
        once = (text.groupBy(F.coalesce("doc_id", F.lit(-1)).alias("id"), "text_hash")
                .agg(F.first("text").alias("text")))
        found = once.join(where.where("node >= 0"), ["id", "text_hash"])
        return scratch.written(found.select("node", "k1", "k2", "text")
                               .mapInArrow(common.lean(_full_sets(width)), "node long, shingles binary")
                               .dropDuplicates(["node"]), "sets")
    finally:
        conf.set(name, before)


def _rest(scratch: Scratch, inside: DataFrame, found: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links that the stars missed, hubs aside: in buckets whose members lie in several
    components, the members outside the largest one (strays) meet all others."""
    left = scratch.written(inside.where("size > 2 and node != hub").select("key", "node")
                           .join(found, "node", "left").withColumn("root", F.coalesce("root", "node")), "left")
    mixed = (left.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count("*").alias("size"),
                                     F.bit_xor(F.xxhash64("node")).alias("x"), F.bit_xor(F.xxhash64("node", "node")).alias("y"))
             .where("low != high"))
    # buckets with the same members are looked at once
    mixed = scratch.written(mixed.groupBy("size", "x", "y").agg(F.min("key").alias("key")).select("key", "size"), "mixed")
    left = left.join(mixed, "key")
    main = (left.groupBy("key", "root").agg(F.count("*").alias("rows"), F.first("size").alias("size"))
            .groupBy("key").agg(F.max(F.struct("rows", "root")).alias("main"), F.first("size").alias("size"))
            .select("key", F.col("main.root").alias("main"),
                    F.ceil((F.col("size") - F.col("main.rows")) / F.lit(STRAYS)).cast("int").alias("stray_blocks"),
                    F.ceil(F.col("size") / F.lit(MEMBERS)).cast("int").alias("blocks")))
    left = left.drop("size").join(scratch.written(main, "main"), "key")
    dealt = lambda n: F.pmod(F.xxhash64("node", "key"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    strays = (left.where("root != main").withColumn("i", dealt("stray_blocks")).withColumn("j", every("blocks"))
              .select("key", "i", "j", "node", "root", F.lit(True).alias("stray")))
    members = (left.withColumn("j", dealt("blocks")).withColumn("i", every("stray_blocks"))
               .select("key", "i", "j", "node", "root", F.lit(False).alias("stray")))
    return (strays.unionByName(members).join(sets, "node").groupBy("key", "i", "j")
            .applyInPandas(_across(percent), "a long, b long"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one row of each group of near-duplicates, the first by id (null last), text
    hash and place; rows without shingles all stay.

    The row that stays is found on narrow rows: one partial minimum per group and task, then
    an anti-join on places, in which no key occurs twice. The others are dropped by the tasks
    that scan them, so texts aren't shuffled. ``docs`` that isn't read from files as it stands is
    written first."""
    scratch = Scratch(docs.sparkSession, "near-keep")
    docs = located.scanned(docs, scratch)
    rows = (near_duplicates(docs, id_col, text_col, width, percent, with_root=True).where("n_shingles > 0")
            .select("root", F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash", "file", "row").alias("m")))
    first = rows.groupBy("root").agg(F.min("m").alias("m")).select("m.file", "m.row")
    gone = rows.select("m.file", "m.row").join(first, ["file", "row"], "left_anti")
    return located.without(docs, gone, scratch)
