"""Token ids in binary files with Elias-Fano encoded document boundaries (operator 5).

A segment file holds the ids of consecutive documents one after the other and where each
document ends. The ends are a rising sequence, so they are Elias-Fano encoded: the low bits
of every end packed, the high bits in unary, and every 64th one bit's place as a sample from
which ``select`` finds any end with one short scan. That takes about two bits a document and
the low bits, against 64 bits in a plain table.

File (little-endian): 8 bytes ``EFTOKEN1``; five uint64: documents, ids, low bits, bytes of an
id (2 or 4), bytes of the high part; then ids, document ids (int64), their null flags (one
byte each), low bits, high bits, select samples (uint64).
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from vigilo.llm import common, tokens
from vigilo.llm.common import Scratch

MAGIC = b"EFTOKEN1"
#: A segment file is closed at so many ids (a longer document is a segment of its own) or documents.
SEGMENT_IDS = 1 << 21
SEGMENT_DOCS = 1 << 17
SAMPLE = 64


class EliasFano:
    """A rising sequence of non-negative numbers in near-minimal space."""

    def __init__(self, n: int, bits: int, low: np.ndarray, high: np.ndarray, samples: np.ndarray):
        self.n, self.bits, self.low, self.high, self.samples = n, bits, low, high, samples

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, np.uint64)
        n = len(values)
        top = int(values[-1]) if n else 0
        bits = max(0, (top // n).bit_length() - 1) if n else 0
        ones = (values >> np.uint64(bits)).astype(np.int64) + np.arange(n)
        plane = np.zeros(int(ones[-1]) + 1 if n else 0, np.uint8)
        plane[ones] = 1
        digits = (values[:, None] >> np.arange(bits, dtype=np.uint64)) & np.uint64(1)
        return cls(n, bits, np.packbits(digits.astype(np.uint8).ravel(), bitorder="little"),
                   np.packbits(plane, bitorder="little"), ones[::SAMPLE].astype(np.uint64))

    def _low(self, first: int, last: int) -> np.ndarray:
        if not self.bits:
            return np.zeros(last - first, np.uint64)
        a, b = first * self.bits, last * self.bits
        digits = np.unpackbits(self.low[a // 8: (b + 7) // 8], bitorder="little")[a % 8: a % 8 + b - a]
        return digits.reshape(-1, self.bits).astype(np.uint64) @ (np.uint64(1) << np.arange(self.bits, dtype=np.uint64))

    def select(self, i: int) -> int:
        """The ``i``-th number, read from one sample on."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        at, skip = int(self.samples[i // SAMPLE]), i % SAMPLE
        byte, rest = at // 8, skip
        head = int(self.high[byte]) >> (at % 8) << (at % 8)
        while head.bit_count() <= rest:
            rest -= head.bit_count()
            byte += 1
            head = int(self.high[byte])
        for _ in range(rest):
            head &= head - 1
        one = 8 * byte + (head & -head).bit_length() - 1
        return ((one - i) << self.bits) | int(self._low(i, i + 1)[0])

    def all(self) -> np.ndarray:
        ones = np.flatnonzero(np.unpackbits(self.high, bitorder="little"))[: self.n]
        high = (ones - np.arange(self.n)).astype(np.uint64)
        return ((high << np.uint64(self.bits)) | self._low(0, self.n)).astype(np.int64)


def pack_segment(ids: np.ndarray, ends: np.ndarray, doc_ids: np.ndarray, null_ids: np.ndarray, width: int) -> bytes:
    index = EliasFano.of(ends)
    head = np.array([len(ends), len(ids), index.bits, width, len(index.high)], "<u8")
    return b"".join((MAGIC, head.tobytes(), ids.astype(f"<u{width}").tobytes(), doc_ids.astype("<i8").tobytes(),
                     null_ids.astype(np.uint8).tobytes(), index.low.tobytes(), index.high.tobytes(),
                     index.samples.astype("<u8").tobytes()))


class Segment:
    """A segment file's content; documents are read by their number in it."""

    def __init__(self, data: bytes):
        if data[:8] != MAGIC:
            raise ValueError("not a token file")
        n, size, bits, width, high = (int(x) for x in np.frombuffer(data, "<u8", 5, 8))
        at = 48
        self.ids = np.frombuffer(data, f"<u{width}", size, at)
        at += size * width
        self.doc_ids = np.frombuffer(data, "<i8", n, at)
        at += 8 * n
        self.null_ids = np.frombuffer(data, np.uint8, n, at).astype(bool)
        at += n
        low = (n * bits + 7) // 8
        parts = np.frombuffer(data, np.uint8, low, at), np.frombuffer(data, np.uint8, high, at + low)
        self.ends = EliasFano(n, bits, *parts, np.frombuffer(data, "<u8", -(-n // SAMPLE), at + low + high))

    def __len__(self) -> int:
        return self.ends.n

    def document(self, i: int) -> np.ndarray:
        return self.ids[self.ends.select(i - 1) if i else 0: self.ends.select(i)].astype(np.uint32)


def _files(uri: str):
    from pyarrow import fs
    return fs.FileSystem.from_uri(uri)


def _write(uri: str, path: str, spaced: bool, end_id: int):
    def run(batches):
        task = TaskContext.get()
        store, root = _files(uri)
        store.create_dir(root, recursive=True)
        encoder = tokens.encoder(path, spaced)
        width = 2 if max(encoder.tokenizer.get_vocab_size(), end_id + 1) <= 1 << 16 else 4
        part, seq = task.partitionId(), 0
        held, sizes, doc_ids, nulls, size = [], [], [], [], 0

        def close():
            nonlocal held, sizes, doc_ids, nulls, size, seq
            # the attempt is part of the name: only files of finished tasks are in the manifest
            name = f"part-{part:06d}-{seq:06d}-{task.taskAttemptId()}.tok"
            data = pack_segment(np.concatenate(held), np.cumsum(sizes), np.array(doc_ids), np.array(nulls), width)
            with store.open_output_stream(f"{root}/{name}") as out:
                out.write(data)
            row = pa.RecordBatch.from_arrays([pa.array([part]), pa.array([seq]), pa.array([name]), pa.array([len(sizes)]),
                                              pa.array([size])], names=["part", "seq", "name", "docs", "ids"])
            held, sizes, doc_ids, nulls, size, seq = [], [], [], [], 0, seq + 1
            return row

        last = np.array([end_id], np.uint32)
        for batch in batches:
            keys = batch.column("doc_id")
            missing = keys.is_null().to_numpy(zero_copy_only=False)
            keys = keys.fill_null(0).to_numpy()
            for lo, hi, ids, at in encoder.encode(batch.column("text")):
                for r in range(lo, hi):
                    own = ids[at[r - lo]: at[r - lo + 1]]
                    if sizes and (size + len(own) + 1 > SEGMENT_IDS or len(sizes) >= SEGMENT_DOCS):
                        yield close()
                    held += [own.copy(), last]
                    sizes.append(len(own) + 1)
                    doc_ids.append(keys[r])
                    nulls.append(missing[r])
                    size += len(own) + 1
        if sizes:
            yield close()
    return run


def write_tokens(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
                 spaced: bool = True, end_id: int = 0) -> tuple[str, DataFrame]:
    """Writes the ids of all texts in ascending id order; ``(folder, manifest)``.

    Each document is its text's ids and ``end_id``. The manifest has one row per file:
    ``name, docs, ids, start`` with ``start`` the ids in the files before it. Null ids come
    first, null and empty texts are just ``end_id``, rows with equal ids are ordered by their
    text's hash, other columns are ignored, and an empty table gives an empty manifest.
    A range partitioning spreads the ids; equal ids are spread by their text's hash, equal rows
    by their place.
    """
    spark = docs.sparkSession
    common.ship(spark)
    scratch = Scratch(spark, "tokens")
    folder = f"{scratch.root}-files"
    ordered = (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
               .withColumn("tie", F.xxhash64("text")).withColumn("place", F.monotonically_increasing_id())
               .repartitionByRange("doc_id", "tie", "place").sortWithinPartitions("doc_id", "tie", "place"))
    manifest = scratch.written(
        ordered.select("doc_id", "text").mapInArrow(common.lean(_write(folder, tokenizer, spaced, end_id)),
                                                    "part long, seq long, name string, docs long, ids long"), "manifest")
    # one row per partition of the writing job
    parts = scratch.written(manifest.groupBy("part").agg(F.sum("ids").alias("all"))
                            .withColumn("before", F.sum("all").over(Window.orderBy("part")) - F.col("all"))
                            .select("part", "before"), "parts")
    inside = F.sum("ids").over(Window.partitionBy("part").orderBy("seq")) - F.col("ids")
    return folder, scratch.finish(manifest.withColumn("inside", inside).join(parts, "part")
                                  .select("part", "seq", "name", "docs", "ids",
                                          (F.col("before") + F.col("inside")).alias("start")))


def _read(uri: str):
    def run(batches):
        store, root = _files(uri)
        for batch in batches:
            for name, start in zip(batch.column("name").to_pylist(), batch.column("start").to_pylist()):
                with store.open_input_file(f"{root}/{name}") as f:
                    segment = Segment(f.read())
                ends = segment.ends.all()
                begins = np.concatenate(([0], ends[:-1]))
                wide = segment.ids.astype("<u4")
                crc = [zlib.crc32(wide[a:b]) for a, b in zip(begins.tolist(), ends.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(segment.doc_ids, mask=segment.null_ids), pa.array(start + begins), pa.array(ends - begins),
                     pa.array(crc, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])
    return run


def read_tokens(folder: str, manifest: DataFrame) -> DataFrame:
    """Per document of the files: ``doc_id, start, n_tokens, ids_crc32``.

    ``start`` counts the ids of all documents before it; the checksum is the unsigned crc32
    of the document's ids as little-endian unsigned 32-bit integers.
    """
    # a number given is not coalesced: a task reads few files, however small the manifest is
    files = manifest.select("name", "start").repartition(max(1, manifest.count()), "name")
    return files.mapInArrow(common.lean(_read(folder)), "doc_id long, start long, n_tokens long, ids_crc32 long")
