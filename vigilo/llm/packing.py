"""Hierarchical packing of documents into sequences of several lengths (operator 9).

Each document goes to the tier of the least window that holds it; a document longer than the
longest window first fills windows of its own. Tiers are packed from the longest: a document
opens a window of its tier, and the gap behind it takes the longest documents of the shorter
tiers that fit, then the head of one that doesn't. What is left at a task's end is cut at
powers of two, which need no padding. Windows of one tier form step groups of equal tokens.

Packing needs no shuffle: a task packs the texts of its own splits.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right, insort

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigilo.llm import common, tokens

TIERS = (512, 1024, 2048, 4096)
#: Tokens of a step group: as many windows of a tier as that holds.
STEP_TOKENS = 65_536
#: Waiting tokens at which a task packs what it has.
HELD_TOKENS = 1 << 21


class Packer:
    """Packs pieces ``(document, start, ids)``; a sequence is a list of pieces and a window."""

    def __init__(self, tiers: tuple[int, ...] = TIERS):
        self.tiers = tiers
        self.waiting: list[list[tuple[int, int, int]]] = [[] for _ in tiers]  # (length, start, document), sorted
        self.held = 0

    def add(self, document: int, length: int, start: int = 0) -> list[list[tuple[int, int, int]]]:
        """Takes a document; returns the windows it fills alone."""
        longest = self.tiers[-1]
        out = [[(longest, start + k * longest, document)] for k in range(length // longest)]
        rest = length % longest
        if rest:
            self._wait((rest, start + length - rest, document))
        return out

    def _wait(self, piece: tuple[int, int, int]) -> None:
        tier = next(k for k, size in enumerate(self.tiers) if piece[0] <= size)
        insort(self.waiting[tier], piece)
        self.held += piece[0]

    def _take(self, tier: int, at: int) -> tuple[int, int, int]:
        piece = self.waiting[tier].pop(at)
        self.held -= piece[0]
        return piece

    def _fill(self, tier: int, gap: int) -> tuple[int, int, int] | None:
        """A piece of at most ``gap`` tokens from ``tier`` or below: whole if one fits."""
        for k in range(tier, -1, -1):
            at = bisect_right(self.waiting[k], (gap, 1 << 62, 1 << 62)) - 1
            if at >= 0:
                return self._take(k, at)
        for k in range(tier + 1):
            if self.waiting[k]:
                length, start, document = self._take(k, 0)
                self._wait((length - gap, start + gap, document))
                return gap, start, document
        return None

    def windows(self):
        """Full windows ``(tier, pieces)`` while the waiting pieces suffice for one."""
        for tier in range(len(self.tiers) - 1, -1, -1):
            while self.waiting[tier] and self.enough(tier):
                yield tier, self._window(tier)

    def enough(self, tier: int) -> bool:
        """Whether pieces of this tier and below fill a window of it."""
        need = self.tiers[tier]
        for k in range(tier, -1, -1):
            for length, _, _ in reversed(self.waiting[k]):
                need -= length
                if need <= 0:
                    return True
        return False

    def _window(self, tier: int) -> list[tuple[int, int, int]]:
        pieces = [self._take(tier, len(self.waiting[tier]) - 1)]
        gap = self.tiers[tier] - pieces[0][0]
        below = max(tier - 1, 0)
        while gap:
            piece = self._fill(below, gap) or self._fill(tier, gap)
            pieces.append(piece)
            gap -= piece[0]
        return pieces

    def rest(self):
        """What is left at the end: windows of tiers while they are full, then powers of two."""
        size = self.tiers[-1]
        while self.held:
            while size > self.held:
                size //= 2
            pieces, gap = [], size
            while gap:
                piece = self._fill(len(self.tiers) - 1, gap)
                pieces.append(piece)
                gap -= piece[0]
            yield size, pieces


_SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
           "window int, step_group long")


def _pack(path: str, spaced: bool, end_id: int, with_ids: bool):
    names = [x.split()[0] for x in _SCHEMA.split(", ")] + ["ids"] * with_ids

    def run(batches):
        encoder = tokens.encoder(path, spaced)
        base = TaskContext.get().partitionId() << 36
        packer = Packer()
        texts: dict[int, tuple] = {}  # document number: its id, ids and ids not yet written
        counts: dict[int, int] = {}
        sequences = 0
        rows: list[tuple] = []

        def emit(window: int, pieces) -> None:
            nonlocal sequences
            n = counts[window] = counts.get(window, 0) + 1
            group = base + ((n - 1) * window // STEP_TOKENS) * 16 + window.bit_length()
            offset = 0
            for length, start, document in pieces:
                doc_id, ids, left = texts[document]
                part = ids[start: start + length]
                rows.append((doc_id, start, length, zlib.crc32(part), len(ids), base + sequences, offset, window, group)
                            + ((part,) if with_ids else ()))
                offset += length
                if left == length:
                    del texts[document]
                else:
                    texts[document] = doc_id, ids, left - length
            sequences += 1

        def flush():
            columns = list(zip(*rows)) if rows else [()] * len(names)
            rows.clear()
            types = [pa.int64()] * 7 + [pa.int32(), pa.int64()]
            arrays = [pa.array(c, t) for c, t in zip(columns, types)]
            if with_ids:
                lengths = [len(x) for x in columns[-1]]
                flat = np.concatenate(columns[-1]).astype(np.int32) if lengths else np.zeros(0, np.int32)
                arrays.append(pa.ListArray.from_arrays(np.concatenate(([0], np.cumsum(lengths))).astype(np.int32), flat))
            return pa.RecordBatch.from_arrays(arrays, names=names)

        number = 0
        last = np.array([end_id], np.uint32)
        for batch in batches:
            keys = batch.column("doc_id").to_pylist()
            for lo, hi, ids, at in encoder.encode(batch.column("text")):
                for r in range(lo, hi):
                    own = np.concatenate((ids[at[r - lo]: at[r - lo + 1]], last))
                    texts[number] = keys[r], own, len(own)
                    for pieces in packer.add(number, len(own)):
                        emit(packer.tiers[-1], pieces)
                    number += 1
                if packer.held >= HELD_TOKENS:
                    for tier, pieces in packer.windows():
                        emit(packer.tiers[tier], pieces)
                if rows:
                    yield flush()
        for tier, pieces in packer.windows():
            emit(packer.tiers[tier], pieces)
        for window, pieces in packer.rest():
            emit(window, pieces)
        if rows:
            yield flush()
    return run


def pack(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", spaced: bool = False,
         end_id: int = 2, with_ids: bool = False) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset,
    window, step_group`` and, ``with_ids``, the piece's ids.

    A document is its text's ids and ``end_id``; a null or empty text is ``end_id`` alone.
    Every id lies in exactly one piece. A sequence is as long as its window, which is a power
    of two of at most 4096, so none needs padding. Repeated rows are documents of their own,
    null ids stay null, other columns are ignored, an empty table gives an empty result.
    Sequences of a ``step_group`` have one window and together ``STEP_TOKENS`` tokens (the
    last group of a task has fewer).
    """
    common.ship(docs.sparkSession)
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return slim.mapInArrow(common.lean(_pack(tokenizer, spaced, end_id, with_ids)), _SCHEMA + ", ids array<int>" * with_ids)
