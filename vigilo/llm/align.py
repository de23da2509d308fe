"""Cross-tokenizer alignment by galloping intersection (operator 12).

Two tokenizers cut the same bytes: A a byte-level BPE file of the tokenizers library, B a
sentencepiece model. Each gives a rising list of token ends. Per document the shorter list
drives a search in the longer one: from the element's proportional rank in steps that double
until the end is passed, then a binary search between the last two probes. All documents of a
block gallop in lockstep. Ends found in both lists cut the tokens into groups; the ranks
found say which tokens of the other list each token overlaps.

Corpus-wide counts of linked id pairs are added up per batch before they are shuffled. Pairs
that hold at least one link in ``2 ** SHARE_BITS`` of all (no more such pairs can exist) are
broadcast; links of rarer pairs, none of them hot, meet their count in a join.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigilo.llm import common, tokens
from vigilo.llm.common import Scratch

#: At most ``2 ** SHARE_BITS`` pairs are broadcast: those with that share of the links or more.
SHARE_BITS = 20
#: Distinct pairs a task counts before it hands them on.
MOST_PAIRS = 1 << 20

#: Text bytes aligned at a time; a longer text is a block of its own.
BLOCK_BYTES = 1 << 19

_NEWLINE, _BLANK = 10, 32


def gallop(values: np.ndarray, lo: np.ndarray, hi: np.ndarray, wanted: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Per element of ``wanted`` the first index in ``lo:hi`` of the rising ``values`` that is
    not below it (``hi`` if none): doubling steps from ``at`` on, then a binary search."""
    below = values[at] < wanted
    under = np.where(below, at, lo - 1)      # known to be below
    over = np.where(below, hi, at)           # known not to be
    left, step = np.arange(len(wanted)), 1
    while len(left):
        up = below[left]
        probe = np.where(up, at[left] + step, at[left] - step)
        inside = (probe >= lo[left]) & (probe < hi[left])
        left, probe, up = left[inside], probe[inside], up[inside]
        less = values[probe] < wanted[left]
        under[left[less]] = probe[less]
        over[left[~less]] = probe[~less]
        left = left[less == up]
        step *= 2
    left = np.flatnonzero(over - under > 1)
    while len(left):
        middle = (under[left] + over[left]) // 2
        less = values[middle] < wanted[left]
        under[left[less]] = middle[less]
        over[left[~less]] = middle[~less]
        left = left[over[left] - under[left] > 1]
    return over


def ranks(short: np.ndarray, short_at: np.ndarray, long: np.ndarray, long_at: np.ndarray,
          docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For the elements of ``short`` in the given documents: their indices, and the index of
    the first end in the same document of ``long`` that is not below each."""
    n, m = np.diff(short_at)[docs], np.diff(long_at)[docs]
    index = _runs(short_at[docs], n)
    lo, hi = np.repeat(long_at[docs], n), np.repeat(long_at[docs] + m, n)
    place = index - np.repeat(short_at[docs], n)
    guess = lo + place * np.repeat(m, n) // np.maximum(np.repeat(n, n), 1)
    return index, gallop(long, lo, hi, short[index], np.minimum(guess, hi - 1))


def common_ends(a: np.ndarray, a_at: np.ndarray, b: np.ndarray, b_at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indices of the ends that both lists of a document hold, by document and place.

    Document ``d`` has the rising ends ``a[a_at[d]:a_at[d + 1]]`` and the same of ``b``."""
    n, m = np.diff(a_at), np.diff(b_at)
    some = (n > 0) & (m > 0)
    ia, rb = ranks(a, a_at, b, b_at, np.flatnonzero(some & (n <= m)))
    ib, ra = ranks(b, b_at, a, a_at, np.flatnonzero(some & (n > m)))
    # an element past the other list's last end has no partner
    hit = rb < len(b)
    hit[hit] = b[rb[hit]] == a[ia[hit]]
    back = ra < len(a)
    back[back] = a[ra[back]] == b[ib[back]]
    ia, ib = np.concatenate((ia[hit], ra[back])), np.concatenate((rb[hit], ib[back]))
    order = np.argsort(ia, kind="stable")
    return ia[order], ib[order]


def overlaps(a: np.ndarray, a_at: np.ndarray, b: np.ndarray, b_at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per token of ``a`` the first and last token of ``b`` (places in the document) whose
    bytes it shares; both lists cover the same bytes of each document."""
    docs = np.flatnonzero(np.diff(a_at) > 0)
    index, last = ranks(a, a_at, b, b_at, docs)
    first = np.empty(len(index), np.int64)
    first[1:] = last[:-1] + (b[last[:-1]] == a[index[:-1]])    # past the one that ends where this begins
    heads = np.cumsum(np.diff(a_at)[docs]) - np.diff(a_at)[docs]
    first[heads] = b_at[docs]
    base = np.repeat(b_at[docs], np.diff(a_at)[docs])
    return first - base, last - base


def _runs(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The numbers ``begin[i], begin[i] + 1, ...`` (``size[i]`` of them) one run after the other."""
    upto = np.cumsum(size)
    return np.repeat(begin - (upto - size), size) + np.arange(int(upto[-1]) if len(upto) else 0)


# ------------------------------------------------------------------ the two tokenizers

class _Ids:
    def __init__(self, ids):
        self.ids = ids


class _Pieces:
    """A sentencepiece model behind the calls that the encoder makes.

    The model adds a blank to what it is given. A whole text has it already and is given
    without; a part of a text is given after a line feed, which no piece holds and nothing
    merges with, and the ids of that blank and line feed are left out."""

    def __init__(self, model, whole: bool):
        self.model, self.whole = model, whole

    def encode_batch_fast(self, texts, add_special_tokens=False):
        inner = [t[1:] if self.whole else "\n" + t for t in texts]
        return [_Ids(ids if self.whole else ids[2:]) for ids in self.model.encode(inner, num_threads=1)]


class PieceEncoder(tokens.Encoder):
    """A sentencepiece BPE model whose pieces have blanks at their front only: merges never
    cross into a word, so texts are cut before runs of blanks and around line feeds, and each
    distinct cut is encoded once per worker. Texts are given with the blank in front that the
    model adds. A model with other pieces encodes texts whole."""

    def __init__(self, path: str):
        import sentencepiece
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.added, self.spaced, self.never_plain = [], True, False
        self.kinds = np.zeros(tokens._PLAIN + 1, np.uint8)
        self.lower = None
        pieces = [self.model.id_to_piece(i) for i in range(self.model.vocab_size())]
        # fixed value: the mark that stands for a blank in pieces
        self.whole = any("▁" in p.lstrip("▁") or "\n" in p for p in pieces)
        self.tokenizer = _Pieces(self.model, self.whole)
        self._forget()

    def _cut(self, chars: np.ndarray, kind: np.ndarray, bound: np.ndarray) -> np.ndarray:
        start = np.zeros(len(chars) + 1, bool)
        start[bound] = True
        start = start[:len(chars)]
        if self.whole:
            return np.flatnonzero(start)
        blank, line = chars == _BLANK, chars == _NEWLINE
        start |= line
        start[1:] |= line[:-1] | (blank[1:] & ~blank[:-1])
        return np.flatnonzero(start)

    def token_bytes(self) -> list[bytes]:
        out = []
        for i in range(self.model.vocab_size()):
            piece = self.model.id_to_piece(i)
            out.append(bytes([int(piece[3:5], 16)]) if self.model.is_byte(i) else piece.replace("▁", " ").encode())
        return out


class ByteEncoder(tokens.Encoder):
    """A byte-level BPE file; strings of its special tokens in texts are plain text."""

    def __init__(self, path: str):
        super().__init__(path, spaced=True)
        self.tokenizer.encode_special_tokens = True
        self.added, self.never_plain = [], False

    def token_bytes(self) -> list[bytes]:
        # the byte-level alphabet: printable bytes stand for themselves, the others for the
        # characters from 256 on, in byte order
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        byte = {chr(b): b for b in printable}
        byte |= {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in set(printable))}
        out = [b""] * self.tokenizer.get_vocab_size()
        for entry, i in self.tokenizer.get_vocab().items():
            out[i] = bytes(byte[c] for c in entry) if all(c in byte for c in entry) else entry.encode()
        return out


class Side:
    """One tokenizer with its tables by id: bytes, their lengths, decimal digits."""

    def __init__(self, encoder):
        self.encoder = encoder
        known = encoder.token_bytes()
        self.size = np.array([len(x) for x in known], np.int64)
        self.begin = np.cumsum(self.size) - self.size
        self.flat = np.frombuffer(b"".join(known), np.uint8)
        names = [str(i).encode() for i in range(len(known))]
        self.digits = np.array([len(x) for x in names], np.int64)
        # eight bytes an id, handled as one number: up to seven digits and the mark after them
        self.names = np.frombuffer(b"".join(x.ljust(8) for x in names), np.uint64)

    def spell(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of the tokens one after the other."""
        return self.flat[_runs(self.begin[ids], self.size[ids])]


_sides: dict[str, Side] = {}


def _side(path: str) -> Side:
    if path not in _sides:
        _sides[path] = Side(PieceEncoder(path) if path.endswith(".model") else ByteEncoder(path))
    return _sides[path]


class Block:
    """Aligned tokens of the rows ``lo:hi`` of a batch; rows without tokens have none."""

    def __init__(self, lo, hi, a, a_at, a_ends, b, b_at, b_ends):
        self.lo, self.hi = lo, hi
        self.a, self.a_at, self.a_ends, self.b, self.b_at, self.b_ends = a, a_at, a_ends, b, b_at, b_ends
        self.ia, self.ib = common_ends(a_ends, a_at, b_ends, b_at)
        #: groups of row r: ``group_at[r]:group_at[r + 1]``
        self.group_at = np.searchsorted(self.ia, a_at)


def blocks(texts: pa.Array, first: Side, second: Side) -> Iterator[Block]:
    """Both tokenizers over a blank and each text, aligned; a block at a time is held."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    upto = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    lo = 0
    while lo < len(texts):
        before = int(upto[lo - 1]) if lo else 0
        hi = max(lo + 1, int(np.searchsorted(upto, before + BLOCK_BYTES, "right")))
        yield _block(texts.slice(lo, hi - lo), lo, first, second)
        lo = hi


def _block(texts: pa.Array, start: int, first: Side, second: Side) -> Block:
    given = pc.fill_null(texts.cast(pa.large_string()), "")
    good = np.asarray(pc.greater(pc.binary_length(given), 0).to_numpy(zero_copy_only=False)).copy()
    blank, nothing = (pa.scalar(x, pa.large_string()) for x in (" ", ""))
    spaced = pc.binary_join_element_wise(blank, given, nothing)
    (_, _, buf, offsets), = common.text_chunks(spaced, 1 << 62)
    size = np.diff(offsets)
    made = [side.encoder._chunk(buf, offsets) for side in (first, second)]
    for side, (ids, at) in zip((first, second), made):
        good &= np.diff(np.concatenate(([0], np.cumsum(side.size[ids])))[at]) == size
    for side, (ids, at) in zip((first, second), made):
        wrong = np.flatnonzero(side.spell(ids[np.repeat(good, np.diff(at))]) != buf[np.repeat(good, size)])
        good[np.searchsorted(np.cumsum(np.where(good, size, 0)), wrong, "right")] = False
    parts = []
    for side, (ids, at) in zip((first, second), made):
        kept = ids[np.repeat(good, np.diff(at))].astype(np.int64)
        parts += [kept, np.concatenate(([0], np.cumsum(np.where(good, np.diff(at), 0)))), np.cumsum(side.size[kept])]
    return Block(start, start + len(texts), *parts)


def spelled_groups(block: Block, first: Side, second: Side) -> list[bytes]:
    """Per row ``a1,a2|b1;a3|b2,b3``: the decimal ids of its groups."""
    n, m = len(block.a), len(block.b)
    a_cut, b_cut = block.ia + 1, block.ib + 1
    # a token stands after the tokens before it and those of the other side in earlier groups
    group_a, group_b = _ended_before(block.ia, n), _ended_before(block.ib, m)
    at_a = np.arange(n) + np.concatenate(([0], b_cut))[group_a]
    at_b = np.arange(m) + a_cut[group_b]
    mark_a = np.full(n, ord(","), np.uint8)
    mark_b = np.full(m, ord(","), np.uint8)
    mark_a[block.ia], mark_b[block.ib] = ord("|"), ord(";")
    names, length = np.empty(n + m, np.uint64), np.empty(n + m, np.int64)
    for side, ids, at in ((first, block.a, at_a), (second, block.b, at_b)):
        names[at], length[at] = side.names[ids], side.digits[ids]
    cells = names.view(np.uint8).reshape(-1, 8)
    cells[at_a, length[at_a]], cells[at_b, length[at_b]] = mark_a, mark_b
    flat = cells[np.arange(8) <= length[:, None]].tobytes()
    ends = np.concatenate(([0], np.cumsum(length + 1)))[block.a_at + block.b_at].tolist()
    return [flat[x: max(y - 1, x)] for x, y in zip(ends, ends[1:])]


def _ended_before(ends: np.ndarray, n: int) -> np.ndarray:
    """Per number below ``n`` how many of the rising ``ends`` are less."""
    mark = np.zeros(n + 1, np.int64)
    mark[ends + 1] = 1
    return np.cumsum(mark)[:n]


def _narrow(ids: np.ndarray, at: np.ndarray, vocabulary: int) -> pa.Array:
    """Ids of each row as bytes, two an id where the vocabulary allows it."""
    wide = 2 if vocabulary <= 1 << 16 else 4
    raw = pa.py_buffer(np.ascontiguousarray(ids.astype(f"<u{wide}")))
    return pa.Array.from_buffers(pa.large_binary(), len(at) - 1, [None, pa.py_buffer((at * wide).astype(np.int64)), raw]).cast(pa.binary())


def _lists(flat: np.ndarray, at: np.ndarray, kind=pa.int32()) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(flat, kind))


def _full(path_a: str, path_b: str):
    def run(batches):
        first, second = _side(path_a), _side(path_b)
        for batch in batches:
            for x in blocks(batch.column("text"), first, second):
                lead, last = overlaps(x.a_ends, x.a_at, x.b_ends, x.b_at)
                groups = np.diff(x.group_at)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(x.lo, x.hi - x.lo), _lists(x.a, x.a_at), _lists(x.b, x.b_at),
                     _lists(x.ia + 1 - np.repeat(x.a_at[:-1], groups), x.group_at),
                     _lists(x.ib + 1 - np.repeat(x.b_at[:-1], groups), x.group_at),
                     _lists(lead, x.a_at), _lists(last, x.a_at)],
                    names=["doc_id", "a_ids", "b_ids", "a_cuts", "b_cuts", "first_overlap", "last_overlap"])
    return run


def align(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: the ids of both tokenizers over a blank and the text, how many tokens of each
    lie up to every common end (``a_cuts``, ``b_cuts``), and for every A token the first and
    last B token (places in ``b_ids``) that it overlaps.

    ``path_a`` is a byte-level BPE file, ``path_b`` a sentencepiece model. Null and empty
    texts, and texts that either tokenizer doesn't give back byte for byte, have empty lists.
    Repeated rows get equal rows, other columns are ignored, an empty table gives an empty
    result. A text is aligned whole, whatever its length.
    """
    common.ship(docs.sparkSession)
    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
            .mapInArrow(common.lean(_full(path_a, path_b)),
                        "doc_id long, a_ids array<int>, b_ids array<int>, a_cuts array<int>, b_cuts array<int>, "
                        "first_overlap array<int>, last_overlap array<int>"))


# ------------------------------------------------------------------ corpus-wide counts

def _pair(a, b):
    return (a << 32) | b


def _digest(path_a: str, path_b: str):
    def run(batches):
        first, second = _side(path_a), _side(path_b)
        for batch in batches:
            for x in blocks(batch.column("text"), first, second):
                texts = spelled_groups(x, first, second)
                many = np.diff(x.a_at) > 0
                sha = [hashlib.sha256(t).hexdigest() if some else "" for t, some in zip(texts, many)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(x.lo, x.hi - x.lo), pa.array(np.diff(x.a_at)), pa.array(np.diff(x.b_at)),
                     pa.array(np.diff(x.group_at)), pa.array(sha, pa.string()),
                     _narrow(x.a[x.ia], x.group_at, len(first.size)), _narrow(x.b[x.ib], x.group_at, len(second.size))],
                    names=["doc_id", "n_a", "n_b", "n_groups", "groups_sha256", "link_a", "link_b"])
    return run


def _links(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Row number and pair of each link of a batch."""
    many = batch.column("n_groups").to_numpy()
    total = int(many.sum())
    ids = []
    for name in ("link_a", "link_b"):
        column = batch.column(name)
        _, offsets, data = column.buffers()
        at = np.frombuffer(offsets, np.int32)[column.offset: column.offset + len(column) + 1]
        raw = np.frombuffer(data, np.uint8)[at[0]: at[-1]] if total else np.zeros(0, np.uint8)
        ids.append(raw.view(f"<u{len(raw) // total if total else 2}").astype(np.int64))
    return np.repeat(np.arange(len(batch)), many), _pair(*ids)


def _counts(batches):
    held, many = {}, 0
    keys, sums = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def out():
        return pa.RecordBatch.from_arrays([pa.array(keys), pa.array(sums)], names=["pair", "links"])

    for batch in batches:
        pair, links = np.unique(_links(batch)[1], return_counts=True)
        every, at = np.unique(np.concatenate((keys, pair)), return_inverse=True)
        total = np.zeros(len(every), np.int64)
        np.add.at(total, at, np.concatenate((sums, links)))
        keys, sums = every, total
        if len(keys) >= MOST_PAIRS:
            yield out()
            keys, sums = np.zeros(0, np.int64), np.zeros(0, np.int64)
    if len(keys):
        yield out()


def _known(shared):
    """Per row what its links of broadcast pairs add up to."""
    def run(batches):
        pairs, counts, best = shared.value
        for batch in batches:
            row, pair = _links(batch)
            at = _find(pairs, pair)
            row, at = row[at >= 0], at[at >= 0]
            n_best, total = (np.zeros(len(batch), np.int64) for _ in range(2))
            np.add.at(n_best, row, best[at].astype(np.int64))
            np.add.at(total, row, counts[at])
            yield pa.RecordBatch.from_arrays(
                [batch.column("rid"), pa.array(n_best), pa.array(total)], names=["rid", "n_best", "count_sum"])
    return run


def _rare(shared):
    """Links of the other pairs, those of a row and pair as one."""
    def run(batches):
        pairs = shared.value[0]
        for batch in batches:
            row, pair = _links(batch)
            rest = _find(pairs, pair) < 0
            row, pair = row[rest], pair[rest]
            order = np.lexsort((pair, row))
            row, pair = row[order], pair[order]
            head = np.flatnonzero(np.append(True, (row[1:] != row[:-1]) | (pair[1:] != pair[:-1]))[:len(row)])
            yield pa.RecordBatch.from_arrays(
                [batch.column("rid").take(pa.array(row[head])), pa.array(pair[head]),
                 pa.array(np.diff(np.append(head, len(row))))], names=["rid", "pair", "times"])
    return run


def _find(sorted_pairs: np.ndarray, pair: np.ndarray) -> np.ndarray:
    if not len(sorted_pairs):
        return np.full(len(pair), -1)
    at = np.minimum(np.searchsorted(sorted_pairs, pair), len(sorted_pairs) - 1)
    return np.where(sorted_pairs[at] == pair, at, -1)


def link_counts(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text",
                share_bits: int = SHARE_BITS) -> DataFrame:
    """Per row: ``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256``.

    A link is a pair of an A and a B token of one text that end at the same byte; the count of
    an id pair is the number of such links in all rows (repeated rows count each). ``n_best``
    are the row's links whose count is the highest of their B id, ties included, ``count_sum``
    adds up the counts of the row's links. Rows without tokens (see :func:`align`) have zeros
    and an empty ``groups_sha256``. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    common.ship(spark)
    scratch = Scratch(spark, "align")
    rows = scratch.written(
        docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
        .mapInArrow(common.lean(_digest(path_a, path_b)),
                    "doc_id long, n_a long, n_b long, n_groups long, groups_sha256 string, "
                    "link_a binary, link_b binary")
        .withColumn("rid", F.monotonically_increasing_id()), "rows")
    links = rows.select("rid", "n_groups", "link_a", "link_b")
    b_id = F.col("pair").bitwiseAND(F.lit((1 << 32) - 1))
    counted = scratch.written(links.mapInArrow(common.lean(_counts), "pair long, links long")
                              .groupBy("pair").agg(F.sum("links").alias("links")), "pairs")
    # at most one row per id of B's vocabulary
    highest = scratch.written(counted.groupBy(b_id.alias("b")).agg(F.max("links").alias("highest")), "highest")
    pairs = scratch.written(counted.join(F.broadcast(highest), b_id == F.col("b"))
                            .select("pair", "links", (F.col("links") == F.col("highest")).alias("best")), "best")
    total = counted.agg(F.sum("links")).first()[0] or 0
    common_pairs = (F.col("links").cast("decimal(38,0)") * F.lit(1 << share_bits)) >= F.lit(total).cast("decimal(38,0)")
    frequent = pairs.where(common_pairs).toPandas().sort_values("pair")   # at most 2**share_bits rows
    shared = spark.sparkContext.broadcast((frequent.pair.to_numpy(np.int64), frequent.links.to_numpy(np.int64),
                                           frequent.best.to_numpy(bool)))
    rare = (links.mapInArrow(common.lean(_rare(shared)), "rid long, pair long, times long")
            .join(pairs.where(~common_pairs), "pair")
            .select("rid", F.when(F.col("best"), F.col("times")).otherwise(0).alias("n_best"),
                    (F.col("times") * F.col("links")).alias("count_sum")))
    known = links.mapInArrow(common.lean(_known(shared)), "rid long, n_best long, count_sum long")
    sums = known.unionByName(rare).groupBy("rid").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    out = rows.join(sums, "rid").select("doc_id", "n_a", "n_b", "n_groups", F.col("n_groups").alias("n_links"),
                                        "n_best", "count_sum", "groups_sha256")
    return scratch.finish(out)
