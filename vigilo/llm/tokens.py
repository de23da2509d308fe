"""Encoding with a public tokenizer file, each distinct piece of text once per worker.

A byte-level BPE never merges across the pieces its pre-tokenizer cuts, so a text's ids are
its pieces' ids one after the other. Texts of plain characters (ASCII and Latin letters) are
cut for a whole batch with array operations, and pieces not met before are encoded by the
tokenizers library; any other text, and any that holds an added token of the file
(``<|endoftext|>``), goes to the library whole.
"""

from __future__ import annotations

import os
import unicodedata

import numpy as np
import pyarrow as pa

from vigilo.llm.common import mix64, powers, text_chunks

#: Text bytes cut at a time, and pieces remembered by a worker.
CHUNK_BYTES = 2 << 20
MOST_PIECES = 1 << 19

_SPACE, _LETTER, _NUMBER, _OTHER, _ODD = range(5)
_PLAIN = 0x250
_APOSTROPHE = 39


def _classes() -> np.ndarray:
    """Kind of each plain character; control characters and unusual spaces are odd."""
    out = np.full(_PLAIN + 1, _ODD, np.uint8)
    for c in range(32, _PLAIN):
        kind = unicodedata.category(chr(c))
        out[c] = {"L": _LETTER, "N": _NUMBER, "P": _OTHER, "S": _OTHER}.get(kind[0], _ODD)
    out[[32, 9, 10, 13]] = _SPACE
    return out


def _lower() -> np.ndarray:
    """Lower case of each plain character; 0 where that isn't one plain character."""
    low = [chr(c).lower() for c in range(_PLAIN + 1)]
    return np.array([ord(x) if len(x) == 1 and ord(x) < _PLAIN else 0 for x in low], np.uint32)


class Encoder:
    """``spaced`` cuts like GPT-2's pattern (a space belongs to the piece after it); else
    spaces and case are dropped and each digit is a piece."""

    def __init__(self, path: str, spaced: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        added = list(self.tokenizer.get_added_tokens_decoder().values())
        self.added = [x.content.encode() if spaced else x.content.encode().lower() for x in added]
        # added tokens that a search of the bytes could miss: every text goes to the library
        self.never_plain = any(x.normalized or not x.content.isascii() for x in added)
        self.spaced = spaced
        self.kinds = _classes()
        self.lower = _lower()
        if not spaced:
            self.kinds[:_PLAIN][self.lower[:_PLAIN] == 0] = _ODD
        self._forget()

    def _forget(self) -> None:
        self.bits = 16
        self.keys = np.zeros(1 << self.bits, np.uint64)
        self.at = np.zeros(1 << self.bits, np.int32)
        self.begin = np.zeros(1 << 15, np.int64)
        self.size = np.zeros(1 << 15, np.int32)
        self.pool = np.zeros(1 << 16, np.uint32)
        self.pieces = self.used = 0

    def encode(self, column: pa.Array):
        """Yields ``(first row, end row, ids, row offsets)`` for the rows of a string column."""
        for lo, hi, buf, offsets in text_chunks(column, CHUNK_BYTES):
            yield lo, hi, *self._chunk(buf, offsets)

    def _chunk(self, buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        raw = buf.tobytes()
        chars = np.frombuffer(raw.decode("utf-8").encode("utf-32-le"), np.uint32)
        heads = np.concatenate(([0], np.cumsum((buf & 0xC0) != 0x80)))
        bound = heads[offsets]
        kind = self.kinds[np.minimum(chars, _PLAIN)]
        odd = np.flatnonzero(kind == _ODD)
        rows = len(offsets) - 1
        strange = np.unique(np.searchsorted(bound, odd, "right") - 1) if len(odd) else odd
        if self.never_plain:
            strange = np.arange(rows)
        elif marked := self._added_at(raw):
            strange = np.union1d(strange, np.searchsorted(offsets, marked, "right") - 1)
        if len(strange):
            plain = np.ones(rows, bool)
            plain[strange] = False
            keep = np.repeat(plain, np.diff(bound))
            kept_bound = np.concatenate(([0], np.cumsum(np.where(plain, np.diff(bound), 0))))
            ids, at = self._plain(chars[keep], kind[keep], kept_bound)
            texts = [raw[offsets[r]: offsets[r + 1]].decode("utf-8") for r in strange]
            whole = [np.array(self.tokenizer.encode(t, add_special_tokens=False).ids, np.uint32) for t in texts]
            parts = [ids[at[r]: at[r + 1]] for r in range(rows)]
            for r, x in zip(strange, whole):
                parts[r] = x
            return np.concatenate(parts), np.concatenate(([0], np.cumsum([len(x) for x in parts])))
        return self._plain(chars, kind, bound)

    def _added_at(self, raw: bytes) -> list[int]:
        """Where strings of added tokens begin, in any case if case is dropped; the library
        decides what they are."""
        if not self.spaced:
            raw = raw.lower()
        out = []
        for content in self.added:
            at = raw.find(content)
            while at >= 0:
                out.append(at)
                at = raw.find(content, at + 1)
        return out

    def _plain(self, chars: np.ndarray, kind: np.ndarray, bound: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = len(chars)
        if not n:
            return np.zeros(0, np.uint32), np.zeros(len(bound), np.int64)
        if not self.spaced:
            chars = self.lower[chars]
        begin = self._cut(chars, kind, bound)
        size = np.diff(np.append(begin, n))
        if not self.spaced:
            words = kind[begin] != _SPACE
            begin, size = begin[words], size[words]
        if not len(begin):
            return np.zeros(0, np.uint32), np.zeros(len(bound), np.int64)
        place = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
        flat = chars if self.spaced else chars[np.repeat(begin, size) + place]
        part = (flat.astype(np.uint64) + np.uint64(1)) * powers(int(size.max()))[place]
        hashes = mix64(np.add.reduceat(part, np.cumsum(size) - size) + size.astype(np.uint64)) | np.uint64(1)
        found = self._look(hashes)
        if (found < 0).any():
            self._learn(hashes, found, chars, begin, size)
            found = self._look(hashes)
        many = self.size[found].astype(np.int64)
        upto = np.cumsum(many)
        ids = self.pool[np.repeat(self.begin[found] - (upto - many), many) + np.arange(int(upto[-1]))]
        row_at = np.searchsorted(begin, bound)
        return ids, np.concatenate(([0], upto))[row_at]

    def _cut(self, chars: np.ndarray, kind: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """Where the pieces begin."""
        n = len(chars)
        head = np.zeros(n + 1, bool)
        head[bound] = True
        head = head[:n]
        prev = np.empty(n, np.uint8)
        prev[0], prev[1:] = _ODD, kind[:-1]
        prev[head] = _ODD
        start = kind != prev
        space = kind == _SPACE
        if not self.spaced:
            start |= kind == _NUMBER
        else:
            last = space.copy()  # the last space of a run that something follows
            last[:-1] &= ~space[1:] & ~head[1:]
            last[-1] = False
            start |= last
            joined = np.zeros(n, bool)
            joined[1:] = last[:-1] & (chars[:-1] == 32)
            start &= ~joined
        marks = np.flatnonzero((chars == _APOSTROPHE) & start)
        if len(marks):
            one = np.append(chars, [0, 0])
            edge = np.append(head, [True, True])
            a, b = one[marks + 1], one[marks + 2]
            a = np.where(edge[marks + 1], 0, a)
            b = np.where(edge[marks + 1] | edge[marks + 2], 0, b)
            short = np.isin(a, [ord(c) for c in "stmd"])
            long = np.zeros(len(marks), bool)
            for x, y in ("re", "ve", "ll"):
                long |= (a == ord(x)) & (b == ord(y))
            start[marks[short | long] + 1] = False
            ends = np.concatenate((marks[short] + 2, marks[long] + 3))
            start[ends[ends < n]] = True
            if self.spaced:  # a space after it still takes what follows
                after = ends[ends < n]
                start[after] = True
        return np.flatnonzero(start)

    def _look(self, hashes: np.ndarray) -> np.ndarray:
        """Number of each remembered piece, -1 for the others."""
        mask = np.uint64(len(self.keys) - 1)
        at = (hashes >> np.uint64(20)) & mask
        out = np.full(len(hashes), -1, np.int64)
        left = np.arange(len(hashes))
        while len(left):
            slot = at[left]
            key = self.keys[slot]
            hit = key == hashes[left]
            out[left[hit]] = self.at[slot[hit]]
            left = left[~hit & (key != 0)]
            at[left] = (at[left] + np.uint64(1)) & mask
        return out

    def _store(self, hashes: np.ndarray, numbers: np.ndarray) -> None:
        mask = np.uint64(len(self.keys) - 1)
        at = (hashes >> np.uint64(20)) & mask
        left = np.arange(len(hashes))
        while len(left):
            slot = at[left]
            free = self.keys[slot] == 0
            _, first = np.unique(slot[free], return_index=True)
            win = left[free][first]
            self.keys[at[win]] = hashes[win]
            self.at[at[win]] = numbers[win]
            left = left[self.keys[at[left]] != hashes[left]]
            busy = self.keys[at[left]] != 0
            at[left[busy]] = (at[left[busy]] + np.uint64(1)) & mask

    def _learn(self, hashes, found, chars, begin, size) -> None:
        new, first = np.unique(hashes[found < 0], return_index=True)
        at = np.flatnonzero(found < 0)[first]
        if self.pieces + len(new) > MOST_PIECES and self.pieces:
            self._forget()
            return self._learn(hashes, np.full(len(hashes), -1), chars, begin, size)
        raw = chars.astype(np.uint32).tobytes()
        texts = [raw[4 * b: 4 * (b + s)].decode("utf-32-le") for b, s in zip(begin[at].tolist(), size[at].tolist())]
        ids = [x.ids for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        many = np.array([len(x) for x in ids], np.int32)
        flat = np.fromiter((i for x in ids for i in x), np.uint32, int(many.sum()))
        p, u = self.pieces, self.used
        self.begin = _room(self.begin, p + len(new))
        self.size = _room(self.size, p + len(new))
        self.pool = _room(self.pool, u + len(flat))
        self.begin[p: p + len(new)] = u + np.cumsum(many) - many
        self.size[p: p + len(new)] = many
        self.pool[u: u + len(flat)] = flat
        self.pieces, self.used = p + len(new), u + len(flat)
        if 2 * self.pieces > len(self.keys):
            full = self.keys != 0
            keys, numbers = self.keys[full], self.at[full]
            while 2 * self.pieces > 1 << self.bits:
                self.bits += 1
            self.keys = np.zeros(1 << self.bits, np.uint64)
            self.at = np.zeros(1 << self.bits, np.int32)
            self._store(keys, numbers)
        self._store(new, np.arange(p, p + len(new), dtype=np.int32))


def _room(a: np.ndarray, n: int) -> np.ndarray:
    if len(a) >= n:
        return a
    return np.concatenate((a, np.zeros(max(n, 2 * len(a)) - len(a), a.dtype)))


_encoders: dict[tuple[str, bool], Encoder] = {}


def encoder(path: str, spaced: bool) -> Encoder:
    """The worker's encoder of a tokenizer file."""
    key = path, spaced
    if key not in _encoders:
        _encoders[key] = Encoder(path, spaced)
    return _encoders[key]


def tokenizer_path(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)
