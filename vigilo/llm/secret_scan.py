"""Secret scans by a linear-chain conditional random field (operator 3).

Texts are cut into words, runs of symbols and equal signs. The field tags each token as the
begin of a secret, inside of one or outside, from the token's shape, the words around it and
features of the whole text, and Viterbi decoding finds the best tags. It learns from the
spans of three fixed patterns in a bounded sample of documents; what it finds besides the
patterns' spans is added to them.

Everything but Viterbi's recursion runs on arrays of a whole chunk of texts. A token whose
lead for "outside" exceeds what any transitions can gain is outside on every best path, so
the recursion only runs over the tokens between such ones; its result is the exact one.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigilo.llm import common
from vigilo.llm.common import Scratch, mix64, powers, text_chunks

# The patterns of the base spans and their order.
KINDS = ("assign", "access", "hex", "crf")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
ASSIGN_LEAST, ACCESS_LEAST, HEX_LEAST = 6, 20, 24
_CUES = ("password", "passwd", "secret", "token", "apikey", "api_key")

OUT, BEGIN, IN = range(3)
#: Documents fitted with and without a cue (the bound of the sample, met on average), and
#: windows of tokens taken from one.
SAMPLE, WINDOWS, SPAN = 800, 6, 24
#: Words around secrets that the field tells apart.
WORDS = 256
EPOCHS, RATE, DECAY = 80, 0.5, 1e-3

_WORD, _EQUAL, _SPACE, _SYMBOL = range(4)
_tables = None


def _char_tables():
    """Per code point: its class, and whether it is a digit, upper, lower, hexadecimal."""
    global _tables
    if _tables is None:
        kind = np.full(0x110000, _SYMBOL, np.uint8)
        kind[[c for c in range(0x110000) if unicodedata.category(chr(c))[0] in "LNM"]] = _WORD
        kind[[c for c in range(0x3100) if chr(c).isspace()]] = _SPACE
        kind[[ord(c) for c in "_+/.-"]] = _WORD
        kind[ord("=")] = _EQUAL
        code = np.zeros(0x110000, np.uint8)  # bits: digit, upper, lower, hexadecimal
        for bit, letters in enumerate(("0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz",
                                       "0123456789abcdef")):
            code[[ord(c) for c in letters]] |= 1 << bit
        _tables = kind, code
    return _tables


@dataclass
class Tokens:
    """Tokens of a chunk: first and last code point, row, shape, randomness, word hash."""

    begin: np.ndarray
    end: np.ndarray
    row: np.ndarray
    shape: np.ndarray
    noise: np.ndarray
    word: np.ndarray


SHAPES, NOISES, FILES = 16 * 12 + 2, 5 * 6 * 2, 4
_STEPS = np.array([2, 3, 5, 8, 12, 16, 20, 24, 32, 48, 64])


def tokenize(chars: np.ndarray, bound: np.ndarray) -> Tokens:
    kinds, codes = _char_tables()
    kind, code = kinds[chars], codes[chars]
    start = np.empty(len(chars), bool)
    start[:1] = True
    start[1:] = kind[1:] != kind[:-1]
    start[bound[bound < len(chars)]] = True
    begin = np.flatnonzero(start)
    end = np.append(begin[1:], len(chars))
    change = np.zeros(len(chars), np.int32)
    change[1:] = (code[1:] & 7) != (code[:-1] & 7)
    change[begin] = 0
    total = lambda x: np.add.reduceat(x.astype(np.int32), begin)
    digit, upper, lower, hexa = (total(code >> b & 1) for b in range(4))
    changes = total(change)
    size = end - begin
    low = np.where((chars >= 65) & (chars <= 90), chars + 32, chars).astype(np.uint64) + np.uint64(1)
    place = np.arange(len(chars)) - np.repeat(begin, size)
    word = mix64(np.add.reduceat(low * powers(int(size.max()))[place], begin) + size.astype(np.uint64))
    keep = kind[begin] != _SPACE
    begin, end, size, word = begin[keep], end[keep], size[keep], word[keep]
    digit, upper, lower, hexa, changes = digit[keep], upper[keep], lower[keep], hexa[keep], changes[keep]
    other = size - digit - upper - lower
    bits = (digit > 0) + 2 * (upper > 0) + 4 * (lower > 0) + 8 * (other > 0)
    shape = bits * 12 + np.searchsorted(_STEPS, size, "right")
    first = kind[begin]
    shape = np.where(first == _EQUAL, 16 * 12, np.where(first == _SYMBOL, 16 * 12 + 1, shape))
    share = np.searchsorted([0.01, 0.25, 0.5, 0.999], digit / size)
    noise = (share * 6 + np.searchsorted([1, 2, 4, 8, 16], changes, "right")) * 2 + (hexa == size)
    return Tokens(begin, end, np.searchsorted(bound, begin, "right") - 1, shape, noise, word)


def _file_kind(tokens: Tokens, rows: int) -> np.ndarray:
    """A feature of each whole text: its share of symbols, four steps."""
    symbols = np.bincount(tokens.row, tokens.shape >= 16 * 12, rows)
    every = np.maximum(np.bincount(tokens.row, minlength=rows), 1)
    return np.searchsorted([0.02, 0.1, 0.3], symbols / every)


def base_spans(text: str) -> list[tuple[int, int, int, int]]:
    """``(start, kind, end, start of the secret itself)`` of the fixed patterns' spans, in order."""
    out = []
    low = text.lower()
    if any(c in low for c in _CUES):
        out += [(m.start(), 0, m.end(), m.start(2)) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end(), m.start()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LEAST]
    return out


def _hex_runs(chars: np.ndarray, bound: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, start and end (in the row) of the runs of at least ``HEX_LEAST`` hexadecimal digits."""
    code = _char_tables()[1]
    on = (code[chars] >> 3 & 1).astype(bool)
    edge = np.zeros(len(chars) + 1, bool)
    edge[1:-1] = on[1:] != on[:-1]
    edge[bound] = True
    edge[0] = edge[-1] = True
    at = np.flatnonzero(edge)
    a, b = at[:-1], at[1:]
    long = (b - a >= HEX_LEAST)
    a, b = a[long], b[long]
    a, b = a[on[a]], b[on[a]]
    row = np.searchsorted(bound, a, "right") - 1
    return row, a - bound[row], b - bound[row]


def _chunks(column: pa.Array):
    """Chunks as ``(first row, texts, code points, row bounds, base spans per row)``."""
    for lo, hi, buf, offsets in text_chunks(column):
        raw = buf.tobytes()
        chars = np.frombuffer(raw.decode("utf-8").encode("utf-32-le"), np.uint32)
        bound = np.concatenate(([0], np.cumsum((buf & 0xC0) != 0x80)))[offsets]
        texts = [raw[offsets[r]: offsets[r + 1]].decode("utf-8") for r in range(hi - lo)]
        spans = [base_spans(t) for t in texts]
        if len(chars):
            for row, a, b in zip(*(x.tolist() for x in _hex_runs(chars, bound))):
                spans[row].append((a, 2, b, a))
        yield lo, texts, chars, bound, [sorted(s) for s in spans]


@dataclass
class Field:
    """The field's weights as tables of scores per tag (``None``: nothing learned)."""

    words: np.ndarray
    tables: dict[str, np.ndarray]
    turns: np.ndarray

    def number(self, word: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.words, word)
        at[at == len(self.words)] = 0
        return np.where(self.words[at] == word, at + 1, 0) if len(self.words) else np.zeros(len(word), np.int64)


def _features(shape, noise, word, file) -> dict[str, np.ndarray]:
    """Feature numbers by table; arrays end in the token axis, beyond its ends stands 0."""
    def moved(x, by):
        out = np.zeros_like(x)
        if by > 0:
            out[..., by:] = x[..., :-by]
        else:
            out[..., :by] = x[..., -by:]
        return out
    return {"shape": shape, "noise": noise, "word": word, "before": moved(word, 1), "before2": moved(word, 2),
            "after": moved(word, -1), "shape_before": moved(shape + 1, 1), "shape_after": moved(shape + 1, -1),
            "file": file}


def _table_sizes() -> dict[str, int]:
    return {"shape": SHAPES, "noise": NOISES, "word": WORDS + 1, "before": WORDS + 1, "before2": WORDS + 1,
            "after": WORDS + 1, "shape_before": SHAPES + 1, "shape_after": SHAPES + 1, "file": FILES}


def _labels(tokens: Tokens, bound: np.ndarray, spans: list) -> np.ndarray:
    out = np.zeros(len(tokens.begin), np.int8)
    for row, own in enumerate(spans):
        for _, _, end, value in own:
            a = int(np.searchsorted(tokens.end, bound[row] + value, "right"))
            b = int(np.searchsorted(tokens.begin, bound[row] + end))
            if a < b and not out[a:b].any():
                out[a], out[a + 1: b] = BEGIN, IN
    return out


def _windows(batches):
    """Windows of tokens around base spans and at places drawn by the text's hash."""
    for batch in batches:
        out = []
        for _, texts, chars, bound, spans in _chunks(batch.column("text")):
            if not len(chars):
                continue
            tokens = tokenize(chars, bound)
            labels, files = _labels(tokens, bound, spans), _file_kind(tokens, len(texts))
            first = np.searchsorted(tokens.row, np.arange(len(texts) + 1))
            for row, text in enumerate(texts):
                a, b = int(first[row]), int(first[row + 1])
                if a == b:
                    continue
                random = np.random.Generator(np.random.PCG64(int.from_bytes(hashlib.sha256(text.encode()).digest()[:8])))
                starts = a + np.flatnonzero(labels[a:b] == BEGIN)[: WINDOWS - 2]
                middles = [int(x) for x in starts] + [int(x) for x in random.integers(a, b, 2)]
                for m in middles:
                    lo = max(a, min(m - SPAN // 2, b - SPAN))
                    part = slice(lo, min(lo + SPAN, b))
                    out.append((tokens.shape[part].astype(np.int32).tobytes(), tokens.noise[part].astype(np.int32).tobytes(),
                                tokens.word[part].tobytes(), labels[part].tobytes(), int(files[row])))
        cols = list(zip(*out)) if out else [()] * 5
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in cols[:4]] + [pa.array(cols[4], pa.int32())],
                                         names=["shape", "noise", "word", "label", "file"])


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def fit(windows: pd.DataFrame) -> Field | None:
    """The field with the likeliest labels (gradient steps with per-weight rates)."""
    if not len(windows) or not any(BEGIN in x for x in windows.label):
        return None
    n = len(windows)
    size = np.array([len(x) for x in windows.label])
    here = np.arange(SPAN) < size[:, None]

    def grid(name, dtype):
        out = np.zeros((n, SPAN), dtype)
        out[here] = np.frombuffer(b"".join(windows[name]), dtype)
        return out
    shape, noise = grid("shape", np.int32), grid("noise", np.int32)
    word, label = grid("word", np.uint64), grid("label", np.int8)
    near = np.zeros((n, SPAN), bool)
    for by in (-2, -1, 0, 1, 2):
        near |= np.roll(label == BEGIN, by, axis=1)
    # words met most often around secrets, not the secrets themselves
    found, counts = np.unique(word[near & here & (label == OUT)], return_counts=True)
    words = np.sort(found[np.lexsort((found, -counts))][:WORDS][counts[np.lexsort((found, -counts))][:WORDS] > 1])
    field = Field(words, {}, np.zeros((3, 3)))
    file = np.repeat(windows.file.to_numpy()[:, None], SPAN, axis=1)
    features = _features(shape, noise, field.number(word.ravel()).reshape(word.shape), file)
    tables = {k: np.zeros((v, 3)) for k, v in _table_sizes().items()}
    turns = np.zeros((3, 3))
    squares = {k: np.full_like(v, 1e-8) for k, v in tables.items()} | {"turns": np.full((3, 3), 1e-8)}
    want = np.eye(3)[label] * here[:, :, None]
    pair_want = np.einsum("nti,ntj->ij", want[:, :-1], want[:, 1:])
    for _ in range(EPOCHS):
        e = sum(tables[k][f] for k, f in features.items()) * here[:, :, None]
        step = np.where(here[:, 1:, None, None], turns, np.where(np.eye(3, dtype=bool), 0.0, -1e9))
        fore, back = np.zeros((n, SPAN, 3)), np.zeros((n, SPAN, 3))
        fore[:, 0] = e[:, 0]
        for t in range(1, SPAN):
            fore[:, t] = e[:, t] + _logsum(fore[:, t - 1, :, None] + step[:, t - 1], 1)
        for t in range(SPAN - 2, -1, -1):
            back[:, t] = _logsum(step[:, t] + (e[:, t + 1] + back[:, t + 1])[:, None, :], 2)
        norm = _logsum(fore[:, -1], 1)
        got = np.exp(fore + back - norm[:, None, None]) * here[:, :, None]
        pairs = np.exp(fore[:, :-1, :, None] + step + (e + back)[:, 1:, None, :] - norm[:, None, None, None])
        pairs = (pairs * here[:, 1:, None, None]).sum(axis=(0, 1))
        slope = (want - got).reshape(-1, 3)
        for k, f in features.items():
            g = np.stack([np.bincount(f.ravel(), slope[:, c], len(tables[k])) for c in range(3)], axis=1) - DECAY * n * tables[k] / 100
            squares[k] += g * g
            tables[k] += RATE * g / np.sqrt(squares[k])
        g = pair_want - pairs - DECAY * n * turns / 100
        squares["turns"] += g * g
        turns += RATE * g / np.sqrt(squares["turns"])
    return Field(words, tables, turns)


def viterbi(scores: np.ndarray, turns: np.ndarray) -> np.ndarray:
    """Tags of the best path; a path begins and ends next to tokens outside."""
    n = len(scores)
    best = scores[0] + turns[OUT]
    back = np.zeros((n, 3), np.int64)
    for t in range(1, n):
        step = best[:, None] + turns
        back[t] = step.argmax(axis=0)
        best = step.max(axis=0) + scores[t]
    tags = np.zeros(n, np.int64)
    tags[-1] = int((best + turns[:, OUT]).argmax())
    for t in range(n - 1, 0, -1):
        tags[t - 1] = back[t, tags[t]]
    return tags


def decode(tokens: Tokens, rows: int, field: Field) -> np.ndarray:
    """The tags of a chunk's tokens."""
    tags = np.zeros(len(tokens.begin), np.int64)
    if not len(tags):
        return tags
    scores = np.zeros((len(tags), 3))
    word, edge = field.number(tokens.word), tokens.row
    files = _file_kind(tokens, rows)[tokens.row]
    for name, f in _features(tokens.shape, tokens.noise, word, files).items():
        if name in ("before", "shape_before"):
            f[1:][edge[1:] != edge[:-1]] = 0
        elif name == "before2":
            f[2:][edge[2:] != edge[:-2]] = 0
        elif name in ("after", "shape_after"):
            f[:-1][edge[1:] != edge[:-1]] = 0
        scores += field.tables[name][f]
    gain = 2 * (field.turns.max() - field.turns.min())
    open_ = np.flatnonzero(scores[:, OUT] - scores[:, 1:].max(axis=1) <= gain)
    if not len(open_):
        return tags
    cuts = np.flatnonzero((np.diff(open_) > 1) | (edge[open_[1:]] != edge[open_[:-1]])) + 1
    for run in np.split(open_, cuts):
        tags[run] = viterbi(scores[run], field.turns)
    return tags


def _find(field: Field | None):
    """Per text all spans: base spans, and the field's that lie in none of them."""
    def run(column: pa.Array):
        for lo, texts, chars, bound, spans in _chunks(column):
            if field is not None and len(chars):
                tokens = tokenize(chars, bound)
                tags = decode(tokens, len(texts), field)
                starts = np.flatnonzero((tags == BEGIN) | ((tags == IN) & (np.append(OUT, tags[:-1]) == OUT)))
                for s in starts.tolist():
                    e = s + 1
                    while e < len(tags) and tags[e] == IN and tokens.row[e] == tokens.row[s]:
                        e += 1
                    row = int(tokens.row[s])
                    a, b = int(tokens.begin[s] - bound[row]), int(tokens.end[e - 1] - bound[row])
                    if not any(x[0] <= a and b <= x[2] for x in spans[row] if x[1] != 3):
                        spans[row].append((a, 3, b, a))
            for r, own in enumerate(spans):
                yield lo + r, texts[r], sorted(own)
    return run


def _text_of(spans) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b, _ in spans)


def train(docs: DataFrame, text_col: str = "text", draw=None) -> Field | None:
    """A field fitted to the base spans of a sample of ``docs``: about ``SAMPLE`` documents
    with a cue of a secret and as many without, drawn by the hash ``draw``, twice that at most
    (rows with equal hashes count once), and of a long document ``WINDOWS`` windows of ``SPAN``
    tokens. Without any base
    span in it there is nothing to learn, and the result is None."""
    common.ship(docs.sparkSession)
    text = F.col(text_col)
    low = F.lower(text)
    cue = F.contains(text, F.lit("AKIA"))
    for c in _CUES:
        cue = cue | F.contains(low, F.lit(c))
    drawn = docs.where(text.isNotNull()).select(text.alias("text"), cue.alias("cue"), F.pmod(
        draw if draw is not None else F.xxhash64(text), F.lit(1 << 30)).alias("draw"))
    sizes = {r["cue"]: r["count"] for r in drawn.groupBy("cue").count().collect()}
    most = F.lit(0)
    for on in (True, False):
        part = int(min(1.0, SAMPLE / max(sizes.get(on, 0), 1)) * (1 << 30))
        most = F.when(F.col("cue") == on, F.lit(part)).otherwise(most)
    scratch = Scratch(docs.sparkSession, "secrets")
    sample = common.bounded_sample(drawn.where(F.col("draw") < most), "draw", 4 * SAMPLE, scratch)
    windows = (sample.select("text").mapInArrow(common.lean(_windows), "shape binary, noise binary, word binary, label binary, file int")
               .toPandas().sort_values(["word", "shape", "noise", "label", "file"], ignore_index=True))
    scratch.remove(scratch.root)
    return fit(windows)


def scan(docs: DataFrame, field: Field | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_assign, n_access, n_hex, n_crf, base_sha256, spans``.

    Spans are ``kind:start:end`` in code points, ordered by start and then by kind; base spans
    are those of the fixed patterns. Null and empty texts have none; repeated rows get equal
    rows; other columns are ignored; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    common.ship(spark)
    shared = spark.sparkContext.broadcast(field)  # tables of fixed size

    def run(batches):
        find = _find(shared.value)
        for batch in batches:
            found = [own for _, _, own in find(batch.column("text"))]
            count = lambda k: pa.array([sum(x[1] == k for x in own) for own in found], pa.int64())
            base = [_text_of(x for x in own if x[1] != 3) for own in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), count(0), count(1), count(2), count(3),
                 pa.array([hashlib.sha256(b.encode()).hexdigest() for b in base], pa.string()),
                 pa.array([_text_of(own) for own in found], pa.string())],
                names=["doc_id", "n_assign", "n_access", "n_hex", "n_crf", "base_sha256", "spans"])

    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
            .mapInArrow(common.lean(run), "doc_id long, n_assign long, n_access long, n_hex long, n_crf long, base_sha256 string, "
                             "spans string"))


MASK = "[SECRET]"
#: Texts that are masked at a time.
SLICE = 512


def mask(text: str, spans) -> str:
    """``text`` with each secret (of an assignment: the value) replaced by ``MASK``."""
    out, at = [], 0
    for a, b in sorted((value, end) for _, _, end, value in spans):
        if b <= at:
            continue
        if a >= at:
            out += [text[at:a], MASK]
        at = b
    return "".join(out) + text[at:]


def masked(docs: DataFrame, field: Field | None, text_col: str = "text", chars_col: str = "n_chars") -> DataFrame:
    """``docs`` with the secrets of its texts masked and ``chars_col``, if there, counted again
    for the texts changed; all rows and columns stay, null texts stay null."""
    spark = docs.sparkSession
    common.ship(spark)
    shared = spark.sparkContext.broadcast(field)

    @F.arrow_udf("string")
    def clean(texts: pa.Array) -> pa.Array:
        parts, find = [pa.array([], pa.string())], _find(shared.value)
        for lo in range(0, len(texts), SLICE):      # few texts at a time are Python strings
            column = texts.slice(lo, SLICE).cast(pa.string())
            found = [mask(text, own) if own else text for _, text, own in find(column)]
            parts.append(pc.if_else(pc.is_valid(column), pa.array(found, pa.string()), pa.scalar(None, pa.string())))
        common.release()
        return pa.concat_arrays(parts)

    new = common.unused(docs, "_masked")
    done = docs.withColumn(new, clean(text_col))
    if chars_col in docs.columns:
        count = F.when(F.col(new) != F.col(text_col), F.length(new)).otherwise(F.col(chars_col))
        done = done.withColumn(chars_col, count.cast(docs.schema[chars_col].dataType))
    return done.withColumn(text_col, F.col(new)).select(*docs.columns)
