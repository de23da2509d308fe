"""Quality classifier from weak labels (operator 8).

Overlapping heuristic labellers each call a text good or bad or abstain. Expectation
maximisation over the counts of all vote patterns estimates how accurate each labeller is,
without any true label, and gives every pattern a posterior. The posteriors of a bounded
sample train a linear scorer over hashed words and word shapes, which scores every text.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigilo.llm import common
from vigilo.llm.common import Scratch, mix64, powers, text_chunks, word_hashes

BAD, GOOD, NONE = 0, 1, 2
#: Documents whose posteriors train the scorer (the bound of the sample, met on average).
SAMPLE = 6000
BITS = 16
EM_ROUNDS, EPOCHS, RATE, DECAY = 60, 4, 0.5, 1e-5
LEAST_SCORE = 0.5

#: The labellers: a measure of the text, what it is at most (or at least) in a good one and
#: from (or up to) where a text is bad; between the two the labeller abstains.
LABELLERS = (
    ("symbols", 0.06, 0.10),       # symbols a byte
    ("marked words", 0.10, 0.30),  # words ending in two symbols or more
    ("capitals", 0.15, 0.40),      # capitals a letter
    ("repeats", 0.02, 0.06),       # words equal to the word before
    ("commonest", 0.10, 0.20),     # share of the commonest word
    ("bars", 0.02, 0.10),          # words that are a symbol alone
    ("digits", 0.10, 0.25),        # digits a byte
    ("long words", 0.60, 0.75),    # words of more than four bytes
    ("word length", 7.0, 9.5),     # bytes a word
)

_KIND = np.zeros(256, np.uint8)
_KIND[33:128] = np.arange(33, 128)
for _a, _b, _as in ((48, 58, 48), (65, 91, 65), (97, 123, 97)):
    _KIND[_a:_b] = _as
_KIND[128:] = 97
_SPACES = np.zeros(256, bool)
_SPACES[list(common.SPACES)] = True


@dataclass
class Words:
    """Words of a chunk: hash, shape hash, and the measures of each row."""

    first: np.ndarray
    word: np.ndarray
    shape: np.ndarray
    measures: np.ndarray


def look(buf: np.ndarray, offsets: np.ndarray) -> Words:
    word, first = word_hashes(buf, offsets)
    rows = len(offsets) - 1
    if not len(word):
        return Words(first, word, word, np.zeros((rows, len(LABELLERS))))
    at = np.flatnonzero(~_SPACES[buf])
    start = np.empty(len(at), bool)
    start[0], start[1:] = True, at[1:] != at[:-1] + 1
    heads = np.searchsorted(at, offsets[:-1])
    start[heads[heads < len(at)]] = True
    begin = np.flatnonzero(start)
    size = np.diff(np.append(begin, len(at)))
    kind = _KIND[buf[at]]
    # a word's shape: its kinds of characters with runs of one kind taken once
    turn = start.copy()
    turn[1:] |= kind[1:] != kind[:-1]
    run = np.flatnonzero(turn)
    run_start = np.flatnonzero(start[run])
    run_size = np.diff(np.append(run_start, len(run)))
    place = np.arange(len(run)) - np.repeat(run_start, run_size)
    shape = mix64(np.add.reduceat((kind[run].astype(np.uint64) + np.uint64(1)) * powers(int(run_size.max()))[place], run_start))
    symbol = ~np.isin(kind, (48, 65, 97))
    end = np.append(begin[1:], len(at)) - 1
    row = np.searchsorted(first, np.arange(len(word)), "right") - 1
    same = np.zeros(len(word), bool)
    same[1:] = (word[1:] == word[:-1]) & (row[1:] == row[:-1])
    of = lambda x: np.bincount(row, x, rows)
    _, one, times = np.unique(word + row.astype(np.uint64) * np.uint64(0xD1B54A32D192ED03), return_index=True,
                              return_counts=True)
    commonest = np.zeros(rows)
    np.maximum.at(commonest, row[one], times)
    per = lambda x: np.add.reduceat(x.astype(np.int64), begin)
    # a few odd words of a short text say little: shares are of 20 words or 100 bytes at least
    words, length = np.maximum(of(np.ones(len(word))), 20), np.maximum(of(size), 100)
    capital, small = per(kind == 65), per(kind == 97)
    marked = symbol[end] & (size > 1) & symbol[np.maximum(end - 1, 0)]
    measures = np.stack([of(per(symbol)) / length, of(marked) / words, of(capital) / np.maximum(of(capital + small), 80),
                         of(same) / words, commonest / words, of(per(symbol) == size) / words, of(per(kind == 48)) / length,
                         of(size > 4) / words, of(size) / words], axis=1)
    return Words(first, word, shape, measures)


def vote(measures: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Votes of the labellers (columns) on the rows; a text without words gets none."""
    good = np.array([x[1] for x in LABELLERS])
    bad = np.array([x[2] for x in LABELLERS])
    out = np.where(measures <= good, GOOD, np.where(measures >= bad, BAD, NONE))
    return np.where(words[:, None] > 0, out, NONE)


def _code(votes: np.ndarray) -> np.ndarray:
    return votes @ 3 ** np.arange(votes.shape[1])


def patterns(codes: np.ndarray) -> np.ndarray:
    return codes[:, None] // 3 ** np.arange(len(LABELLERS)) % 3


@dataclass
class Labels:
    """What expectation maximisation found: share of good texts, vote chances by labeller,
    class and vote, and the posterior of "good" for every vote pattern."""

    prior: float
    chances: np.ndarray
    posterior: np.ndarray

    def accuracies(self) -> np.ndarray:
        """Share of right calls among a labeller's calls."""
        right = self.chances[:, GOOD, GOOD] * self.prior + self.chances[:, BAD, BAD] * (1 - self.prior)
        wrong = self.chances[:, GOOD, BAD] * self.prior + self.chances[:, BAD, GOOD] * (1 - self.prior)
        return right / np.maximum(right + wrong, 1e-12)


def estimate(codes: np.ndarray, counts: np.ndarray) -> Labels:
    """Expectation maximisation over vote patterns and how many texts have them."""
    votes = patterns(codes)
    # at first every bad call counts against a text: a good one sets off few labellers,
    # a bad one has no reason to set off the most of them
    q = np.where((votes == NONE).all(axis=1), 0.5, 0.95 * 0.4 ** (votes == BAD).sum(axis=1))
    onehot = np.eye(3)[votes]
    prior, chances = 0.5, np.full((len(LABELLERS), 2, 3), 1 / 3)
    for _ in range(EM_ROUNDS):
        weight = np.stack([counts * (1 - q), counts * q])
        chances = np.einsum("cp,plv->lcv", weight, onehot) + 0.1
        chances /= chances.sum(axis=2, keepdims=True)
        prior = float((weight[1].sum() + 1) / (weight.sum() + 2))
        q = _posterior(votes, prior, chances)
    every = patterns(np.arange(3 ** len(LABELLERS)))
    return Labels(prior, chances, _posterior(every, prior, chances))


def _posterior(votes: np.ndarray, prior: float, chances: np.ndarray) -> np.ndarray:
    log = np.log(chances)
    each = np.arange(votes.shape[1])
    bad = np.log(1 - prior) + log[each, BAD, votes].sum(axis=1)
    good = np.log(prior) + log[each, GOOD, votes].sum(axis=1)
    return 1 / (1 + np.exp(np.clip(bad - good, -700, 700)))


def _vector(word: np.ndarray, shape: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features of a text and their values; words and shapes each of unit length."""
    parts = []
    for k, x in enumerate((word, shape)):
        at, n = np.unique((x >> np.uint64(64 - BITS)).astype(np.int64) + (k << BITS), return_counts=True)
        value = 1 + np.log(n) if k == 0 else n.astype(float)
        parts.append((at, value / np.sqrt(value @ value)))
    return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])


def _codes(batches):
    for batch in batches:
        out = []
        for _, _, buf, offsets in text_chunks(batch.column("text")):
            w = look(buf, offsets)
            out.append(_code(vote(w.measures, np.diff(w.first))))
        codes, counts = np.unique(np.concatenate(out), return_counts=True) if out else (np.zeros(0, np.int64),) * 2
        yield pa.RecordBatch.from_arrays([pa.array(codes), pa.array(counts)], names=["code", "texts"])


def _examples(batches):
    for batch in batches:
        rows = []
        for _, _, buf, offsets in text_chunks(batch.column("text")):
            w = look(buf, offsets)
            codes = _code(vote(w.measures, np.diff(w.first)))
            for r in range(len(offsets) - 1):
                a, b = w.first[r], w.first[r + 1]
                if a < b:
                    at, x = _vector(w.word[a:b], w.shape[a:b])
                    rows.append((int(codes[r]), at.astype(np.int32).tobytes(), x.astype(np.float32).tobytes()))
        cols = list(zip(*rows)) if rows else [()] * 3
        yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.binary()),
                                          pa.array(cols[2], pa.binary())], names=["code", "at", "x"])


@dataclass
class Scorer:
    labels: Labels
    weights: np.ndarray
    bias: float

    def score(self, at: np.ndarray, x: np.ndarray) -> float:
        return float(1 / (1 + np.exp(-(x @ self.weights[at] + self.bias))))


def train(docs: DataFrame, text_col: str = "text", draw: Column | None = None) -> Scorer | None:
    """The scorer of ``docs``: vote patterns are counted over all texts, the linear scorer is
    fitted to about ``SAMPLE`` of them (twice that at most; rows with equal hashes count once),
    drawn by the hash ``draw`` (default: of the text).
    None if no text has a word."""
    common.ship(docs.sparkSession)
    texts = docs.select(F.col(text_col).alias("text"),
                        F.pmod(draw if draw is not None else F.xxhash64(text_col), F.lit(1 << 30)).alias("draw"))
    found = (texts.select("text").mapInArrow(common.lean(_codes), "code long, texts long")
             .groupBy("code").agg(F.sum("texts").alias("texts")).toPandas().sort_values("code"))  # at most 3**9 rows
    total = int(found.texts.sum())
    if not total:
        return None
    labels = estimate(found.code.to_numpy(), found.texts.to_numpy(float))
    part = int(min(1.0, SAMPLE / total) * (1 << 30))
    scratch = Scratch(docs.sparkSession, "quality")
    drawn = common.bounded_sample(texts.where(F.col("draw") < part), "draw", 2 * SAMPLE, scratch)
    sample = (drawn.select("text").mapInArrow(common.lean(_examples), "code long, at binary, x binary").toPandas()
              .sort_values(["code", "at", "x"], ignore_index=True))
    scratch.remove(scratch.root)
    if not len(sample):
        return None
    rows = [(np.frombuffer(a, np.int32), np.frombuffer(x, np.float32).astype(float)) for a, x in zip(sample["at"], sample.x)]
    aim = labels.posterior[sample.code.to_numpy()]
    w, squares = np.zeros(2 << BITS), np.full(2 << BITS, 1e-6)
    bias, bias_squares = 0.0, 1e-6
    for epoch in range(EPOCHS):
        for i in np.random.Generator(np.random.PCG64(epoch)).permutation(len(rows)):
            at, x = rows[i]
            slip = 1 / (1 + np.exp(-(x @ w[at] + bias))) - aim[i]
            g = slip * x + DECAY * w[at]
            squares[at] += g * g
            w[at] -= RATE * g / np.sqrt(squares[at])
            bias_squares += slip * slip
            bias -= RATE * slip / np.sqrt(bias_squares)
    return Scorer(labels, w.astype(np.float32), bias)


def score(docs: DataFrame, scorer: Scorer | None, text_col: str = "text") -> DataFrame:
    """``docs`` plus ``votes`` (one of B, G and - for each labeller), ``posterior`` (of good,
    from the votes), ``score`` (of the linear scorer) and ``kept`` (score at least 0.5).

    Null and blank texts, and all texts without a scorer, get no votes, posterior and score 0
    and aren't kept. Repeated rows get equal results; columns of ``docs`` with the new names
    are replaced.
    """
    spark = docs.sparkSession
    common.ship(spark)
    shared = spark.sparkContext.broadcast(scorer)  # 2 * 2**BITS weights and 3**9 posteriors

    @F.pandas_udf("votes string, posterior double, score double")
    def run(texts: pd.Series) -> pd.DataFrame:
        known, out = shared.value, []
        for _, _, buf, offsets in text_chunks(pa.array(texts, pa.string(), from_pandas=True)):
            w = look(buf, offsets)
            votes = vote(w.measures, np.diff(w.first))
            codes = _code(votes)
            for r in range(len(offsets) - 1):
                a, b = w.first[r], w.first[r + 1]
                if a == b or known is None:
                    out.append(("-" * len(LABELLERS), 0.0, 0.0))
                else:
                    out.append(("".join("BG-"[v] for v in votes[r]), float(known.labels.posterior[codes[r]]),
                                known.score(*_vector(w.word[a:b], w.shape[a:b]))))
        common.release()
        return pd.DataFrame(out, columns=["votes", "posterior", "score"])

    made = ("votes", "posterior", "score", "kept")
    kept = [c for c in docs.columns if c.lower() not in made]
    name = common.unused(docs, "_quality")
    return (docs.select(*kept, run(F.col(text_col)).alias(name)).select(*kept, f"{name}.*")
            .withColumn("kept", F.col("score") >= LEAST_SCORE))
