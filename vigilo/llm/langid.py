"""Language identification by a sparse multinomial logistic regression (operator 1).

Features are hashed character n-grams of the lower-cased text with everything but letters
read as a space, weighted by TF-IDF and scaled to unit length. Document frequencies count
every training document. The weights are fitted by follow-the-regularised-leader with
elastic-net penalties on a bounded sample, which leaves most of them at zero, and a
temperature fitted on a part of the sample kept out of training calibrates the probabilities.
There is no intercept: a text that shares no feature with the model gets equal probabilities.
"""

from __future__ import annotations

import unicodedata
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigilo.llm import common
from vigilo.llm.common import Scratch, mix64

ORDERS = (1, 2, 3)
BITS = 18
#: Training documents that are fitted, per language and in all (the bound of the sample,
#: met on average: rows are drawn by a hash).
SAMPLE, SAMPLE_ALL = 1000, 8000
MOST_LANGUAGES = 512
EPOCHS = 3
#: Follow-the-regularised-leader: step size, its offset, and the two penalties.
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.3, 0.05
UNKNOWN = "und"

_letters: np.ndarray | None = None


def _letter_table() -> np.ndarray:
    global _letters
    if _letters is None:
        _letters = np.array([unicodedata.category(chr(c))[0] == "L" for c in range(0x110000)])
    return _letters


def grams(text: str) -> np.ndarray:
    """Hashed features of every n-gram of a text; none if it has no letter."""
    chars = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letter_table()[chars]
    if not letter.any():
        return np.zeros(0, np.int64)
    keep = letter.copy()
    keep[1:] |= letter[:-1]  # one space for what stands between two words
    flat = np.where(letter, chars, 32)[keep]
    flat = np.concatenate(([32], flat) if flat[-1] == 32 else ([32], flat, [32])).astype(np.uint64)
    out, code = [], np.zeros(len(flat), np.uint64)
    for n in range(1, max(ORDERS) + 1):
        code = code[: len(flat) - n + 1] * np.uint64(0x110000) + flat[n - 1:]
        if n in ORDERS:
            out.append(mix64(code * np.uint64(8) + np.uint64(n)) >> np.uint64(64 - BITS))
    return np.concatenate(out).astype(np.int64)


class Counter:
    """Distinct features of a text and their counts, without a table per text."""

    def __init__(self):
        self.seen = np.zeros(1 << BITS, bool)
        self.place = np.zeros(1 << BITS, np.int32)

    def __call__(self, features: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        self.seen[features] = True
        at = np.flatnonzero(self.seen)
        self.seen[at] = False
        self.place[at] = np.arange(len(at))
        return at, np.bincount(self.place[features], minlength=len(at))


@dataclass
class Model:
    """Weights of the features that have any (``active`` maps a feature to its row)."""

    languages: list[str] = field(default_factory=list)
    idf: np.ndarray | None = None
    active: np.ndarray | None = None
    weights: np.ndarray | None = None
    temperature: float = 1.0

    def probabilities(self, at: np.ndarray, counts: np.ndarray) -> np.ndarray:
        x = _weigh(at, counts, self.idf)
        row = self.active[at]
        some = row >= 0
        return _softmax(x[some] @ self.weights[row[some]] / self.temperature)


def _weigh(at: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = (1 + np.log(counts)) * idf[at]
    return x / np.sqrt(x @ x)


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def held_out(doc_id: Column) -> Column:
    """Documents that are never learned from; a null id counts as an empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4 == 2


def _frequencies(batches):
    count, seen, total = np.zeros(1 << BITS, np.int64), np.zeros(1 << BITS, bool), 0
    for batch in batches:
        for text in batch.column("text").to_pylist():
            f = grams(text)
            if len(f):
                seen[f] = True
                at = np.flatnonzero(seen)
                seen[at] = False
                count[at] += 1
                total += 1
    at = np.flatnonzero(count)
    if total:
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1)), pa.array(np.append(count[at], total))],
                                         names=["feature", "documents"])


def _vectors(batches):
    counter = Counter()
    for batch in batches:
        at, counts = [], []
        for text in batch.column("text").to_pylist():
            a, c = counter(grams(text))
            at.append(a.astype(np.int32).tobytes())
            counts.append(c.astype(np.int32).tobytes())
        yield pa.RecordBatch.from_arrays([batch.column("lang"), batch.column("draw"), pa.array(at, pa.binary()),
                                          pa.array(counts, pa.binary())], names=["lang", "draw", "at", "counts"])


def fit_ftrl(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, classes: int, size: int) -> np.ndarray:
    """Follow-the-regularised-leader with per-coordinate steps; ``size x classes`` weights."""
    z, n = np.zeros((size, classes)), np.zeros((size, classes))

    def weights(at):
        zz = z[at]
        return -np.sign(zz) * np.maximum(np.abs(zz) - L1, 0) / ((BETA + np.sqrt(n[at])) / ALPHA + L2)

    for _ in range(EPOCHS):
        for (at, x), y in zip(rows, labels):
            w = weights(at)
            p = _softmax(x @ w)
            p[y] -= 1
            g = x[:, None] * p
            nn = n[at]
            step = (np.sqrt(nn + g * g) - np.sqrt(nn)) / ALPHA
            z[at] += g - step * w
            n[at] = nn + g * g
    return weights(np.arange(size))


def fit_temperature(scores: np.ndarray, labels: np.ndarray) -> float:
    """The divisor of the scores under which the labels are likeliest."""
    if not len(labels):
        return 1.0
    def loss(log_t):
        p = _softmax(scores / np.exp(log_t))
        return -np.log(np.maximum(p[np.arange(len(labels)), labels], 1e-300)).mean()
    lo, hi, golden = np.log(0.02), np.log(20.0), (5 ** 0.5 - 1) / 2
    for _ in range(40):
        a, b = hi - golden * (hi - lo), lo + golden * (hi - lo)
        lo, hi = (lo, b) if loss(a) <= loss(b) else (a, hi)
    return float(np.exp((lo + hi) / 2))


def train(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", draw: Column | None = None) -> Model:
    """A model of the labelled rows of ``docs``.

    Document frequencies count all of them; the weights see about ``SAMPLE`` rows of each
    language, drawn by the hash ``draw`` (default: of the text), and never more than twice
    ``SAMPLE_ALL`` rows: rows with equal hashes count once. Labels beyond the ``MOST_LANGUAGES``
    commonest aren't learned. Rows with a null text, label
    or no letter teach nothing; without any label the model knows no language.
    """
    spark = docs.sparkSession
    common.ship(spark)
    scratch = Scratch(spark, "langid")
    draw = draw if draw is not None else F.xxhash64(text_col)
    labelled = (docs.select(F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"),
                            F.pmod(draw, F.lit(1 << 30)).alias("draw"))
                .where("text is not null and lang is not null"))
    most_common = labelled.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(MOST_LANGUAGES)
    sizes = {r["lang"]: r["count"] for r in most_common.collect()}
    if not sizes:
        return Model()
    found = (labelled.select("text").mapInArrow(common.lean(_frequencies), "feature long, documents long")
             .groupBy("feature").agg(F.sum("documents").alias("documents")))
    found = scratch.written(found, "frequencies").toPandas()  # at most 2**BITS + 1 rows
    total = int(found.documents[found.feature == -1].sum())
    frequency = np.zeros(1 << BITS)
    frequency[found.feature[found.feature >= 0]] = found.documents[found.feature >= 0]
    idf = np.log((1 + total) / (1 + frequency)) + 1
    chosen, most = None, min(SAMPLE, SAMPLE_ALL // len(sizes) + 1)
    for lang, rows in sizes.items():
        # a share of the hash range that holds that many rows on average
        part = (F.col("lang") == lang) & (F.col("draw") < int(min(1.0, most / rows) * (1 << 30)))
        chosen = part if chosen is None else chosen | part
    drawn = common.bounded_sample(labelled.where(chosen), "draw", 2 * SAMPLE_ALL, scratch)
    sample = (drawn.mapInArrow(common.lean(_vectors), "lang string, draw long, at binary, counts binary")
              .toPandas().sort_values(["draw", "lang", "at"], ignore_index=True))
    scratch.remove(scratch.root)
    sample = sample[sample["at"].str.len() > 0]
    languages = sorted(set(sample.lang))
    if not languages:
        return Model()
    rows = [(np.frombuffer(a, np.int32), np.frombuffer(c, np.int32)) for a, c in zip(sample["at"], sample.counts)]
    rows = [(at, _weigh(at, c, idf)) for at, c in rows]
    labels = np.array([languages.index(x) for x in sample.lang])
    test = np.arange(len(rows)) % 5 == 4
    fitted = [r for r, t in zip(rows, test) if not t]
    w = fit_ftrl(fitted, labels[~test], len(languages), 1 << BITS)
    scores = np.array([x @ w[at] for (at, x), t in zip(rows, test) if t]).reshape(-1, len(languages))
    some = np.flatnonzero(np.abs(w).max(axis=1) > 0)
    active = np.full(1 << BITS, -1, np.int32)
    active[some] = np.arange(len(some))
    return Model(languages, idf.astype(np.float32), active, w[some].astype(np.float32),
                 fit_temperature(scores, labels[test]))


def predict(docs: DataFrame, model: Model, text_col: str = "text", lang: str = "lang_pred",
            score: str = "score") -> DataFrame:
    """``docs`` plus the likeliest language of the whole text and its calibrated probability.

    A null text, a text without a letter, and every text under a model without languages
    gets ``und`` and 0. Ties go to the first language by code point. Columns of ``docs`` with
    the new names are replaced; repeated rows get equal results.
    """
    spark = docs.sparkSession
    common.ship(spark)
    shared = spark.sparkContext.broadcast(model)  # at most 2**BITS rows of weights

    @F.pandas_udf(f"{lang} string, {score} double")
    def run(texts: pd.Series) -> pd.DataFrame:
        known, counter = shared.value, Counter()
        out = []
        for text in texts:
            features = grams(text) if text is not None and known.languages else ()
            if not len(features):
                out.append((UNKNOWN, 0.0))
                continue
            p = known.probabilities(*counter(features))
            best = int(p.argmax())
            out.append((known.languages[best], float(p[best])))
        common.release()
        return pd.DataFrame(out, columns=[lang, score])

    kept = [c for c in docs.columns if c.lower() not in (lang.lower(), score.lower())]
    made = common.unused(docs, "_language")
    return docs.select(*kept, run(F.col(text_col)).alias(made)).select(*kept, f"{made}.{lang}", f"{made}.{score}")


#: A document is rejected below this probability, or so many times that of a blind guess if
#: that is less (and without a letter).
LEAST_SCORE, BLIND = 0.3, 1.2


def accepted(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` in some language of the model: those with a letter whose likeliest
    language stands out from a blind guess. Short and mixed texts do, a text that shares hardly
    a feature with the model doesn't. A model of fewer than four languages can't tell and one
    without languages neither: they accept every text with a letter."""
    if not model.languages:
        return docs.where(F.coalesce(F.col("text"), F.lit("")).rlike(r"\p{L}"))
    names = common.unused(docs, "_lang"), common.unused(docs, "_score")
    least = min(LEAST_SCORE, BLIND / len(model.languages))
    found = predict(docs, model, lang=names[0], score=names[1])
    return found.where((F.col(names[0]) != UNKNOWN) & (F.col(names[1]) >= least)).select(*docs.columns)
