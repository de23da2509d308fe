"""Corpus pipeline: ``documents`` through the stages below, each written and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigilo.llm import langid, mixing, near_dedup, packing, secret_scan, tokens
from vigilo.llm.common import Scratch, documents


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are in no language known from the labelled ones go."""
    model = langid.train(docs.select("text", "lang", "doc_id"), draw=F.xxhash64("doc_id", "text"))
    return langid.accepted(docs, model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays: the one with the least id (null last),
    then the least text hash. Words shingled by five, a similarity of 0.8 or more."""
    return near_dedup.keep_one(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in the texts are masked; every document stays."""
    return secret_scan.masked(docs, secret_scan.train(docs, draw=F.xxhash64("doc_id", "text")))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.mixed(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences, with their ids."""
    return packing.pack(docs, tokens.tokenizer_path("word_bpe_49k.json"), with_ids=True)


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("secrets", secrets),
    ("mix", mix),
    ("pack", pack),
]

#: No SQL: the stages train models, hash and tokenise; tests hold them against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    scratch = Scratch(spark, "pipeline")
    for name, stage in STAGES:
        docs = scratch.written(stage(spark, docs, sf_dir), name)
    return docs
