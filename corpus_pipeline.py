"""A training corpus from ``documents``: language ID, SimHash near-dedup,
benchmark decontamination, secret redaction, source mixing.

Each stage takes (spark, docs, sf_dir) and works on all its predecessor kept;
all but the last return the columns of documents. The last returns the
training order: a row for every use of a document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quotefuse.llm import decontam, langid, mixing, secret_scan, simhash_bk
from quotefuse.llm.common import read, saved


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a language (no letter, or no kernel output near any)."""
    return langid.keep_known(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays: the one with the least id."""
    return simhash_bk.keep_one(docs, size=3, radius=3)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a window of a benchmark item."""
    return decontam.clean(docs, read(spark, sf_dir, "benchmark"))


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces every secret in the texts."""
    return secret_scan.redact(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Realises the temperature-mixed source weights as block permutations."""
    return mixing.mix(docs)


STAGES = [("language", language), ("near_dedup", near_dedup), ("decontaminate", decontaminate),
          ("redact", redact), ("mix", mix)]

# the language model has no SQL form; tests hold the stages against brute-force versions
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), f"stage_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
