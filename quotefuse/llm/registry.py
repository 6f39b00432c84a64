"""Queries of this package: one per operator, over its whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quotefuse.llm import (
    collocations, decontam, importance, langid, license_scan, mixing, order_minhash, quality_knn, secret_scan,
    sentence_spans, simhash_bk, suffix_array, url_automaton)
from quotefuse.llm.common import read
from quotefuse.llm.oracle import ORACLE

__all__ = ["ORACLE", "QUERIES"]


def op1_quality_knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_knn.classify(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op2_sentence_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return sentence_spans.dedup(docs, sentences=2, words=16, whole=True)


def op3_simhash_bk_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_bk.near_duplicates(read(spark, sf_dir, "documents"), size=3, radius=3)


def op4_prefix_containment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.decontaminate(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op5_trigram_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.report(read(spark, sf_dir, "documents"))


def op6_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_array.digest(read(spark, sf_dir, "documents"), length=200)


def op7_language_kernel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(read(spark, sf_dir, "documents"))


def op8_temperature_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read(spark, sf_dir, "documents"))


def op9_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_minhash.report(read(spark, sf_dir, "documents"))


def op10_rare_license_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(read(spark, sf_dir, "documents"))


URL_RULES = (("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
             ("block", "net", "/es/"), ("block", "net", "/fr/"))


def op11_shift_and_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_automaton.judge(read(spark, sf_dir, "pages"), URL_RULES)


def op12_fingerprint_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine(read(spark, sf_dir, "documents"), least=30, top=2000)


def op13_importance_draw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"), n=1, buckets=10_000,
                               percent=10, least_words=20, seed=2024)


QUERIES = {f.__name__: f for f in (
    op1_quality_knn, op2_sentence_spans, op3_simhash_bk_trees, op4_prefix_containment, op5_trigram_secrets, op6_suffix_array,
    op7_language_kernel, op8_temperature_mixing, op9_order_minhash, op10_rare_license_words,
    op11_shift_and_urls, op12_fingerprint_phrases, op13_importance_draw)}
