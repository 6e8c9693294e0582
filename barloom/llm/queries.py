"""The queries opN_<name> with production parameters, and the SQL of those that SQL can express."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from barloom.llm import alignment, byterepeats, decontaminate, lexical, neardup, packing, pii, quality, secrets, simhash, token_counts, toxicity, wordrepeats
from barloom.llm.common import load


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))


def op2_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.classes(load(spark, sf_dir, "documents"), threshold=0.8)


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(secrets.scan(load(spark, sf_dir, "documents")))


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.scan(load(spark, sf_dir, "documents")))


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wordrepeats.digest(wordrepeats.remove_repeats(load(spark, sf_dir, "documents"), window=35))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.digest(quality.judge(load(spark, sf_dir, "documents")))


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(load(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), capacity=2048)


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.digest(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byterepeats.digest(byterepeats.remove_repeats(load(spark, sf_dir, "documents"), window=100))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts are kept from run to run where the session names a folder for them; else a run starts with none."""
    cache = spark.conf.get("spark.barloom.tokenCache", None)
    return token_counts.token_counts(load(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), cache, limit=1024)


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"), k=10)


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(load(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


def op13_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_components(load(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_decontamination, op2_near_dedup, op3_secret_scan, op4_pii, op5_substring_dedup, op6_quality_rules, op7_best_fit_packing, op8_toxicity, op9_suffix_dedup, op10_token_counts, op11_lexical_search, op12_token_alignment, op13_simhash_dedup)}

ORACLE_SQL: dict[str, str] = {"op3_secret_scan": secrets.ORACLE, "op6_quality_rules": quality.ORACLE, "op11_lexical_search": lexical.ORACLE}
