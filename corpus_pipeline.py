"""Corpus cleaning from documents to packed sequences.

Each stage works on all that the one before it kept and, but for the last, returns the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.llm import decontaminate, neardup, packing, quality, secrets
from barloom.llm.common import keep_where, load, materialize


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects.

    NULL and empty texts have no words and go; repeated rows are judged each and alike; a NULL doc_id makes no
    difference; an empty table gives none.
    """
    judged = quality.judge(docs, carry=True).select("_row", "kept")
    return keep_where(judged, F.col("kept")).select("_row.*")


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates: the text with the least doc_id.

    Classes are made of texts, not of ids: different texts under one doc_id, or without one, are judged by themselves, and
    equal texts, NULL and empty ones included, are one document whatever their ids. A row with a NULL doc_id stays only if
    its class has no other. Of repeated rows one stays; an empty table gives none.
    """
    return neardup.keepers(docs, threshold=0.8)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark.

    A text is judged by itself: whatever holds a leaked text goes, repeated rows and rows with a NULL doc_id included, and
    another text under the same doc_id, or without one, stays. NULL and empty texts stay; an empty table, or an empty
    benchmark, changes nothing.
    """
    leaked = decontaminate.leaks(docs, load(spark, sf_dir, "benchmark"), carry=True).select(F.col("text_md5").alias("_leaked")).distinct()
    return docs.join(leaked, F.md5(F.coalesce(F.col("text"), F.lit(""))) == F.col("_leaked"), "left_anti")


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, every secret replaced by its kind; n_chars follows.

    A NULL text stays NULL, an empty one empty; repeated rows and rows with a NULL doc_id are redacted each; an empty
    table gives none.
    """
    scanned = secrets.scan(docs, carry=True)
    out = scanned.select("_row.*", F.when(F.col("_row.text").isNotNull(), secrets.redact(scanned)).alias("_clean"))
    columns = {"text": F.col("_clean"), "n_chars": F.length("_clean").cast("long")}
    return out.select(*[columns.get(c, F.col(f"`{c}`")).alias(c) for c in docs.columns])


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents, packed into sequences of 2048 tokens.

    NULL and empty texts are one piece of the end id; repeated rows are packed each; a NULL doc_id is kept; ties in
    length go by a hash bucket and doc_id; an empty table gives no rows.
    """
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), capacity=2048)


STAGES = [
    ("quality_rules", quality_stage),
    ("near_dedup", near_dedup_stage),
    ("decontamination", decontamination_stage),
    ("secret_scan", secret_stage),
    ("packing", packing_stage),
]

#: Near-duplicate classes and the packing plan are no SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STAGES applied in order to documents; what a stage returns is written and read again."""
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
