"""Token counts through a digest cache (operator 10).

The key of a text is the SHA-256 of the tokenizer's version and of its normalised content. byte_bpe_50k.json
has no normaliser, so content is normalised to itself: any other change would change counts. Keys are joined to
the stored counts; one text of each key without a count is encoded and its count appended to the cache table.

Copies meet in a partial aggregation before the exchange, so a text that a third of all rows share is one row
of each map task; the join back reads a stored table with one row a key, so adaptive execution can split a hot key.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import fresh_path, materialize, whole_texts
from barloom.llm.wordmemo import ByteWordCounts, file_version, memo

CACHE_SCHEMA = "digest binary, n_tokens long"


def read_cache(spark, cache_path: str) -> DataFrame:
    """The stored counts, one row a digest, however often a retried or second writer appended it; empty where the cache
    was never written."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(cache_path)
    if not hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop):
        return spark.createDataFrame([], CACHE_SCHEMA)
    return spark.read.schema(CACHE_SCHEMA).option("recursiveFileLookup", True).parquet(cache_path).groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))


def encode_counts(texts: DataFrame, tokenizer_path: str) -> DataFrame:
    """(digest, n_tokens, new) from (digest, text, n_tokens): what has no count yet is encoded."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        count = memo(ByteWordCounts, tokenizer_path).count
        for b in batches:
            new = b["text"].notna().to_numpy()
            n = b["n_tokens"].fillna(0).to_numpy().astype(np.int64)
            n[new] = [count(t) for t in b["text"][new]]
            yield pd.DataFrame({"digest": b["digest"], "n_tokens": n, "new": new})

    asked = texts.select("digest", F.when(F.col("n_tokens").isNull(), F.col("text")).alias("text"), "n_tokens")
    return asked.mapInPandas(run, CACHE_SCHEMA + ", new boolean")


def token_counts(docs: DataFrame, tokenizer_path: str, cache_path: str | None = None, limit: int = 1024) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for each row of `docs`.

    NULL and empty texts count 0 tokens; texts of any length are encoded whole; repeated rows each keep their row; an
    empty table gives no rows; a NULL doc_id is kept; other columns of `docs` are not read. `cache_path` is a folder of
    Parquet tables of (digest, n_tokens) that grows by one folder of misses a call; without it the call starts with
    an empty cache in the shared folder. Counting happens when the function is called, the join back is lazy.
    """
    spark = docs.sparkSession
    cache_path = cache_path or fresh_path(spark, "token-cache")
    version = F.lit(file_version(tokenizer_path))
    keyed = whole_texts(docs).select("doc_id", "text", F.unhex(F.sha2(F.concat(version, F.col("text")), 256)).alias("digest"))
    wanted = keyed.groupBy("digest").agg(F.first("text").alias("text")).join(read_cache(spark, cache_path), "digest", "left")
    counts = materialize(encode_counts(wanted, tokenizer_path), "token-counts")
    new = counts.filter("new").select("digest", "n_tokens")
    new.write.parquet(f"{cache_path}/{uuid.uuid4().hex}")
    return keyed.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), "digest").join(counts.select("digest", "n_tokens"), "digest", "left").select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )
