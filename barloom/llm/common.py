"""Shared helpers of the corpus operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.sources.storage import fresh_path

#: Words are runs of anything but space and the controls TAB..CR.
WORD = r"[^\x20\x09-\x0D]+"


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write `df` once to the shared folder and read it back: cuts lineage and survives lost executors."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def whole_texts(docs: DataFrame, carry: bool = False) -> DataFrame:
    """Only (doc_id, text), NULL text as ''; other columns, whatever their names, are left behind or, with `carry`,
    go along as one struct, _row."""
    more = [F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")] if carry else []
    return docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"), *more)


def numbered_texts(docs: DataFrame) -> DataFrame:
    """(doc_id, no_id, text) for Python workers: pandas would turn 64-bit ids that stand beside a NULL into doubles, so
    a missing doc_id goes as 0 with no_id set. NULL text is ''."""
    return docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("doc_id"), F.col("doc_id").isNull().alias("no_id"), F.coalesce(F.col("text"), F.lit("")).alias("text")
    )


def with_missing_ids(df: DataFrame) -> DataFrame:
    """What `numbered_texts` named, with NULL for a missing doc_id again."""
    return df.withColumn("doc_id", F.when(~F.col("no_id"), F.col("doc_id"))).drop("no_id")


def width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def keep_where(df: DataFrame, condition) -> DataFrame:
    """Rows where `condition` holds. A generator, unlike a filter, is not pushed below the projections that compute
    its columns, where each of their array expressions would be evaluated again."""
    return df.withColumn("_kept", F.explode(F.when(condition, F.array(F.lit(1))))).drop("_kept")
