"""Feature tables stored by symbol, so that joins and windows by symbol read them without an exchange."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: Buckets of a table; all tables that are to be joined need the same number.
BUCKETS = 64


def write_bucketed(df: DataFrame, table: str, path: str, buckets: int = BUCKETS) -> None:
    """Stores `df` as an external table in one file a bucket, sorted by symbol and time within it."""
    rows = df.repartition(buckets, "symbol").sortWithinPartitions("symbol", "time")
    rows.write.bucketBy(buckets, "symbol").sortBy("symbol", "time").option("path", path).mode("overwrite").saveAsTable(table)


def co_located(spark: SparkSession) -> SparkSession:
    """A session of the same application in which tables stored by symbol join by (symbol, time) where they lie: rows
    that agree on both agree on the symbol."""
    session = spark.newSession()
    session.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    session.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "true")
    for key in ("spark.sql.shuffle.partitions", "spark.sql.session.timeZone"):
        session.conf.set(key, spark.conf.get(key))
    return session
