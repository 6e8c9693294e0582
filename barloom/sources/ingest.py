"""Reading and cleaning of listings and of the raw index file; everything stays text until it is parsed here."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.schemas import INDEX, RAW_INDEX_CSV

SUFFIXES = {"K": 1e3, "M": 1e6, "B": 1e9}


def read_index_csv(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RAW_INDEX_CSV).option("header", True).csv(path)


def trimmed(df: DataFrame) -> DataFrame:
    """All text columns without white space at their ends."""
    return df.select(*[F.regexp_replace(f.name, r"^[\s\u00A0]+|[\s\u00A0]+$", "").alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(f.name) for f in df.schema])


def magnitude(x: Column) -> Column:
    """A number with a suffix K, M or B as a whole number, halves to even; NULL where there is none."""
    number = F.nullif(F.regexp_extract(F.upper(x), r"([\d.]+)([KMB])", 1), F.lit("")).try_cast("double")
    unit = F.regexp_extract(F.upper(x), r"([\d.]+)([KMB])", 2)
    factor = F.when(unit == "K", SUFFIXES["K"]).when(unit == "M", SUFFIXES["M"]).when(unit == "B", SUFFIXES["B"])
    return F.rint(number * factor).cast("long")


def number(x: Column, drop: str) -> Column:
    return F.replace(F.trim(x), F.lit(drop), F.lit("")).try_cast("double")


def parse_index_csv(raw: DataFrame) -> DataFrame:
    """The raw file as the index table: days stamped 07:00, like the sessions of the symbols."""
    d = trimmed(raw)
    return d.select(
        (F.to_timestamp_ntz("time", F.lit("dd/MM/yyyy")) + F.expr("INTERVAL 7 HOURS")).alias("time"),
        *[number(F.col(c), ",").alias(c) for c in ("open", "high", "low", "close")],
        magnitude(F.col("volume")).alias("volume"),
        number(F.col("change_percentage"), "%").alias("change_percentage"),
    ).select(*INDEX.names)


def vendor_bars(bars: DataFrame, symbol: str) -> DataFrame:
    """A symbol's bars as any vendor's table gives them, with the symbol put in front and the columns of the contract."""
    return bars.select(F.lit(symbol).alias("symbol"), "time", *[F.col(c).cast("double").alias(c) for c in ("open", "high", "low", "close")], F.col("volume").cast("long").alias("volume"))


def write_csv_by_symbol(df: DataFrame, path: str) -> None:
    """One folder of CSV files for each symbol."""
    df.write.mode("overwrite").partitionBy("symbol").option("header", True).csv(path)


def write_table(df: DataFrame, path: str, partition: str | None = None) -> None:
    """Replaces a Parquet table, or only the partitions that `df` holds."""
    writer = df.write.mode("overwrite")
    if partition:
        writer = writer.partitionBy(partition).option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)


def query(spark: SparkSession, sql: str, tables: dict[str, DataFrame] | None = None, **parameters) -> DataFrame:
    """A parameterised query with named markers, over tables in braces; errors are raised."""
    return spark.sql(sql, args=parameters, **(tables or {}))


def replace_table(df: DataFrame, path: str) -> str:
    """Commits `df` as the next version of the table at `path`, which `df` may have been read from, and returns the
    version's folder. Readers see the old version until the new one is complete: the folder's name holds its number,
    and a version without Spark's _SUCCESS mark does not count."""
    version = f"{path}/version={_latest_version(df.sparkSession, path) + 1:09d}"
    df.write.mode("overwrite").parquet(version)
    return version


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The latest complete version of a table that `replace_table` wrote."""
    latest = _latest_version(spark, path)
    if latest < 0:
        raise ValueError(f"no complete version of a table at {path}")
    return spark.read.parquet(f"{path}/version={latest:09d}")


def _latest_version(spark: SparkSession, path: str) -> int:
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/version=*/_SUCCESS")
    found = folder.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(folder) or []
    return max((int(f.getPath().getParent().getName().rpartition("=")[2]) for f in found), default=-1)
