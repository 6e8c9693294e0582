"""The stream gives what the backfill gives, over several micro-batches."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from barloom.operators.indicators import stock_momentum, stock_moving_average, stock_rsi, stock_volume
from barloom.schemas import OHLCV
from barloom.streaming import windows
from barloom.streaming.wilder import stock_rsi_stream
from barloom.streaming.windows import OUTPUT, rolling_stream
from tests.test_indicators import frame, walk


def test_stream_equals_backfill(spark, tmp_path):
    bars = frame(spark, walk(60, 1)).unionByName(frame(spark, walk(60, 2), "B"))
    for k in range(3):
        day = F.datediff("time", F.lit("2024-01-01"))
        bars.filter((day >= 20 * k) & (day < 20 * k + 20)).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(OHLCV).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    q = stock_rsi_stream(stream).writeStream.format("memory").queryName("rsi_rows").outputMode("append").option("checkpointLocation", str(tmp_path / "cp")).start()
    q.processAllAvailable()
    q.stop()
    got = spark.table("rsi_rows").orderBy("symbol", "time").toPandas()
    pd.testing.assert_frame_equal(got, stock_rsi(bars).orderBy("symbol", "time").toPandas(), rtol=1e-9)


def rolled(spark, folder, name, **days):
    """One run over what lies in the folder, from where the last run ended; all rows so far."""
    stream = spark.readStream.schema(OHLCV).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
    q = rolling_stream(stream, **days).writeStream.format("parquet").option("path", f"{folder}/{name}").option("checkpointLocation", f"{folder}/{name}_state").trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.schema(OUTPUT).parquet(f"{folder}/{name}")


def backfill(bars):
    parts = [stock_momentum(bars), stock_moving_average(bars), stock_volume(bars)]
    return parts[0].join(parts[1], ["symbol", "time"]).join(parts[2], ["symbol", "time"])


def same(got, want):
    keys = ["symbol", "time"]
    pd.testing.assert_frame_equal(got.orderBy(keys).toPandas(), want.select(got.columns).orderBy(keys).toPandas(), rtol=1e-9, check_dtype=False)


def test_windows_of_a_stream_equal_backfill_after_restart_and_late_bars(spark, tmp_path):
    bars = frame(spark, walk(330, 1)).unionByName(frame(spark, walk(300, 2), "B"))
    bars = bars.withColumn("close", F.when((F.col("symbol") == "A") | (F.dayofyear("time") != 30), F.col("close"))).withColumn("volume", F.dayofyear("time").cast("long") % 7 * 10)
    day = F.datediff("time", F.lit("2024-01-01"))
    part = F.when((day % 5 == 3) & (day > 0), F.floor((day + 6) / 100)).otherwise(F.floor(day / 100))  # some come 6 days late
    dealt = bars.withColumn("_part", part).persist()
    stray = bars.limit(1).withColumn("symbol", F.lit(None).cast("string"))
    for k in range(4):
        batch = dealt.filter(F.col("_part") == k).drop("_part")
        batch.unionByName(batch.limit(5)).unionByName(stray).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        got = rolled(spark, tmp_path, "rows", delay_days=10)
    last = F.lit("2024-11-25 07:00:00").cast("timestamp_ntz")
    want = backfill(bars).filter(F.col("time") < last - F.expr("INTERVAL 10 DAYS"))
    assert got.count() == got.select("symbol", "time").distinct().count() > 600
    same(got, want)


def test_a_stream_drops_bars_beyond_the_delay_and_forgets_idle_symbols(spark, tmp_path):
    a, b = frame(spark, walk(60, 1)), frame(spark, walk(30, 2), "B")
    day = F.datediff("time", F.lit("2024-01-01"))
    again = b.filter(day >= 20).withColumn("time", F.col("time") + F.expr("INTERVAL 60 DAYS"))
    later = frame(spark, walk(120, 1)).filter(day >= 60)
    missed = a.filter(day == 40)
    lost = missed.withColumn("time", F.col("time") - F.expr("INTERVAL 90 DAYS"))
    for batch in (a.filter(day != 40).unionByName(b.filter(day < 20)), later.unionByName(missed), again.unionByName(lost), later.filter(day == 119).withColumn("time", F.col("time") + F.expr("INTERVAL 30 DAYS"))):
        batch.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        got = rolled(spark, tmp_path, "rows", delay_days=40, idle_days=10)
    assert got.filter((F.col("symbol") == "A") & (day == 40)).count() == 1  # twenty days late is in time
    assert got.filter((F.col("symbol") == "A") & (day < 0)).count() == 0  # beyond the delay
    assert got.filter(F.col("symbol") == "B").count() == 30 and got.filter((F.col("symbol") == "B") & F.col("sma_20").isNotNull()).count() == 0
    empty = spark.createDataFrame([], OHLCV)
    empty.write.parquet(str(tmp_path / "none" / "in"))
    assert rolled(spark, tmp_path / "none", "rows").count() == 0


def test_windows_as_helpers():
    x = np.array([1.0, 2.0, np.nan, 4.0, 0.0, 6.0])
    assert np.isnan(windows._mean_before(x, 2)[[0, 1, 3, 4]]).all() and windows._mean_before(x, 2)[[2, 5]].tolist() == [1.5, 2.0]
    assert len(windows.values(x[:0], x[:0])["m_1"]) == 0 and np.isnan(windows._divided(x[:1], np.zeros(1))[0])
