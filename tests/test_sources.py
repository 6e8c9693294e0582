"""The bars data source, its filters and offsets, and tables stored by symbol."""

import pytest
from pyspark.sql import functions as F

from barloom.operators import indicators
from barloom.sources import bars_source, fixtures, layout
from tests.conftest import SF
from tests.test_entry import normal


@pytest.fixture(scope="module")
def bars(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("bars") / "b")
    fixtures.ohlcv_prices(spark, SF).filter("symbol IN ('Brand#11', 'Brand#12', 'Brand#22')").write.parquet(path)
    return spark.read.parquet(path)


def alike(a, b):
    assert normal(a.toPandas()) == normal(b.select(*a.columns).toPandas())


def test_what_is_wanted_reaches_the_reader(spark, bars, tmp_path):
    folder = f"file://{tmp_path}/p"
    bars_source.publish(bars, folder)
    whole = bars_source.published(spark, folder)
    alike(bars, whole)
    some = bars_source.published(spark, folder, ["Brand#11", "Brand#22", "nobody"], "1995-03-01T07:00:00", "1996-01-05T07:00:00", 100)
    alike(bars.filter("symbol IN ('Brand#11', 'Brand#22') AND time BETWEEN timestamp_ntz'1995-03-01 07:00:00' AND timestamp_ntz'1996-01-05 07:00:00'"), some)
    assert some.rdd.getNumPartitions() == 2 * 4  # one a symbol and 100 days
    assert bars_source.published(spark, folder, []).count() == 0 == bars_source.published(spark, folder, first="2050-01-01").count()
    assert whole.filter("symbol = 'Brand#11'").count() + whole.filter("symbol != 'Brand#11'").count() == whole.count() == bars.count()


def test_a_stream_goes_on_from_its_offset(spark, bars, tmp_path):
    folder, out = f"file://{tmp_path}/p", str(tmp_path / "out")

    def take():
        bars_source.stream(spark, folder).writeStream.format("parquet").option("path", f"{out}/r").option("checkpointLocation", f"{out}/c").trigger(availableNow=True).start().awaitTermination()
        return spark.read.schema(bars_source.SCHEMA).parquet(f"{out}/r")

    early = bars.filter("time < timestamp_ntz'1996-01-01 00:00:00'")
    bars_source.publish(early, folder)
    alike(early, take())
    alike(early, take())  # nothing new
    bars_source.publish(bars.filter("time >= timestamp_ntz'1996-01-01 00:00:00'"), folder)
    bars_source.publish(bars.limit(0), folder)
    alike(bars, take())
    alike(bars, bars_source.published(spark, folder))


def test_stored_by_symbol_joins_without_exchange(spark, bars, tmp_path):
    stored = layout.co_located(spark)
    for name, df in (("b", bars), ("m", indicators.stock_momentum(bars)), ("a", indicators.stock_moving_average(bars))):
        layout.write_bucketed(df, f"stored_{name}", str(tmp_path / name), 4)
    b, m, a = (stored.table(f"stored_{n}") for n in "bma")
    stored.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # else small tables are broadcast
    met = b.join(m, ["symbol", "time"]).join(a, ["symbol", "time"]).select("symbol", "time", "close", "m_3", "sma_20")
    assert "Exchange" not in met._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in indicators.stock_rsi(b)._jdf.queryExecution().executedPlan().toString()
    alike(bars.join(indicators.stock_momentum(bars), ["symbol", "time"]).join(indicators.stock_moving_average(bars), ["symbol", "time"]).select(*met.columns), met)
    alike(indicators.stock_rsi(bars), indicators.stock_rsi(b))
    assert bars.filter(F.col("symbol") == "Brand#11").count() == b.filter(F.col("symbol") == "Brand#11").count()
