"""Two-level scans: equal to the one-partition operators, and no series in one task."""

import re

import pytest
from pyspark.sql import functions as F

from barloom.functions import scan
from barloom.operators import backtest, decisions, indicators, longseries
from barloom.sources import fixtures
from tests.conftest import SF
from tests.test_entry import normal


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """(bars, index) read from tables, so that plans hold only what the operators add."""
    top, out = tmp_path_factory.mktemp("stored"), []
    for name, df in (("bars", fixtures.ohlcv_prices(spark, SF)), ("index", fixtures.vnindex_history(spark, SF))):
        df.write.parquet(f"{top}/{name}")
        out.append(spark.read.parquet(f"{top}/{name}"))
    return out


def alike(a, b):
    assert normal(a.toPandas()) == normal(b.select(*a.columns).toPandas())


@pytest.mark.parametrize("rows", [160, 286, 5000])
def test_index_in_blocks(spark, stored, rows):
    index = stored[1]
    alike(decisions.regime(decisions.regime_input(index)), longseries.regime(index, rows))
    alike(indicators.index_momentum(index), longseries.index_momentum(index, rows))
    spread = index.select("time", (F.col("change_percentage") / 100).alias("spread"))
    alike(backtest.spread_equity(spread), longseries.spread_equity(spread, rows))
    ic = index.select("time", F.when(F.col("volume") % 7 > 0, F.col("change_percentage")).alias("ic"))
    alike(backtest.newey_west(ic), longseries.newey_west(ic, rows=rows))


def test_a_total_loss_stays(spark, stored):
    spread = stored[1].select("time", F.when(F.year("time") == 1995, -1.0).otherwise(0.01).alias("spread"))
    alike(backtest.spread_equity(spread), longseries.spread_equity(spread, 200))


@pytest.mark.parametrize("rows", [20, 64, 4096])
def test_symbols_in_blocks(spark, stored, rows):
    alike(indicators.stock_rsi(stored[0]), longseries.stock_rsi(stored[0], rows))


def test_volatility_in_blocks(spark, stored):
    hot = stored[1].select(F.lit("hot").alias("symbol"), "time", "high", "low", "close")
    alike(indicators.stock_volatility(hot), longseries.stock_volatility(hot, 300))


def test_no_task_reads_a_whole_series(spark, stored):
    """A single-partition exchange stands only above an aggregate, one row a block or month."""
    index = stored[1]
    for df in (longseries.regime(index, 320), longseries.spread_equity(index.select("time", F.lit(0.1).alias("spread")), 320)):
        lines = df._jdf.queryExecution().executedPlan().toString().split("\n")
        below = [lines[k + 1] for k, x in enumerate(lines) if "Exchange SinglePartition" in x]
        assert below and all("HashAggregate" in x or "SortAggregate" in x for x in below)
    rsi = longseries.stock_rsi(stored[0], 320)._jdf.queryExecution().executedPlan().toString()
    lines = rsi.split("\n")
    below = [lines[k + 1 : k + 10] for k, x in enumerate(lines) if re.search(r"Exchange hashpartitioning\(symbol#\d+, \d+\)", x)]
    assert below and all(any("Aggregate" in y for y in x) for x in below)


def test_edges(spark):
    nothing = spark.createDataFrame([], "symbol string, time timestamp_ntz, close double")
    assert longseries.stock_rsi(nothing, 64).count() == 0
    one = spark.createDataFrame([("a", 1.0), ("a", None), ("b", 2.0)], "symbol string, close double").withColumn("time", F.expr("timestamp_ntz'2024-01-01 07:00:00'"))
    one = one.withColumn("time", F.col("time") + F.make_interval(days=F.monotonically_increasing_id() % 7))
    alike(indicators.stock_rsi(one), longseries.stock_rsi(one, 64))
    with pytest.raises(ValueError):
        scan.within_blocks(one, ["symbol"], 10, 10)
    with pytest.raises(ValueError):
        scan.affine(one, ["symbol"], {"y": F.col("close")}, 0.1, 4096)
