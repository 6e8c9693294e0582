"""Percentile ranks by blocks: equal to a count over each window, and to the window expression."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from barloom.functions import slidingrank
from barloom.functions.series import by_symbol, percentile_rank
from barloom.sources import fixtures
from tests.conftest import SF
from tests.test_entry import normal


@pytest.mark.parametrize("n", [1, 2, 3, 16, 17, 126, 252])
@pytest.mark.parametrize("m", [0, 1, 5, 130, 700])
def test_ranks_against_each_window(n, m):
    draw = np.random.default_rng(m * 1000 + n)
    x = draw.integers(0, 40, m).astype(float)
    x[draw.random(m) < 0.004] = np.nan
    want = []
    for i in range(m):
        w = x[max(0, i - n + 1) : i + 1]
        want.append(np.nan if len(w) < n or np.isnan(w).any() else ((w < x[i]).sum() + ((w == x[i]).sum() + 1) / 2) / n)
    np.testing.assert_array_equal(slidingrank.ranks(x, n), np.array(want))


@pytest.mark.parametrize("rows", [20, 64, 4096])
def test_equal_to_the_window_expression(spark, rows):
    bars = fixtures.ohlcv_prices(spark, SF).withColumn("close", F.when(F.dayofyear("time") != 100, F.round("close", -2)))
    want = bars.select("symbol", "time", *[percentile_rank(F.col("close"), n, by_symbol()).alias(f"p{n}") for n in (5, 20)])
    got = slidingrank.percentile_ranks(bars, ["symbol"], F.col("close"), {"p5": 5, "p20": 20}, rows)
    assert normal(got.toPandas()) == normal(want.toPandas())


def test_edges(spark):
    nothing = spark.createDataFrame([], "symbol string, time timestamp_ntz, x double")
    assert slidingrank.percentile_ranks(nothing, ["symbol"], F.col("x"), {"p": 3}, 8).count() == 0
    alone = fixtures.vnindex_history(spark, SF)
    got = slidingrank.percentile_ranks(alone, [], F.col("close"), {"p": 7}, 100).filter("p IS NOT NULL").count()
    assert got == alone.count() - 6
    with pytest.raises(ValueError):
        slidingrank.percentile_ranks(alone, [], F.col("close"), {"p": 200}, 100)
