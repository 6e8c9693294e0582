"""Rule decisions with the length of their current run: the market regime and the structural filter of symbols."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.functions.series import of_index, streak, truth
from barloom.operators.indicators import log_return, regime_features

#: Fixed values.
REGIME = {"m_60d": 0.03, "drawdown_40d": -0.08, "vol_20d": 0.25}
STRUCTURAL = {"m_3": -0.10, "m_1": -0.05, "rsi_14": 75.0, "vol_20d_pct_126": 90.0, "rsi_14_close": 0.12, "volume_ratio": 0.7}
MIN_VOLUME = 1_000_000


def regime_input(index: DataFrame) -> DataFrame:
    """The index with its four features: windows over one order of the sessions, no joins."""
    d = index.select("time", "close", log_return(of_index()).alias("_r"))
    return d.select("time", "close", *[x.alias(name) for name, x in regime_features().items()])


def safe(f: dict[str, float] = REGIME) -> Column:
    return truth((F.col("close") > F.col("sma_150")) & (F.col("m_60d") > f["m_60d"]) & (F.col("drawdown_40d") > f["drawdown_40d"]) & (F.col("vol_20d") < f["vol_20d"]))


def regime(features: DataFrame) -> DataFrame:
    """SAFE or DEFENSIVE for each session, the thresholds used, and for how many sessions it has been SAFE."""
    d = streak(features.withColumn("_ok", safe()), "_ok", "positive_streak", [])
    return d.select("time", *[F.lit(v).alias(f"{c}_threshold") for c, v in REGIME.items()], F.when(F.col("_ok"), "SAFE").otherwise("DEFENSIVE").alias("suggestion"), "positive_streak")


def possible(version: int, t: dict[str, float] = STRUCTURAL) -> Column:
    """The condition of a version, over the columns of indicators.features. The limit of 90 on a fraction only asks
    that there be one; it is kept as it is. rsi_14_close is the name of the limit on atr / close."""
    c = F.col
    if version == 3:
        return truth((c("close") > c("sma_20")) & (c("close") > c("sma_50")) & (c("volume") > MIN_VOLUME))
    trend = (c("close") > c("sma_50")) & (c("sma_20") > c("sma_50")) & (c("sm_3") > t["m_3"]) & (c("sm_1") > t["m_1"])
    if version == 2:
        return truth(trend)
    if version != 1:
        raise ValueError(f"no structural version {version}")
    calm = (c("rsi_14") < t["rsi_14"]) & (c("vol_20d_pct_126") < t["vol_20d_pct_126"]) & (F.try_divide("atr_14_w", "close") < t["rsi_14_close"]) & (c("volume_ratio") < t["volume_ratio"])
    return truth(trend & calm)


def structural(features: DataFrame, version: int) -> DataFrame:
    """POSSIBLE or AVOID for each symbol and session, the thresholds, and for how many sessions it has been POSSIBLE."""
    d = streak(features.withColumn("_ok", possible(version)), "_ok", "positive_streak", ["symbol"])
    return d.select("symbol", "time", *[F.lit(v).alias(f"{c}_threshold") for c, v in STRUCTURAL.items()], F.when(F.col("_ok"), "POSSIBLE").otherwise("AVOID").alias("suggestion"), "positive_streak")
