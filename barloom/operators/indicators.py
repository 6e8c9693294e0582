"""Technical indicators of all symbols, and of the index, in one plan each: one shuffle by symbol, window functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from barloom.functions.series import by_symbol, change, divided, ewm, log, of_index, percentile_rank, roll, roll_before

#: Sessions of 1, 3, 6 and 12 months, for symbols and for the index.
STOCK_LAGS = {"m_1": 21, "m_3": 63, "m_6": 126, "m_12": 252}
INDEX_LAGS = {"m_21d": 21, "m_60d": 60, "m_126d": 126}
SMA_DAYS = (20, 50, 200)
VOLATILITY_DAYS = (20, 60, 126, 252)
WILDER = 14
DECAY = (WILDER - 1) / WILDER
YEAR = 252
#: Volatilities that agree to so many digits tie in a percentile rank.
TIE_DIGITS = 12


def log_return(w) -> Column:
    return log(divided(F.col("close"), F.lag("close").over(w)))


def true_range(w) -> Column:
    """The greatest of high - low and the distances from the last close; the first row has only the former."""
    before = F.lag("close").over(w)
    return F.greatest(F.col("high") - F.col("low"), F.abs(F.col("high") - before), F.abs(F.col("low") - before))


def stock_momentum(bars: DataFrame) -> DataFrame:
    w = by_symbol()
    return bars.select("symbol", "time", *[change(F.col("close"), n, w).alias(c) for c, n in STOCK_LAGS.items()])


def momentum_composite(bars: DataFrame) -> DataFrame:
    """m_3, m_6, m_12 and their mean."""
    m = stock_momentum(bars)
    return m.select("symbol", "time", "m_3", "m_6", "m_12", ((F.col("m_3") + F.col("m_6") + F.col("m_12")) / 3).alias("m_composite"))


def stock_moving_average(bars: DataFrame) -> DataFrame:
    """Means of the closes before the current row."""
    w = by_symbol()
    return bars.select("symbol", "time", *[roll_before(F.avg, F.col("close"), n, w).alias(f"sma_{n}") for n in SMA_DAYS])


def stock_volume(bars: DataFrame) -> DataFrame:
    """Mean volumes of the 20 and 60 rows before, their ratio, and today's volume against the former."""
    w = by_symbol()
    v = F.col("volume").cast("double")
    means = bars.select("symbol", "time", v.alias("_volume"), roll_before(F.avg, v, 20, w).alias("vol_20d"), roll_before(F.avg, v, 60, w).alias("vol_60d"))
    return means.select("symbol", "time", "vol_20d", "vol_60d", F.try_divide("vol_20d", "vol_60d").alias("volume_ratio"), F.try_divide("_volume", "vol_20d").alias("volume_spike"))


def stock_rsi(bars: DataFrame) -> DataFrame:
    """Wilder's relative strength: exponential averages of gains and losses, seeded by the first difference.

    No loss gives 100; neither gain nor loss gives NULL; NULL before 14 differences.
    """
    w = by_symbol()
    d = bars.select("symbol", "time", (F.row_number().over(w) - 1).alias("_i"), (F.col("close") - F.lag("close").over(w)).alias("_d"))
    weight = F.when(F.col("_i") == 1, 1.0).otherwise(1.0 / WILDER)
    gain = F.when(F.col("_d").isNotNull(), F.greatest("_d", F.lit(0.0))) * weight
    loss = F.when(F.col("_d").isNotNull(), F.greatest(-F.col("_d"), F.lit(0.0))) * weight
    return relative_strength(ewm(d, {"_g": gain, "_l": loss}, 1, DECAY, ["symbol"], "_i"))


def relative_strength(d: DataFrame) -> DataFrame:
    """The strength from the averages _g of gains and _l of losses and the row _i."""
    g, loss_, ready = F.col("_g"), F.col("_l"), F.col("_i") >= WILDER
    rsi = F.when(loss_ > 0, 100 - 100 / (1 + F.try_divide(g, loss_))).when(g > 0, 100.0)
    return d.select("symbol", "time", F.when(ready, rsi).alias("rsi_14"), F.when(ready, g).alias("average_gain_14"), F.when(ready, loss_).alias("average_loss_14"))


def _with_wilder_atr(df: DataFrame, first: int) -> DataFrame:
    """Adds atr_14_w from the true range _tr and the row _i: mean of 14 at row 13 (first=13), or seeded by row 0."""
    weight = F.lit(1.0 / WILDER) if first else F.when(F.col("_i") == 0, 1.0).otherwise(1.0 / WILDER)
    df = ewm(df, {"_atr": F.col("_tr") * weight}, first, DECAY, ["symbol"], "_i")
    return df.withColumn("atr_14_w", F.when(F.col("_i") >= first, F.col("_atr"))).drop("_atr")


def stock_volatility(bars: DataFrame) -> DataFrame:
    """Annualised volatilities, plain and Wilder's true range, Parkinson's estimate and percentile ranks of volatility."""
    w = by_symbol()
    d = bars.select(
        "symbol",
        "time",
        (F.row_number().over(w) - 1).alias("_i"),
        log_return(w).alias("_r"),
        true_range(w).alias("_tr"),
        F.pow(log(divided(F.col("high"), F.col("low"))), 2).alias("_hl"),
    )
    d = _with_wilder_atr(d, WILDER - 1)
    d = d.select(
        "symbol",
        "time",
        *[(roll(F.stddev_samp, F.col("_r"), n, w) * F.sqrt(F.lit(float(YEAR)))).alias(f"vol_{n}d") for n in VOLATILITY_DAYS],
        roll(F.avg, F.col("_tr"), WILDER, w).alias("atr_14_r"),
        "atr_14_w",
        (F.sqrt(roll(F.sum, F.col("_hl"), 20, w) / (F.lit(80.0) * F.ln(F.lit(2.0)))) * F.sqrt(F.lit(float(YEAR)))).alias("parkinson_20d"),
    )
    d = d.withColumn("_tie", F.round("vol_20d", TIE_DIGITS))
    return d.select("*", *[percentile_rank(F.col("_tie"), n, w).alias(f"vol_20d_pct_{n}") for n in (126, 252)]).drop("_tie")


def stock_atr_ewm(bars: DataFrame) -> DataFrame:
    """The older true-range average, seeded by the first row."""
    w = by_symbol()
    d = bars.select("symbol", "time", (F.row_number().over(w) - 1).alias("_i"), true_range(w).alias("_tr"))
    return _with_wilder_atr(d, 0).select("symbol", "time", F.col("atr_14_w").alias("atr_14_e"))


def index_lags(w: WindowSpec) -> dict[str, Column]:
    return {c: change(F.col("close"), n, w) for c, n in INDEX_LAGS.items()}


def index_momentum(index: DataFrame) -> DataFrame:
    return index.select("time", *[x.alias(c) for c, x in index_lags(of_index()).items()])


def regime_features(w: WindowSpec | None = None) -> dict[str, Column]:
    """The four features of the regime over an index with close and the log return _r, all in one order."""
    w, close = w if w is not None else of_index(), F.col("close")
    top = roll(F.max, close, 40, w)
    return {
        "m_60d": change(close, INDEX_LAGS["m_60d"], w),
        "sma_150": roll_before(F.avg, close, 150, w),
        "drawdown_40d": F.try_divide(close - top, top),
        "vol_20d": roll(F.stddev_samp, F.col("_r"), 20, w) * F.sqrt(F.lit(float(YEAR))),
    }


def index_moving_average(index: DataFrame) -> DataFrame:
    return index.select("time", regime_features()["sma_150"].alias("sma_150"))


def index_drawdown(index: DataFrame) -> DataFrame:
    return index.select("time", regime_features()["drawdown_40d"].alias("drawdown_40d"))


def index_volatility(index: DataFrame) -> DataFrame:
    d = index.select("time", log_return(of_index()).alias("_r"))
    return d.select("time", regime_features()["vol_20d"].alias("vol_20d"))


def joined_features(bars: DataFrame, momentum: DataFrame, average: DataFrame, rsi: DataFrame, volatility: DataFrame, index: DataFrame | None = None, volume: DataFrame | None = None) -> DataFrame:
    """Inner joins of stored feature tables by (symbol, time), and with the index momentum by time.

    All tables are hashed by symbol and time, so bucketed tables join without a shuffle. The index table has one row
    a session; adaptive execution broadcasts it after measuring it.
    """
    key = ["symbol", "time"]
    out = bars.select(*key, "close", F.col("volume").cast("double").alias("volume"))
    out = out.join(average.select(*key, "sma_20", "sma_50"), key)
    out = out.join(momentum.select(*key, F.col("m_1").alias("sm_1"), F.col("m_3").alias("sm_3"), F.col("m_6").alias("sm_6")), key)
    out = out.join(rsi.select(*key, "rsi_14"), key)
    out = out.join(volatility.select(*key, "vol_20d_pct_126", "atr_14_w"), key)
    if volume is not None:
        out = out.join(volume.select(*key, "volume_ratio"), key)
    if index is not None:
        out = out.join(index.select("time", F.col("m_21d").alias("vnim_1"), F.col("m_60d").alias("vnim_3"), F.col("m_126d").alias("vnim_6")), "time")
    return out


def features(bars: DataFrame, index_momentum_: DataFrame | None = None, ahead: tuple[int, ...] = ()) -> DataFrame:
    """What `joined_features` gives, computed from the bars in one pass over each symbol instead of by joins; and close_ahead_n,
    the close n sessions on, for each n of `ahead`."""
    w = by_symbol()
    v = F.col("volume").cast("double")
    d = bars.select(
        "symbol",
        "time",
        "close",
        v.alias("volume"),
        (F.row_number().over(w) - 1).alias("_i"),
        (F.col("close") - F.lag("close").over(w)).alias("_d"),
        true_range(w).alias("_tr"),
        log_return(w).alias("_r"),
        *[change(F.col("close"), STOCK_LAGS[c], w).alias(f"s{c}") for c in ("m_1", "m_3", "m_6")],
        *[roll_before(F.avg, F.col("close"), n, w).alias(f"sma_{n}") for n in (20, 50)],
        F.try_divide(roll_before(F.avg, v, 20, w), roll_before(F.avg, v, 60, w)).alias("volume_ratio"),
        *[F.lead("close", n).over(w).alias(f"close_ahead_{n}") for n in ahead],
    )
    d = d.withColumn("_vol", F.round(roll(F.stddev_samp, F.col("_r"), 20, w) * F.sqrt(F.lit(float(YEAR))), TIE_DIGITS))
    d = d.withColumn("vol_20d_pct_126", percentile_rank(F.col("_vol"), 126, w))
    weight = F.when(F.col("_i") == 1, 1.0).otherwise(1.0 / WILDER)
    gain = F.when(F.col("_d").isNotNull(), F.greatest("_d", F.lit(0.0))) * weight
    loss = F.when(F.col("_d").isNotNull(), F.greatest(-F.col("_d"), F.lit(0.0))) * weight
    d = ewm(d, {"_g": gain, "_l": loss}, 1, DECAY, ["symbol"], "_i")
    d = _with_wilder_atr(d, WILDER - 1)
    rsi = F.when(F.col("_l") > 0, 100 - 100 / (1 + F.try_divide("_g", "_l"))).when(F.col("_g") > 0, 100.0)
    d = d.withColumn("rsi_14", F.when(F.col("_i") >= WILDER, rsi))
    columns = ["symbol", "time", "close", "volume", "sma_20", "sma_50", "sm_1", "sm_3", "sm_6", "rsi_14", "vol_20d_pct_126", "atr_14_w", "volume_ratio"]
    d = d.select(*columns, *[f"close_ahead_{n}" for n in ahead])
    if index_momentum_ is not None:
        d = d.join(index_momentum_.select("time", F.col("m_21d").alias("vnim_1"), F.col("m_60d").alias("vnim_3"), F.col("m_126d").alias("vnim_6")), "time")
    return d
