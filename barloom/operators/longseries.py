"""The series operators for an index, or a symbol, whose rows one task should not hold: the results of their counterparts in
`indicators`, `decisions` and `backtest`, by the two-level scans of `functions.scan`."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from barloom.functions.scan import ROWS, affine, running, streak, within_blocks
from barloom.functions.series import divided, log, percentile_rank, roll
from barloom.operators.decisions import REGIME, safe
from barloom.operators.indicators import DECAY, INDEX_LAGS, TIE_DIGITS, VOLATILITY_DAYS, WILDER, YEAR, index_lags, log_return, regime_features, relative_strength, true_range

#: Rows that the features of the regime look back.
REGIME_TAIL = 150


def index_momentum(index: DataFrame, rows: int = ROWS) -> DataFrame:
    d = within_blocks(index.select("time", "close"), [], rows, max(INDEX_LAGS.values()), index_lags)
    return d.select("time", *INDEX_LAGS)


def regime_input(index: DataFrame, rows: int = ROWS) -> DataFrame:
    """The index with the four features of the regime, in blocks: _i and _block stay, for what scans them further."""
    return within_blocks(index.select("time", "close"), [], rows, REGIME_TAIL, lambda w: {"_r": log_return(w)}, regime_features).drop("_r")


def regime(index: DataFrame, rows: int = ROWS) -> DataFrame:
    """decisions.regime of the whole index."""
    d = streak(regime_input(index, rows), [], "_run", safe())
    thresholds = [F.lit(v).alias(f"{c}_threshold") for c, v in REGIME.items()]
    return d.select("time", *thresholds, F.when(safe(), "SAFE").otherwise("DEFENSIVE").alias("suggestion"), F.col("_run").alias("positive_streak"))


def stock_rsi(bars: DataFrame, rows: int = ROWS) -> DataFrame:
    """indicators.stock_rsi, with each symbol's series in blocks: a symbol with most of the rows is many tasks."""
    d = within_blocks(bars.select("symbol", "time", "close"), ["symbol"], rows, 1, lambda w: {"_d": F.col("close") - F.lag("close").over(w)})
    weight = F.when(F.col("_i") == 1, 1.0).otherwise(1.0 / WILDER)
    moves = {name: F.when(F.col("_d").isNotNull(), F.greatest(sign * F.col("_d"), F.lit(0.0))) * weight for name, sign in (("_g", 1.0), ("_l", -1.0))}
    return relative_strength(affine(d, ["symbol"], moves, DECAY, rows, 1))


def stock_volatility(bars: DataFrame, rows: int = ROWS) -> DataFrame:
    """indicators.stock_volatility in blocks: windows, percentile ranks and Wilder's average."""

    def first(w: WindowSpec) -> dict[str, Column]:
        return {"_r": log_return(w), "_tr": true_range(w), "_hl": F.pow(log(divided(F.col("high"), F.col("low"))), 2)}

    def second(w: WindowSpec) -> dict[str, Column]:
        year = F.sqrt(F.lit(float(YEAR)))
        spread = {f"vol_{n}d": roll(F.stddev_samp, F.col("_r"), n, w) * year for n in VOLATILITY_DAYS}
        return spread | {"atr_14_r": roll(F.avg, F.col("_tr"), WILDER, w), "parkinson_20d": F.sqrt(roll(F.sum, F.col("_hl"), 20, w) / (F.lit(80.0) * F.ln(F.lit(2.0)))) * year}

    def third(w: WindowSpec) -> dict[str, Column]:
        return {f"vol_20d_pct_{n}": percentile_rank(F.round("vol_20d", TIE_DIGITS), n, w) for n in (126, 252)}

    d = within_blocks(bars.select("symbol", "time", "high", "low", "close"), ["symbol"], rows, 1 + 20 + max(VOLATILITY_DAYS), first, second, third)
    d = affine(d, ["symbol"], {"_atr": F.col("_tr") / WILDER}, DECAY, rows, WILDER - 1)
    ranks = [f"vol_20d_pct_{n}" for n in (126, 252)]
    return d.select("symbol", "time", *[f"vol_{n}d" for n in VOLATILITY_DAYS], "atr_14_r", F.when(F.col("_i") >= WILDER - 1, F.col("_atr")).alias("atr_14_w"), "parkinson_20d", *ranks)


def spread_equity(spread: DataFrame, rows: int = ROWS) -> DataFrame:
    """backtest.spread_equity: a running sum of logarithms and a running mark of a total loss, by blocks."""
    f = 1 + F.col("spread")
    d = within_blocks(spread.select("time", "spread"), [], rows, 0)
    d = running(d, [], "_lost", F.max, (f <= 0).cast("int"))
    d = running(d, [], "_log", F.sum, F.ln(F.when(f > 0, f)))
    return d.select("time", "spread", F.when(F.col("_lost") == 1, 0.0).otherwise(F.exp("_log")).alias("cum_spread"))


def newey_west(series: DataFrame, value: str = "ic", lags: int = 20, rows: int = ROWS) -> DataFrame:
    """backtest.newey_west: products with the rows up to `lags` before are summed in each block, and then together."""
    d = series.filter(F.col(value).isNotNull()).select("time", F.col(value).alias("_x"))
    whole = d.agg(F.avg("_x").alias("mean"), F.count("*").alias("n"))
    centred = d.crossJoin(F.broadcast(whole)).select("time", (F.col("_x") - F.col("mean")).alias("_e"))  # one row
    e = within_blocks(centred, [], rows, lags, lambda w: {f"_e{k}": F.col("_e") * F.lag("_e", k).over(w) for k in range(1, lags + 1)})
    sums = e.agg(F.sum(F.col("_e") * F.col("_e")).alias("g0"), *[F.coalesce(F.sum(f"_e{k}"), F.lit(0.0)).alias(f"g{k}") for k in range(1, lags + 1)])
    s = sum(((2 * (1 - k / (lags + 1))) * F.col(f"g{k}") for k in range(1, lags + 1)), F.col("g0")) / F.nullif("n", F.lit(0))
    return whole.crossJoin(F.broadcast(sums)).select("mean", "n", F.try_divide(F.col("mean"), F.sqrt(F.when(s >= 0, s) / F.col("n"))).alias("tstat"))
