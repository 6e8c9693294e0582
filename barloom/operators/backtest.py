"""Evaluation of a ranking: forward returns, information coefficients, long-short spread, quintiles and decay."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.functions.series import by_symbol, clip

#: Fixed values. The return column keeps its name although the horizon is 7 sessions.
HORIZON = 7
DECAY_HORIZONS = tuple(range(5, 65, 5))
TOP_SHARE = 0.46
LIMIT = 0.5
MIN_IC, MIN_SPREAD, MIN_QUINTILE = 5, 6, 10


def forward_returns(bars: DataFrame, symbols: DataFrame | None = None, start: str | None = None, end: str | None = None, horizon: int = HORIZON) -> DataFrame:
    """symbol, time, close, close_20 (the close `horizon` sessions on), of the symbols given, between two dates.

    The dates are filtered after looking ahead, so the last sessions of the range still see what follows it.
    """
    d = bars if symbols is None else bars.join(symbols.select("symbol").distinct(), "symbol", "left_semi")
    d = d.select("symbol", "time", "close", F.lead("close", horizon).over(by_symbol()).alias("close_20"))
    if start is not None:
        d = d.filter(F.col("time") >= F.lit(start).cast("timestamp_ntz"))
    if end is not None:
        d = d.filter(F.col("time") <= F.lit(end).cast("timestamp_ntz"))
    return d


def scored_returns(ranking: DataFrame, horizon: int = HORIZON) -> DataFrame:
    """time, symbol, alpha_score and the clipped forward return, where both exist, of a ranking that has kept close and
    close_ahead_<horizon> of its features: the bars are not read again."""
    d = ranking.withColumn("_r", F.try_divide(f"close_ahead_{horizon}", "close") - 1).na.drop(subset=["alpha_score", "_r"])
    return d.select("time", "symbol", "alpha_score", clip(F.col("_r"), -LIMIT, LIMIT).alias("fwd_return_20d"))


def doubled_rank(x: str, keys: list[str]) -> Column:
    """Twice the average rank: a whole number."""
    return (2 * F.rank().over(Window.partitionBy(*keys).orderBy(x)) + F.count("*").over(Window.partitionBy(*keys, x)) - 1).cast("long")


def spearman(d: DataFrame, keys: list[str], x: str, y: str, least: int = MIN_IC) -> DataFrame:
    """ic and n for each group: Pearson's correlation of average ranks; NULL below `least` rows or without spread.

    Sums of whole numbers are exact, so a value of zero is zero in any engine and any order.
    """
    d = d.select(*keys, doubled_rank(x, keys).alias("_x"), doubled_rank(y, keys).alias("_y"))
    a, b, n = F.col("_x"), F.col("_y"), F.count("*")
    d = d.groupBy(*keys).agg(
        n.alias("n"),
        (n * F.sum(a * b) - F.sum(a) * F.sum(b)).cast("double").alias("_c"),
        (n * F.sum(a * a) - F.sum(a) * F.sum(a)).cast("double").alias("_sx"),
        (n * F.sum(b * b) - F.sum(b) * F.sum(b)).cast("double").alias("_sy"),
    )
    return d.select(*keys, F.when(F.col("n") >= least, F.try_divide("_c", F.sqrt("_sx") * F.sqrt("_sy"))).alias("ic"), "n")


def ic_daily(scored: DataFrame) -> DataFrame:
    return spearman(scored, ["time"], "alpha_score", "fwd_return_20d")


def ic_summary(ic: DataFrame) -> DataFrame:
    """Mean, deviation, naive t (over all sessions, those without a value included) and share of positive values."""
    d = ic.agg(F.avg("ic").alias("ic_mean"), F.stddev_samp("ic").alias("ic_std"), F.count("*").alias("n_days"), F.avg(F.coalesce(F.col("ic") > 0, F.lit(False)).cast("int")).alias("positive_share"))
    t = F.try_divide("ic_mean", F.try_divide("ic_std", F.sqrt("n_days")))
    return d.select("ic_mean", "ic_std", "n_days", t.alias("ic_tstat"), "positive_share")


def newey_west(series: DataFrame, value: str = "ic", lags: int = 20) -> DataFrame:
    """Mean and heteroscedasticity and autocorrelation consistent t-value of one series in order of time.

    The autocovariances come from one pass with `lags` look-backs: no self-join. One row a session, one partition.
    """
    w = Window.orderBy("time")
    every = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    d = series.filter(F.col(value).isNotNull()).select("time", F.col(value).alias("_x"))
    e = d.select("time", F.avg("_x").over(every).alias("_mean"), F.count("*").over(every).alias("_n"), "_x")
    e = e.withColumn("_e", F.col("_x") - F.col("_mean"))
    e = e.select("_mean", "_n", "_e", *[(F.col("_e") * F.lag("_e", k).over(w)).alias(f"_e{k}") for k in range(1, lags + 1)])
    sums = e.agg(F.first("_mean").alias("mean"), F.coalesce(F.first("_n"), F.lit(0)).alias("n"), F.sum(F.col("_e") * F.col("_e")).alias("g0"), *[F.coalesce(F.sum(f"_e{k}"), F.lit(0.0)).alias(f"g{k}") for k in range(1, lags + 1)])
    s = sum(((2 * (1 - k / (lags + 1))) * F.col(f"g{k}") for k in range(1, lags + 1)), F.col("g0")) / F.nullif("n", F.lit(0))
    return sums.select("mean", "n", F.try_divide(F.col("mean"), F.sqrt(F.when(s >= 0, s) / F.col("n"))).alias("tstat"))


def spread_daily(scored: DataFrame, share: float = TOP_SHARE) -> DataFrame:
    """Mean return of the best and the worst k symbols of each session of at least 6, and the difference."""
    day = Window.partitionBy("time")
    d = scored.withColumn("_n", F.count("*").over(day)).withColumn("_rn", F.row_number().over(day.orderBy(F.col("alpha_score").desc(), "symbol")))
    d = d.filter(F.col("_n") >= MIN_SPREAD).withColumn("_k", F.greatest(F.lit(1), F.floor(F.col("_n") * share)))
    r = F.col("fwd_return_20d")
    d = d.groupBy("time").agg(
        F.avg(F.when(F.col("_rn") <= F.col("_k"), r)).alias("top_return"),
        F.avg(F.when(F.col("_rn") > F.col("_n") - F.col("_k"), r)).alias("bottom_return"),
        F.first("_k").cast("long").alias("top_n"),
        F.first("_n").cast("long").alias("universe_size"),
    )
    return d.select("time", "top_return", "bottom_return", (F.col("top_return") - F.col("bottom_return")).alias("spread"), "top_n", "universe_size")


def spread_summary(spread: DataFrame) -> DataFrame:
    d = spread.agg(
        F.avg("spread").alias("spread_mean"),
        F.stddev_samp("spread").alias("spread_std"),
        F.count("*").alias("n_days"),
        F.avg((F.col("spread") > 0).cast("int")).alias("positive_share"),
        F.avg("top_return").alias("mean_top_return"),
        F.avg("bottom_return").alias("mean_bottom_return"),
        F.avg("universe_size").alias("mean_universe_size"),
        F.avg("top_n").alias("mean_top_n"),
    )
    return d.withColumn("spread_tstat", F.try_divide("spread_mean", F.try_divide("spread_std", F.sqrt("n_days"))))


def spread_equity(spread: DataFrame) -> DataFrame:
    """The compounded spread: a running product through logarithms; from a factor of 0 on it stays 0."""
    w = Window.orderBy("time").rowsBetween(Window.unboundedPreceding, 0)
    f = 1 + F.col("spread")
    lost = F.max((f <= 0).cast("int")).over(w)
    return spread.select("time", "spread", F.when(lost == 1, 0.0).otherwise(F.exp(F.sum(F.ln(F.when(f > 0, f))).over(w))).alias("cum_spread"))


def quintiles(scored: DataFrame) -> DataFrame:
    """Adds the quintile by value edges, right-closed, of sessions of at least 10; sessions with equal edges are left out."""
    day = Window.partitionBy("time")
    q = F.percentile("alpha_score", F.array(*[F.lit(k / 5) for k in range(6)])).over(day)
    d = scored.withColumn("_n", F.count("*").over(day)).withColumn("_q", q).filter(F.col("_n") >= MIN_QUINTILE)
    d = d.filter(F.size(F.array_distinct("_q")) == 6)
    above = sum(((F.col("alpha_score") > F.col("_q")[k]).cast("int") for k in range(1, 5)), F.lit(1))
    return d.select("time", "symbol", "alpha_score", "fwd_return_20d", above.cast("long").alias("quintile"))


def quintile_returns(scored: DataFrame) -> DataFrame:
    daily = quintiles(scored).groupBy("time", "quintile").agg(F.avg("fwd_return_20d").alias("r"))
    return daily.groupBy("quintile").agg(F.avg("r").alias("mean_return"), F.count("*").alias("n_days"))


def factor_decay(ranking: DataFrame, horizons: tuple[int, ...] = DECAY_HORIZONS) -> DataFrame:
    """Mean information coefficient at each horizon, over rows that have all of the returns; the ranking has kept close and
    close_ahead_<horizon> for each of them."""
    d = ranking.select("time", "alpha_score", *[(F.try_divide(f"close_ahead_{h}", "close") - 1).alias(f"r{h}") for h in horizons])
    d = d.na.drop(subset=["alpha_score", *[f"r{h}" for h in horizons]])
    long = d.select("time", "alpha_score", F.explode(F.array(*[F.struct(F.lit(h).cast("long").alias("horizon"), clip(F.col(f"r{h}"), -LIMIT, LIMIT).alias("r")) for h in horizons])).alias("x")).select("time", "alpha_score", "x.*")
    return spearman(long, ["time", "horizon"], "alpha_score", "r").groupBy("horizon").agg(F.avg("ic").alias("mean_ic"), F.count("ic").alias("n_days"))
