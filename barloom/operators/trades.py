"""Rule-based trade simulation: entry and exit signals of a strategy, and matching of entries with exits."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barloom.functions.series import by_symbol, crosses_above, crosses_below, held, recent, roll, truth

c = F.col
MIN_HOLD = 15


def _bsr(d: DataFrame) -> DataFrame:
    """Entry at an RSI over 55 in 50 .. 60 after momentum, RSI and price turned up; exit over 85."""
    w, zero = by_symbol(), F.lit(0.0)
    d = d.select("*", crosses_above(c("rsi_14"), F.lit(55.0), w).alias("_rsi"), crosses_above(c("sm_1"), zero, w).alias("_m1"), crosses_above(c("close"), c("sma_20"), w).alias("_price"))
    over, above = c("rsi_14") > 55, c("close") > c("sma_20")
    expand = truth(roll(F.avg, c("atr_14_w"), 5, w) > 0)
    parts = [recent(c("_m1"), 5, w), recent(c("_rsi"), 5, w), recent(c("_price"), 5, w)]
    entry = (
        truth((parts[0] == 1) & (parts[1] == 1) & (parts[2] == 1))
        & expand
        & truth(held(over, 3, w) >= 2)
        & truth(c("rsi_14").between(50, 60))
        & truth(held(c("sm_1") > 0, 3, w) >= 2)
        & truth(held(above, 3, w) >= 2)
        & truth(c("vol_20d_pct_126").between(0.3, 0.8))
        & truth((recent(c("_m1"), 6, w) == 1) & (recent(c("_rsi"), 3, w) == 1))
    )
    high = c("rsi_14") > 85
    exits = truth((recent(high, 3, w) == 1) & (recent(above, 3, w) == 1) & (held(high, 3, w) == 3) & (held(above, 3, w) == 3))
    return d.select("*", (sum(parts[1:], parts[0]) + expand.cast("int")).cast("long").alias("score"), entry.alias("up"), exits.alias("down")).drop("_rsi", "_m1", "_price")


def _pvd(d: DataFrame) -> DataFrame:
    """Entry on three calm sessions of a rising trend; exit on an RSI over 70 or falling under 50."""
    w = by_symbol()
    entry = (
        truth(roll(F.avg, c("atr_14_w"), 3, w) > 0)
        & truth(held(c("rsi_14").between(50, 60), 3, w) == 3)
        & truth(held(c("close") > c("sma_20"), 3, w) >= 3)
        & truth(held(c("sma_20") > c("sma_50"), 3, w) >= 3)
        & truth(held(c("sm_1") > 0, 3, w) >= 3)
        & truth(held(c("sm_3") > 0, 3, w) >= 3)
        & truth(held(c("vnim_1") > 0, 5, w) == 5)
    )
    d = d.select("*", crosses_above(c("rsi_14"), F.lit(70.0), w).alias("_max"), crosses_below(c("rsi_14"), F.lit(50.0), w).alias("_min"))
    exits = truth((recent(c("_max"), 2, w) == 1) & (held(c("rsi_14") > 70, 2, w) == 2)) | c("_min")
    return d.select("*", F.lit(None).cast("long").alias("score"), entry.alias("up"), exits.alias("down")).drop("_max", "_min")


STRATEGIES = {"bsr": _bsr, "pvd": _pvd}


def signals(features: DataFrame, strategy: str, start: str | None = None) -> DataFrame:
    """`features` from `start` on (windows begin there) with score, up (an entry) and down (an exit)."""
    if strategy not in STRATEGIES:
        raise ValueError(f"strategy is one of {sorted(STRATEGIES)}")
    if start is not None:
        features = features.filter(c("time") >= F.lit(start).cast("timestamp_ntz"))
    return STRATEGIES[strategy](features)


def trades(signalled: DataFrame, min_hold: int = MIN_HOLD) -> DataFrame:
    """Each entry with the first exit at least `min_hold` rows on; entries without one are left out.

    min_hold=1 is the older matcher: the first exit strictly after the entry. Several entries may share an exit.
    """
    w = by_symbol()
    # read backwards: a frame that grows by a row a step, where one that shrinks would be worked out anew for each row
    back = Window.partitionBy("symbol").orderBy(c("time").desc()).rowsBetween(Window.unboundedPreceding, -min_hold)
    d = signalled.withColumn("_i", F.row_number().over(w))
    out = F.last(F.when(c("down"), F.struct(c("_i").alias("i"), c("time").alias("time"), c("close").alias("close"))), ignorenulls=True).over(back)
    d = d.withColumn("_exit", out).filter(c("up") & c("_exit").isNotNull())
    return d.select(
        "symbol",
        c("time").alias("entry_time"),
        c("_exit.time").alias("exit_time"),
        c("close").alias("entry_price"),
        c("_exit.close").alias("exit_price"),
        (F.try_divide(c("_exit.close"), c("close")) - 1).alias("return"),
        (c("_exit.i") - c("_i")).cast("long").alias("holding_days"),
    )
