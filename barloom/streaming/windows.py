"""Momentum, moving averages and volumes of a stream of bars: the state of a symbol is a bounded run of its last rows.

Bars may come late within a delay. A bar waits in its symbol's state until the watermark has passed it, then its row is written
once, from the rows before it in order of time, as the batch indicators would. Beside the waiting bars a state holds KEEP
rows, whatever the length of the series.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from barloom.operators.indicators import SMA_DAYS, STOCK_LAGS

VOLUME_DAYS = (20, 60)
#: Rows before the current one that its values need.
KEEP = max(*STOCK_LAGS.values(), *SMA_DAYS, *VOLUME_DAYS)
COLUMNS = [*STOCK_LAGS, *[f"sma_{n}" for n in SMA_DAYS], *[f"vol_{n}d" for n in VOLUME_DAYS], "volume_ratio", "volume_spike"]
OUTPUT = "symbol string, time timestamp_ntz, " + ", ".join(f"{c} double" for c in COLUMNS)
STATE = "done long, at array<long>, close array<double>, volume array<double>"
DAY_MICROS = 86_400_000_000
EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def _lagged(x: np.ndarray, n: int) -> np.ndarray:
    return np.concatenate([np.full(min(n, len(x)), np.nan), x[: max(len(x) - n, 0)]])


def _mean_before(x: np.ndarray, n: int) -> np.ndarray:
    """Means of the n values before each one, NaN where one of them is missing."""
    out = np.full(len(x), np.nan)
    if len(x) > n:
        out[n:] = np.lib.stride_tricks.sliding_window_view(x[:-1], n).mean(axis=1)
    return out


def _divided(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.divide(a, b, out=np.full(len(a), np.nan), where=b != 0)


def values(close: np.ndarray, volume: np.ndarray) -> dict[str, np.ndarray]:
    """The values of each row of a series in order of time; NaN is a missing one, or a change from 0 to 0."""
    with np.errstate(divide="ignore", invalid="ignore"):
        out = {c: close / _lagged(close, n) - 1 for c, n in STOCK_LAGS.items()}
    out |= {f"sma_{n}": _mean_before(close, n) for n in SMA_DAYS}
    short, long = (_mean_before(volume, n) for n in VOLUME_DAYS)
    return out | {"vol_20d": short, "vol_60d": long, "volume_ratio": _divided(short, long), "volume_spike": _divided(volume, short)}


def _step(idle_micros: int):
    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        done, at, close, volume = 0, np.empty(0, np.int64), np.empty(0), np.empty(0)
        if state.exists:
            done, *kept = state.get
            at, close, volume = np.array(kept[0], np.int64), np.array(kept[1], float), np.array(kept[2], float)
        for b in batches:
            at = np.concatenate([at, b["_at"].to_numpy(np.int64)])
            close, volume = np.concatenate([close, b["close"].to_numpy(float)]), np.concatenate([volume, b["volume"].to_numpy(float)])
        order = np.argsort(at[done:], kind="stable") + done
        new = at[order]
        fresh = np.ones(len(new), bool)
        fresh[1:] = new[1:] != new[:-1]
        if done:
            fresh &= new > at[done - 1]
        order = np.concatenate([np.arange(done), order[fresh]])
        at, close, volume = at[order], close[order], volume[order]
        mark = state.getCurrentWatermarkMs() * 1000
        ready = max(done, int(np.searchsorted(at, mark, "left")))
        if ready > done:
            columns = values(close[:ready], volume[:ready])
            out = pd.DataFrame({"symbol": key[0], "time": at[done:ready].astype("datetime64[us]"), **{c: columns[c][done:] for c in COLUMNS}})
            yield out.astype({c: object for c in COLUMNS}).where(out.notna(), None)
        first = max(0, ready - KEEP)
        at, close, volume, done = at[first:], close[first:], volume[first:], ready - first
        if done == len(at) and (not done or at[-1] + idle_micros < mark):
            state.remove()
            return
        state.update((done, at.tolist(), close.tolist(), volume.tolist()))
        wake = at[done] if done < len(at) else at[-1] + idle_micros
        state.setTimeoutTimestamp(int(max(wake, mark) // 1000))

    return step


def rolling_stream(bars: DataFrame, delay_days: int = 3, idle_days: int = 800) -> DataFrame:
    """The rows of stock_momentum, stock_moving_average and stock_volume, each as soon as no bar can come before it.

    A row is written once the newest bar of the stream is more than `delay_days` younger (for the last bars of a source: where
    Spark runs a batch without data for it, as it does for files). Bars that come later than
    that are dropped, as are bars of a time that their symbol has already; those without a symbol or a time are in no series.
    Missing closes and volumes are rows with missing values, as in a batch. A symbol without a bar for `idle_days` is
    forgotten and begins anew.
    """
    if min(delay_days, idle_days) < 0:
        raise ValueError("days are counted from 0")
    b = bars.filter(F.col("symbol").isNotNull() & F.col("time").isNotNull())
    event = F.timestamp_seconds(F.lit(0)) + (F.col("time") - F.expr(EPOCH))  # the same in every time zone
    b = b.withColumn("_event", event).withWatermark("_event", f"{delay_days} days")
    b = b.select("symbol", "_event", F.unix_micros("_event").alias("_at"), F.col("close").cast("double"), F.col("volume").cast("double"))
    return b.groupBy("symbol").applyInPandasWithState(_step(idle_days * DAY_MICROS), OUTPUT, STATE, "append", GroupStateTimeout.EventTimeTimeout)
