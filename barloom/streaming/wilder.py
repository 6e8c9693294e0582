"""Relative strength of a stream of bars: one keyed state a symbol, one row out for each new bar."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from barloom.operators.indicators import WILDER

OUTPUT = "symbol string, time timestamp_ntz, rsi_14 double, average_gain_14 double, average_loss_14 double"
STATE = "last timestamp_ntz, close double, n long, gain double, loss double"


def _step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    last, close, n, gain, loss = state.get if state.exists else (None, None, 0, 0.0, 0.0)
    bars = pd.concat(list(batches)).sort_values("time")
    rows = []
    for time, new in zip(bars["time"], bars["close"], strict=True):
        if last is not None and time <= last:
            continue  # a bar that was seen, or comes too late: the state has moved on
        if n:
            d, share = new - close, 1.0 if n == 1 else 1.0 / WILDER
            gain = max(d, 0.0) if n == 1 else gain * (1 - share) + max(d, 0.0) * share
            loss = max(-d, 0.0) if n == 1 else loss * (1 - share) + max(-d, 0.0) * share
        last, close, n = time, float(new), n + 1
        ready = n > WILDER
        rsi = 100 - 100 / (1 + gain / loss) if loss > 0 else 100.0 if gain > 0 else None
        rows.append((key[0], time, rsi if ready else None, gain if ready else None, loss if ready else None))
    if last is not None:
        state.update((last, close, n, gain, loss))
    yield pd.DataFrame(rows, columns=["symbol", "time", "rsi_14", "average_gain_14", "average_loss_14"])


def stock_rsi_stream(bars: DataFrame) -> DataFrame:
    """The rows that indicators.stock_rsi gives, as bars arrive; NULL closes are left out before."""
    clean = bars.select("symbol", "time", "close").na.drop()
    return clean.groupBy("symbol").applyInPandasWithState(_step, OUTPUT, STATE, "append", GroupStateTimeout.NoTimeout)
