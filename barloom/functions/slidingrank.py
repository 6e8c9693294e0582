"""Percentile ranks of each row's value among the last n rows, without an array of n values a row.

Series are cut into blocks behind a tail of n - 1 rows, as `scan` cuts them, so a hot symbol is many tasks. A block is an
array: pieces of it are sorted once, every row whose window holds a whole piece counts by binary search in it, and only
the ends of the window, shorter than a piece each, are compared one by one.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.functions.scan import ROWS, blocks


def ranks(x: np.ndarray, n: int) -> np.ndarray:
    """The rank of x[i] among x[i-n+1 .. i], ties averaged, as a share of n; NaN where the window is short or holds a NaN."""
    m, piece = len(x), max(1, math.isqrt(n))
    below, upto = np.zeros(m, np.int64), np.zeros(m, np.int64)
    for at in range(0, m - piece + 1, piece):
        whole = slice(at + piece - 1, min(m, at + n))  # rows whose window holds x[at .. at + piece - 1]
        if whole.start < whole.stop:
            values = np.sort(x[at : at + piece])
            below[whole] += np.searchsorted(values, x[whole], "left")
            upto[whole] += np.searchsorted(values, x[whole], "right")
    i = np.arange(m)
    first = i - n + 1
    from_piece, to_piece = -(-first // piece) * piece, (i + 1) // piece * piece  # whole pieces of the window lie between
    for k in range(piece):
        for place, inside in ((first + k, first + k < from_piece), (i - k, (i - k >= to_piece) & (i - k >= from_piece))):
            held = inside & (place >= 0)
            other = x[np.where(held, place, 0)]
            below += held & (other < x)
            upto += held & (other <= x)
    missing = np.concatenate([[0], np.cumsum(np.isnan(x))])
    full = (first >= 0) & (missing[i + 1] - missing[np.maximum(first, 0)] == 0)
    return np.where(full, (below + (upto - below + 1) / 2) / n, np.nan)


def percentile_ranks(df: DataFrame, key: list[str], value: Column, names: dict[str, int], rows: int = ROWS) -> DataFrame:
    """key, time and, for each name and n, `series.percentile_rank` of the value over n rows.

    NULL where the window is not full or holds a NULL. A NaN is the greatest value. Rows without a key belong to no series.
    """
    tail = max(names.values()) - 1
    times = df.schema["time"].dataType
    d = blocks(df.select(*key, "time", value.cast("double").alias("_x")), key, rows, tail)
    own = f"{', '.join(f'`{k}` {df.schema[k].dataType.simpleString()}' for k in key)}{', ' if key else ''}time {times.simpleString()}, {', '.join(f'`{c}` double' for c in names)}"

    def ranked(given: pa.Table) -> pa.Table:
        given = given.sort_by("_i")
        at, block = given["_i"].to_numpy(), given["_block"][0].as_py()
        x = given["_x"].to_numpy(zero_copy_only=False).astype(float)
        missing = given["_x"].is_null().to_numpy()
        if (np.isnan(x) & ~missing).any():  # places in the order of the values, in which NaN comes last
            x = np.where(missing, np.nan, np.unique(x, return_inverse=True)[1])
        mine = pa.array(at // rows == block)
        found = {c: pa.array(ranks(x, n), from_pandas=True) for c, n in names.items()}
        return pa.table({**{k: given[k] for k in (*key, "time")}, **found}).filter(mine)

    return d.groupBy(*key, "_block").applyInArrow(ranked, own)
