"""Scans over series that need not fit one partition.

A series is the rows of one key in order of time; without a key it is the whole table. Nothing here brings a whole series
into one task:

1. `numbered`: rows are counted by month, counts are added up over the months, so each row learns its number.
2. `within_blocks`: blocks of equally many rows; window functions run inside a block. What they look back for is copied
   from the block before, so a block with its tail is all that a task sorts.
3. `running` and `affine`: scans that look back without bound. A block leaves one summary row (a total, a greatest value,
   an affine map); summaries are combined in order, and each block goes on from what the blocks before it add up to.
   Only summaries, one in `rows` rows, meet by key.

Rows whose key is NULL belong to no series and are left out.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from barloom.functions.series import ewm, truth

#: Rows of a block.
ROWS = 4096

Stage = Callable[[WindowSpec], dict[str, Column]]


def by_key(key: list[str]) -> WindowSpec:
    return Window.partitionBy(*key) if key else Window


def numbered(df: DataFrame, key: list[str]) -> DataFrame:
    """Adds _i, the number of each row of its series in order of time, from 0. Rows without a time come first."""
    month = F.coalesce(F.year("time") * 12 + F.month("time"), F.lit(-1))
    d = df.withColumn("_month", month)
    counts = d.groupBy(*key, "_month").agg(F.count("*").alias("_n"))
    earlier = by_key(key).orderBy("_month").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select(*key, "_month", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    inside = F.row_number().over(Window.partitionBy(*key, "_month").orderBy("time"))
    return d.withColumn("_i", inside.cast("long") - 1).join(before, [*key, "_month"]).withColumn("_i", F.col("_i") + F.col("_before")).drop("_month", "_before")


def blocks(df: DataFrame, key: list[str], rows: int, tail: int) -> DataFrame:
    """Rows with their number _i and each _block that needs them: their own, and the next for the last `tail` of a block."""
    if not 0 <= tail < rows:
        raise ValueError("windows reach back further than one block")
    own = F.floor(F.col("_i") / rows)
    needed = F.when(F.col("_i") % rows >= rows - tail, F.array(own, own + 1)).otherwise(F.array(own))
    return numbered(df, key).withColumn("_block", F.explode(needed))


def within_blocks(df: DataFrame, key: list[str], rows: int, tail: int, *stages: Stage) -> DataFrame:
    """Adds the columns of each stage, computed over the window that it is given: a block of `rows` rows behind the last
    `tail` rows of the block before. All stages together look back at most `tail` rows. Leaves _i and _block."""
    d = blocks(df, key, rows, tail)
    own = F.floor(F.col("_i") / rows)
    w = Window.partitionBy(*key, "_block").orderBy("_i")
    for stage in stages:
        d = d.withColumns(stage(w))
    return d.filter(F.col("_block") == own)


def _so_far(key: list[str]) -> WindowSpec:
    return Window.partitionBy(*key, "_block").orderBy("_i").rowsBetween(Window.unboundedPreceding, 0)


def running(df: DataFrame, key: list[str], name: str, agg: Callable, x: Column) -> DataFrame:
    """Adds `agg` (F.sum, F.max or F.min) of x over all rows up to the current one, to a frame of `within_blocks`."""
    d = df.withColumn("_x", x)
    totals = d.groupBy(*key, "_block").agg(agg("_x").alias("_total"))
    earlier = by_key(key).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    before = totals.select(*key, "_block", agg("_total").over(earlier).alias("_before"))
    d = d.withColumn("_x", agg("_x").over(_so_far(key))).join(before, [*key, "_block"])
    together = F.coalesce(F.col("_x") + F.col("_before"), "_x", "_before") if agg is F.sum else (F.greatest if agg is F.max else F.least)("_x", "_before")
    return d.withColumn(name, together).drop("_x", "_before")


def streak(df: DataFrame, key: list[str], name: str, condition: Column) -> DataFrame:
    """Adds the length of the run of rows, up to the current one, in which the condition holds."""
    d = running(df, key, "_broken", F.max, F.when(~truth(condition), F.col("_i")))
    return d.withColumn(name, (F.col("_i") - F.coalesce("_broken", F.lit(-1))).cast("long")).drop("_broken")


def affine(df: DataFrame, key: list[str], terms: dict[str, Column], decay: float, rows: int, seed: int = 0) -> DataFrame:
    """Adds, for each name and column x of terms, y[i] = decay * y[i-1] + x[i] from row `seed` on (y of the seed and of rows
    before it: the sum of x so far).

    Inside a block y is a running sum of x / decay**i. A block is the affine map y -> decay**rows * y + last, and
    the maps in order are such a recursion again, with one row a block.
    """
    if not 0 <= seed < rows or -rows * math.log10(decay) > 250:
        raise ValueError("blocks must hold the seed and keep powers of the decay within range")
    at = F.greatest(F.col("_i") - seed, F.lit(0)) - F.greatest(F.col("_block") * rows - seed, F.lit(0))
    power, step = F.pow(F.lit(decay), at), decay**rows
    d = df.withColumns({name: F.sum(x / power).over(_so_far(key)) * power for name, x in terms.items()})
    last = d.groupBy(*key, "_block").agg(*[F.max_by(name, "_i").alias(f"{name}_last") for name in terms]).withColumnRenamed("_block", "time")
    ends = ewm(last, {f"{name}_end": F.col(f"{name}_last") for name in terms}, 0, step, key, "time", max(1, int(-250 / math.log10(step))))
    before = ends.select(*key, F.col("time").alias("_block"), *[F.lag(f"{name}_end").over(by_key(key).orderBy("time")).alias(f"{name}_before") for name in terms])
    d = d.join(before, [*key, "_block"])
    return d.withColumns({name: F.col(name) + F.coalesce(F.col(f"{name}_before") * power * decay, F.lit(0.0)) for name in terms}).drop(*[f"{name}_before" for name in terms])
