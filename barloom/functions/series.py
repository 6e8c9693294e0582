"""Column expressions over ordered series.

A series is the rows of one key in order of time; the unit is the row (a trading session). NULL stands for a missing
value everywhere and a rolling value needs a full window of non-NULL inputs. Prices of 0 make changes infinite or NaN, which
are values: NaN is the greatest.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

#: Rows of one exponential block: 13/14 to this power is far below double precision, its inverse far from overflow.
EWM_BLOCK = 4000


def by_symbol() -> WindowSpec:
    return Window.partitionBy("symbol").orderBy("time")


def of_index() -> WindowSpec:
    """One series in one partition: an index has one row a session, a few thousand in all."""
    return Window.orderBy("time")


def truth(condition: Column) -> Column:
    """A comparison with a missing value is false."""
    return F.coalesce(condition, F.lit(False))


def roll(agg, x: Column, n: int, w: WindowSpec) -> Column:
    """`agg` over the last n rows, the current one included."""
    frame = w.rowsBetween(-(n - 1), 0)
    return F.when(F.count(x).over(frame) == n, agg(x).over(frame))


def roll_before(agg, x: Column, n: int, w: WindowSpec) -> Column:
    """`agg` over the n rows before the current one."""
    frame = w.rowsBetween(-n, -1)
    return F.when(F.count(x).over(frame) == n, agg(x).over(frame))


def divided(x: Column, y: Column) -> Column:
    """A quotient of prices, which may be 0: infinite by 0, NaN for 0 by 0, NULL only where one is missing."""
    return F.when(y == 0, x * F.lit(float("inf"))).otherwise(F.try_divide(x, y))


def log(x: Column) -> Column:
    """The logarithm, minus infinity at 0."""
    return F.when(x == 0, F.lit(float("-inf"))).otherwise(F.ln(x))


def change(x: Column, n: int, w: WindowSpec) -> Column:
    return divided(x, F.lag(x, n).over(w)) - 1


def crosses_above(x: Column, level: Column, w: WindowSpec) -> Column:
    return truth((x > level) & (F.lag(x).over(w) <= F.lag(level).over(w)))


def crosses_below(x: Column, level: Column, w: WindowSpec) -> Column:
    return truth((x < level) & (F.lag(x).over(w) >= F.lag(level).over(w)))


def held(condition: Column, k: int, w: WindowSpec) -> Column:
    """How many of the last k rows fulfil the condition; NULL before k rows."""
    return roll(F.sum, truth(condition).cast("int"), k, w)


def recent(condition: Column, k: int, w: WindowSpec) -> Column:
    """1 if one of the last k rows fulfils the condition; NULL before k rows."""
    return roll(F.max, truth(condition).cast("int"), k, w)


def clip(x: Column, low: Column | float, high: Column | float) -> Column:
    low, high = (v if isinstance(v, Column) else F.lit(float(v)) for v in (low, high))
    return F.when(x.isNotNull(), F.greatest(F.least(x, high), low))


def percentile_rank(x: Column, n: int, w: WindowSpec) -> Column:
    """Rank of the current value in its own window, ties averaged, as a share of the window: (0, 1].

    Give it values rounded beyond what rounding errors reach, or equal values may not tie.
    """
    values = F.collect_list(x).over(w.rowsBetween(-(n - 1), 0))  # leaves NULLs out
    below = F.size(F.filter(values, lambda v: v < x))
    equal = F.size(F.filter(values, lambda v: v == x))
    return F.when(x.isNotNull() & (F.size(values) == n), (below + (equal + 1) / 2) / n)


def streak(df: DataFrame, condition: str, name: str, key: list[str]) -> DataFrame:
    """Adds the length of the run of rows, up to the current one, in which the boolean column `condition` holds."""
    w = (Window.partitionBy(*key) if key else Window).orderBy("time")
    held_ = truth(F.col(condition))
    island = Window.partitionBy(*key, "_breaks").orderBy("time").rowsBetween(Window.unboundedPreceding, 0)
    df = df.withColumn("_breaks", F.sum((~held_).cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return df.withColumn(name, F.sum(held_.cast("int")).over(island).cast("long")).drop("_breaks")


def ewm(df: DataFrame, terms: dict[str, Column], seed: int, decay: float, key: list[str], row: str, block: int = EWM_BLOCK) -> DataFrame:
    """Exponential averages y[t] = decay * y[t-1] + x[t] from row `seed` on, for each output name and column of terms.

    The caller has weighted the terms (a seed row and those before it weigh as it likes; `row` counts rows from 0). The
    recursion is a running sum of x[i] / decay**i. Rows before the seed count as the seed. Powers are taken relative
    to blocks of rows, and a block starts from what the one before it ended with, so that series of any length stay
    within range: no recursion, no Python.
    """
    at = F.greatest(F.col(row) - seed, F.lit(0))
    df = df.withColumn("_block", F.floor(at / block)).withColumn("_in", at % block)
    inside = Window.partitionBy(*key, "_block").orderBy("time")
    so_far = inside.rowsBetween(Window.unboundedPreceding, 0)
    w = Window.partitionBy(*key).orderBy("_block", "time")  # the order that the sums need
    power = F.pow(F.lit(decay), F.col("_in"))
    for name, x in terms.items():
        df = df.withColumn(f"_{name}", F.sum(x / power).over(so_far) * power)
    for name in terms:
        df = df.withColumn(f"_{name}_before", F.lag(f"_{name}").over(w))
    for name in terms:
        carried = F.first(f"_{name}_before").over(so_far)
        df = df.withColumn(name, F.col(f"_{name}") + F.when(F.col("_block") > 0, F.coalesce(carried, F.lit(0.0)) * power * decay).otherwise(0.0))
    return df.drop("_block", "_in", *[f"_{n}" for n in terms], *[f"_{n}_before" for n in terms])
