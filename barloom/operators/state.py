"""Incremental steps from stored state, and table replacement as pure transforms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.functions.series import truth
from barloom.operators.asof import as_of
from barloom.operators.indicators import WILDER

MODES = ("backfill", "incremental")


def check_mode(mode: str) -> str:
    if mode not in MODES:
        raise ValueError(f"mode is one of {MODES}")
    return mode


def until(df: DataFrame, date: str) -> DataFrame:
    """Rows up to the end of a day."""
    return df.filter(F.col("time") < F.to_date(F.lit(date)) + F.expr("INTERVAL 1 DAY"))


def last_n(df: DataFrame, n: int, date: str | None = None, key: str | None = "symbol") -> DataFrame:
    """The last n rows of each series up to a day; a group limit keeps the sort from carrying more than n rows."""
    d = df if date is None else until(df, date)
    w = (Window.partitionBy(key) if key else Window).orderBy(F.col("time").desc())
    return d.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")


def latest(df: DataFrame, date: str | None = None, key: str | None = "symbol") -> DataFrame:
    return last_n(df, 1, date, key)


def incremental(compute, df: DataFrame, rows: int, date: str, key: str | None = "symbol") -> DataFrame:
    """The backfill expression on the last `rows` rows only, and of its result the last row: one row a series."""
    return latest(compute(last_n(df, rows, date, key)), key=key)


def state_before(state: DataFrame, bars: DataFrame, key: str = "symbol") -> DataFrame:
    """For each new bar its key, time and the stored row strictly before it as prev_<column>, so that a second run of a step
    gives the same result. A batch may hold several bars of a series; bars with no stored row before them are left out."""
    return as_of(bars.select(key, "time"), state, key).filter(F.col("prev_time").isNotNull())


def _last_two(bars: DataFrame, date: str) -> DataFrame:
    w = Window.partitionBy("symbol").orderBy("time")
    return latest(last_n(bars, 2, date).withColumn("prev_close", F.lag("close").over(w)))


def rsi_step(state: DataFrame, bars: DataFrame, date: str) -> DataFrame:
    """One Wilder step of the averages of gains and losses; state: symbol, time, average_gain_14, average_loss_14."""
    new = _last_two(bars, date).select("symbol", "time", (F.col("close") - F.col("prev_close")).alias("_d"))
    d = new.join(state_before(state.select("symbol", "time", "average_gain_14", "average_loss_14"), new), ["symbol", "time"])

    def step(before: str, x: Column) -> Column:
        return (F.col(before) * (WILDER - 1) + F.when(F.col("_d").isNotNull(), F.greatest(x, F.lit(0.0)))) / WILDER

    d = d.select("symbol", "time", step("prev_average_gain_14", F.col("_d")).alias("g"), step("prev_average_loss_14", -F.col("_d")).alias("l"))
    rsi = F.when(F.col("l") > 0, 100 - 100 / (1 + F.try_divide("g", "l"))).when(F.col("g") > 0, 100.0)
    return d.select("symbol", "time", rsi.alias("rsi_14"), F.col("g").alias("average_gain_14"), F.col("l").alias("average_loss_14"))


def atr_step(state: DataFrame, bars: DataFrame, date: str) -> DataFrame:
    """One Wilder step of the true range; state: symbol, time, atr_14_w."""
    tr = F.greatest(F.col("high") - F.col("low"), F.abs(F.col("high") - F.col("prev_close")), F.abs(F.col("low") - F.col("prev_close")))
    new = _last_two(bars, date).select("symbol", "time", tr.alias("_tr"))
    d = new.join(state_before(state.select("symbol", "time", "atr_14_w"), new), ["symbol", "time"])
    return d.select("symbol", "time", ((F.col("prev_atr_14_w") * (WILDER - 1) + F.col("_tr")) / WILDER).alias("atr_14_w"))


def streak_step(previous: Column, condition: Column) -> Column:
    return F.when(truth(condition), F.coalesce(previous, F.lit(0)) + 1).otherwise(0).cast("long")


def decision_step(state: DataFrame, row: DataFrame, condition: Column, key: str | None, good: str, bad: str) -> DataFrame:
    """The decision on the newest row and its streak, from the stored streak strictly before it."""
    k = key or "_one"
    row, state = (d if key else d.withColumn("_one", F.lit(1)) for d in (row, state))
    d = row.join(state_before(state.select(k, "time", "positive_streak"), row, k), [k, "time"], "left")
    keys = [key, "time"] if key else ["time"]
    return d.select(*keys, F.when(truth(condition), good).otherwise(bad).alias("suggestion"), streak_step(F.col("prev_positive_streak"), condition).alias("positive_streak"))


def checked_keys(new: DataFrame, keys: list[str]) -> DataFrame:
    """`new`, which raises an error when it is read if it holds a key twice."""
    checked = new.withColumn("_n", F.count("*").over(Window.partitionBy(*keys)))
    message = F.lit("duplicate key in the incoming batch")
    return checked.withColumn("_n", F.when(F.col("_n") > 1, F.raise_error(message).cast("long")).otherwise(F.col("_n"))).filter(F.col("_n") == 1).drop("_n")


def upsert(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of `new`, and those of `old` whose key is not among them. A key twice in `new` is an error."""
    checked = checked_keys(new, keys)
    return old.join(new.select(*keys), keys, "left_anti").select(*old.columns).unionByName(checked.select(*old.columns))


def scoped_replace(old: DataFrame, new: DataFrame, scope: Column) -> DataFrame:
    """`new`, and the rows of `old` outside the scope (a NULL scope counts as outside)."""
    return old.filter(~truth(scope)).unionByName(new.select(*old.columns))


def range_scope(start: str, end: str | None = None) -> Column:
    """Sessions between two days, or of one."""
    return F.col("time").between(session(start), session(end or start))


def session(date: str) -> Column:
    """A day's session is stamped 07:00."""
    return F.to_date(F.lit(date)).cast("timestamp_ntz") + F.expr("INTERVAL 7 HOURS")


def date_sequence(df: DataFrame) -> DataFrame:
    """The sessions of all days from the first to the last session of a table, both included."""
    ends = df.agg(F.to_date(F.min("time")).alias("a"), F.to_date(F.max("time")).alias("b"))
    days = F.sequence("a", "b", F.expr("INTERVAL 1 DAY"))
    return ends.select(F.explode(days).alias("_d")).select((F.col("_d").cast("timestamp_ntz") + F.expr("INTERVAL 7 HOURS")).alias("time"))


def difference(a: DataFrame, b: DataFrame, on: str) -> DataFrame:
    """Rows of `a` whose value is not in `b`; repeated rows stay."""
    return a.join(b.select(on).distinct(), on, "left_anti")
