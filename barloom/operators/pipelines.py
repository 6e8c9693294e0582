"""Pipelines over stored tables: compute a universe's rows from its bars, all of them (backfill) or those after what is stored
(incremental), and commit them.

A step takes any number of new sessions at once, and each symbol goes on from its own last stored row; a symbol that is not
stored yet is computed from its first bar. A pipeline whose result looks back a fixed number of rows reads so many rows
before the new ones; one that is a recursion goes on from the stored averages, found as of each symbol's last row.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from concurrent.futures import FIRST_EXCEPTION, ThreadPoolExecutor, wait
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barloom.functions.series import by_symbol, ewm, truth
from barloom.operators import decisions, indicators
from barloom.operators.indicators import DECAY, WILDER
from barloom.operators.state import check_mode, difference, until
from barloom.sources.commits import CommittedTable, Version

Step = Callable[[DataFrame, DataFrame], DataFrame]


@dataclass(frozen=True)
class Pipeline:
    """`backfill` of bars, and `step` of (stored rows, bars): the rows that follow the stored ones."""

    backfill: Callable[[DataFrame], DataFrame]
    step: Step


def last_stored(stored: DataFrame, *columns: str) -> DataFrame:
    """(symbol, _since, columns): each symbol's last stored row."""
    last = stored.groupBy("symbol").agg(F.max_by(F.struct("time", *columns), "time").alias("_s"))
    return last.select("symbol", F.col("_s.time").alias("_since"), *[F.col(f"_s.{c}").alias(f"prev_{c}") for c in columns])


def is_new() -> Column:
    return F.col("_since").isNull() | (F.col("time") > F.col("_since"))


def windowed(compute: Callable[[DataFrame], DataFrame], rows: int) -> Pipeline:
    """A result that looks back at most `rows` rows."""

    def step(stored: DataFrame, bars: DataFrame) -> DataFrame:
        since = last_stored(stored)
        d = bars.join(since, "symbol", "left")
        newest = Window.partitionBy("symbol").orderBy(F.col("time").desc())
        n_new = F.sum(is_new().cast("long")).over(Window.partitionBy("symbol"))
        d = d.withColumn("_rn", F.row_number().over(newest)).withColumn("_new", n_new).filter((F.col("_new") > 0) & (F.col("_rn") <= F.col("_new") + rows))
        out = compute(d.select(*bars.columns))
        return out.join(since, "symbol", "left").filter(is_new()).select(*out.columns)

    return Pipeline(compute, step)


def _resumed(stored: DataFrame, bars: DataFrame, averages: tuple[str, ...]) -> DataFrame:
    """The bars from each symbol's last stored row on, with the averages of that row; all bars where there are none yet. _i
    counts rows as the recursion needs it: the stored row stands where its seed would."""
    usable = last_stored(stored.filter(F.col(averages[0]).isNotNull()), *averages)
    d = bars.join(usable, "symbol", "left").filter(F.col("_since").isNull() | (F.col("time") >= F.col("_since")))
    return d.withColumn("_i", F.row_number().over(by_symbol()) - 1)


def _after(d: DataFrame, stored: DataFrame) -> DataFrame:
    """Rows after the last one stored, with averages or without."""
    since = stored.groupBy("symbol").agg(F.max("time").alias("_last"))
    return d.join(since, "symbol", "left").filter(F.col("_last").isNull() | (F.col("time") > F.col("_last"))).drop("_last")


def rsi_steps(stored: DataFrame, bars: DataFrame) -> DataFrame:
    """The rows of indicators.stock_rsi after the stored ones, from the stored averages of gains and losses."""
    d = _resumed(stored, bars.select("symbol", "time", "close"), ("average_gain_14", "average_loss_14"))
    resumed, seed = F.col("_since").isNotNull(), F.col("_i") == 0
    d = d.withColumn("_d", F.col("close") - F.lag("close").over(by_symbol())).withColumn("_at", F.when(resumed, F.col("_i") + 1).otherwise(F.col("_i")))
    terms = {}
    for name, before, sign in (("_g", "prev_average_gain_14", 1.0), ("_l", "prev_average_loss_14", -1.0)):
        move = F.when(F.col("_d").isNotNull(), F.greatest(sign * F.col("_d"), F.lit(0.0)))
        weight = F.when(~resumed & (F.col("_i") == 1), 1.0).otherwise(1.0 / WILDER)
        terms[name] = F.when(resumed & seed, F.col(before)).otherwise(move * weight)
    d = ewm(d, terms, 1, DECAY, ["symbol"], "_at").withColumn("_i", F.when(resumed, F.col("_i") + WILDER).otherwise(F.col("_i")))
    kept = _after(d, stored)
    return indicators.relative_strength(kept)


def atr_steps(stored: DataFrame, bars: DataFrame) -> DataFrame:
    """(symbol, time, atr_14_w) after the stored rows, from the stored Wilder average of true ranges."""
    d = _resumed(stored, bars.select("symbol", "time", "high", "low", "close"), ("atr_14_w",))
    resumed, first = F.col("_since").isNotNull(), WILDER - 1
    d = d.withColumn("_tr", indicators.true_range(by_symbol())).withColumn("_at", F.when(resumed, F.col("_i") + first).otherwise(F.col("_i")))
    term = F.when(resumed & (F.col("_i") == 0), F.col("prev_atr_14_w")).otherwise(F.col("_tr") / WILDER)
    d = ewm(d, {"_atr": term}, first, DECAY, ["symbol"], "_at")
    return _after(d, stored).select("symbol", "time", F.when(F.col("_at") >= first, F.col("_atr")).alias("atr_14_w"))


def decision_steps(stored: DataFrame, features: DataFrame, version: int) -> DataFrame:
    """The rows of decisions.structural after the stored ones: a run goes on from the stored streak until it breaks."""
    since = last_stored(stored, "positive_streak")
    d = features.join(since, "symbol", "left").filter(is_new()).withColumn("_ok", decisions.possible(version))
    so_far = by_symbol().rowsBetween(Window.unboundedPreceding, 0)
    d = d.withColumn("_n", F.row_number().over(by_symbol()).cast("long"))
    broken = F.max(F.when(~truth(F.col("_ok")), F.col("_n"))).over(so_far)
    run = F.when(broken.isNull(), F.col("_n") + F.coalesce("prev_positive_streak", F.lit(0))).otherwise(F.col("_n") - broken)
    d = d.withColumn("positive_streak", run.cast("long"))
    return d.select("symbol", "time", *[F.lit(v).alias(f"{c}_threshold") for c, v in decisions.STRUCTURAL.items()], F.when(F.col("_ok"), "POSSIBLE").otherwise("AVOID").alias("suggestion"), "positive_streak")


MOMENTUM = windowed(indicators.stock_momentum, max(indicators.STOCK_LAGS.values()))
MOVING_AVERAGE = windowed(indicators.stock_moving_average, max(indicators.SMA_DAYS))
VOLUME = windowed(indicators.stock_volume, 60)
RSI = Pipeline(indicators.stock_rsi, rsi_steps)
ATR = Pipeline(lambda bars: indicators.stock_volatility(bars).select("symbol", "time", "atr_14_w"), atr_steps)


def structural(version: int) -> Pipeline:
    """Over feature rows (stored feature tables, joined) instead of bars."""
    return Pipeline(lambda f: decisions.structural(f, version), lambda stored, f: decision_steps(stored, f, version))


def run(pipeline: Pipeline, bars: DataFrame, table: CommittedTable, mode: str, date: str | None = None, universe: DataFrame | None = None) -> Version:
    """Computes and commits: everything up to a day (backfill), or what follows the stored rows up to it (incremental).

    `universe` (symbol) keeps other symbols out. Running a step again finds nothing new and changes nothing; of two
    runs at once that touch the same months the later one computes its step anew from what the first one committed.
    """
    check_mode(mode)
    d = bars if date is None else until(bars, date)
    if universe is not None:
        d = d.join(universe.select("symbol").distinct(), "symbol", "left_semi")
    if mode == "backfill":
        return table.replace(pipeline.backfill(d))
    return table.append_steps(lambda stored: pipeline.step(stored, d), ["symbol", "time"])


def ingest_missing(universe: DataFrame, bars: DataFrame, table: CommittedTable) -> Version:
    """Takes from `bars` the symbols of the universe that the table does not hold yet, and commits their bars."""
    missing = difference(universe.select("symbol").distinct(), table.read().select("symbol").distinct(), "symbol")
    return table.append_steps(lambda stored: bars.join(missing, "symbol", "left_semi"), ["symbol", "time"])


def run_all(spark: SparkSession, tasks: dict[str, Callable[[], object]], at_once: int = 5) -> dict[str, object]:
    """Runs several pipelines at once and returns what each gave. Each runs in a scheduler pool of its own name, so that, with
    spark.scheduler.mode=FAIR, none waits for all jobs of another. When one fails, the jobs of the others are cancelled,
    those that have not begun do not begin, and its error is raised.
    """
    tag, context = f"run-{uuid.uuid4().hex}", spark.sparkContext

    def one(name: str) -> object:
        context.addJobTag(tag)  # tags and pools belong to the thread, which ends with this call of run_all
        context.setInterruptOnCancel(True)
        context.setLocalProperty("spark.scheduler.pool", name)
        return tasks[name]()

    with ThreadPoolExecutor(at_once) as threads:
        begun = {name: threads.submit(one, name) for name in tasks}
        done, rest = wait(begun.values(), return_when=FIRST_EXCEPTION)
        failed = next((f for f in done if f.exception()), None)
        if failed is not None:
            for f in rest:
                f.cancel()
            while not all(f.done() for f in rest):  # a pipeline may begin its next job just after the others were cancelled
                context.cancelJobsWithTag(tag)
                wait(rest, timeout=0.2)
            raise failed.exception()
        return {name: f.result() for name, f in begun.items()}
