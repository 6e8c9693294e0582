"""As-of lookups: rows beside the last state of their series."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def as_of(rows: DataFrame, states: DataFrame, key: str = "symbol", strict: bool = True) -> DataFrame:
    """`rows` with prev_<column> for each column of the last state of their key before their time (or at it, if not strict).

    Rows and states go through one sort by key and time, so the work grows with their sum, not with rows times the states
    before them, and a batch may hold any number of rows of a key. Each row comes back once: those without a state
    before them, without a key or without a time have NULLs, repeated rows stay. States without a key or a
    time are never met; of several states at one time one is taken. An empty table of states gives NULLs.
    """
    names = [c for c in states.columns if c != key]
    row, state = F.struct(*[F.col(f"`{c}`") for c in rows.columns]), F.struct(*[F.col(f"`{c}`") for c in names])
    usable = F.col(key).isNotNull() & F.col("time").isNotNull()
    nothing = F.lit(None)
    a = rows.filter(usable).select(F.col(key).alias("_k"), F.col("time").alias("_t"), F.lit(0 if strict else 1).alias("_side"), row.alias("_row"))
    b = states.filter(usable).select(F.col(key).alias("_k"), F.col("time").alias("_t"), F.lit(1 if strict else 0).alias("_side"), state.alias("_state"))
    w = Window.partitionBy("_k").orderBy("_t", "_side").rowsBetween(Window.unboundedPreceding, 0)
    met = a.unionByName(b, allowMissingColumns=True).withColumn("_state", F.last("_state", ignorenulls=True).over(w)).filter(F.col("_row").isNotNull())
    out = met.select("_row.*", *[F.col(f"_state.`{c}`").alias(f"prev_{c}") for c in names])
    types = dict(states.dtypes)
    alone = rows.filter(~usable).select("*", *[nothing.cast(types[c]).alias(f"prev_{c}") for c in names])
    return out.unionByName(alone)
