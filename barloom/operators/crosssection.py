"""Cross-sections that no task should hold: exact quantiles, and the scores of `ranking`, for sessions of any size.

Rows of one session meet in partial aggregates only, each combined where the rows lie. A quantile is found in rounds. A sketch
of each group, itself a partial aggregate, proposes two of its values as splitters; a second pass counts exactly what
lies below, at, between and above them. So it is known which part holds the wanted rank, and rows of that part alone go on. The
sketch decides how fast a round narrows, never the result. Parts of at most `limit` rows are sorted.

What is joined to rows has one row a group. It is stored first, so its size is known when Spark plans the join: small tables
are broadcast, others shuffled, and adaptive execution splits a hot session then. Rows whose key is NULL are in no group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.functions.series import clip
from barloom.sources.storage import stored

#: Rows of one part that a task sorts.
LIMIT = 100_000
#: Splitters that a sketch proposes, evenly spread over the ranks, and the inverse of its error in ranks.
SPLITTERS, ACCURACY = 256, 2000


def _parts(lo: Column, hi: Column) -> list[Column]:
    """The conditions of the five parts of a group: below, at and between two splitters, at the second, above."""
    v = F.col("_v")
    return [v < lo, v == lo, (v > lo) & (v < hi), (v == hi) & (hi > lo), v > hi]


def _interpolated(low: Column, high: Column) -> Column:
    """The value at position (n - 1) * p between its neighbours, as `percentile` forms it."""
    at = (F.col("n") - 1) * F.col("p")
    between = (F.ceil(at) - at) * low + (at - F.floor(at)) * high
    return F.when(low == high, low).otherwise(between)


def _sorted(rows: DataFrame, targets: DataFrame, by: list[str], name: list[str]) -> DataFrame:
    """The quantiles of targets whose rows are few, by sorting these."""
    d = rows.join(targets, by)
    place = F.row_number().over(Window.partitionBy(*name).orderBy("_v")) - 1 + F.col("_skip")
    at = (F.col("n") - 1) * F.col("p")
    d = d.withColumn("_place", place).filter((F.col("_place") == F.floor(at)) | (F.col("_place") == F.ceil(at)))
    return d.groupBy(*name, "n").agg(_interpolated(F.min("_v"), F.max("_v")).alias("quantile"))


def _narrowed(rows: DataFrame, targets: DataFrame, by: list[str], name: list[str]) -> DataFrame:
    """One round: targets with what is known of them; `_area` is the part that still holds them, NULL where the value is known."""
    spark = rows.sparkSession
    grid = F.array(*[F.lit(k / SPLITTERS) for k in range(SPLITTERS + 1)])
    large = stored(spark, targets.select(*by).distinct(), "large-groups")
    sketch = rows.join(large, by, "left_semi").groupBy(*by).agg(F.percentile_approx("_v", grid, F.lit(ACCURACY)).alias("_grid"))
    first = F.floor((F.col("n") - 1) * F.col("p"))
    near = F.floor((first - F.col("_skip")) / F.col("_m") * SPLITTERS).cast("int")
    lo = F.get("_grid", F.greatest(near - 1, F.lit(0)))
    hi = F.get("_grid", F.least(near + 2, F.lit(SPLITTERS)))
    bounds = stored(spark, targets.join(sketch, by).select(*name, "n", "_skip", lo.alias("_lo"), hi.alias("_hi")), "splitters")
    facts = [f(F.when(part, F.col("_v"))).alias(f"_{fact}{k}") for k, part in enumerate(_parts(F.col("_lo"), F.col("_hi"))) for fact, f in (("c", F.count), ("a", F.min), ("z", F.max))]
    d = rows.join(bounds, by).groupBy(*name, "n", "_skip", "_lo", "_hi").agg(*facts)

    start, ends = F.col("_skip"), []
    for k in range(5):
        ends.append(start + F.col(f"_c{k}"))
        start = ends[-1]
    starts = [F.col("_skip"), *ends[:-1]]

    def part_of(rank: Column) -> Column:
        return F.when(rank < ends[0], 0).when(rank < ends[1], 1).when(rank < ends[2], 2).when(rank < ends[3], 3).otherwise(4)

    def value(rank: Column) -> Column:
        """Known at a splitter, and for the first and the last of a part."""
        found = F.lit(None).cast("double")
        for k in range(5):
            inside = F.when(rank == starts[k], F.col(f"_a{k}")).when((rank == ends[k] - 1) | (F.col(f"_a{k}") == F.col(f"_z{k}")), F.col(f"_z{k}"))
            found = F.when(part_of(rank) == k, inside).otherwise(found)
        return found

    last = F.ceil((F.col("n") - 1) * F.col("p"))
    d = d.select("*", _interpolated(value(first), value(last)).alias("quantile"), part_of(first).alias("_part"))
    # if one of two neighbours is neither first nor last of its part, the other is in that part too
    area = F.when(F.col("quantile").isNull(), F.col("_part"))
    skip = F.element_at(F.array(*starts), F.col("_part") + 1)
    size = F.element_at(F.array(*[F.col(f"_c{k}") for k in range(5)]), F.col("_part") + 1)
    return stored(spark, d.select(*name, "n", skip.alias("_skip"), size.alias("_m"), "_lo", "_hi", area.alias("_area"), "quantile"), "narrowed")


def quantiles(df: DataFrame, key: list[str], value: str, probabilities: tuple[float, ...], limit: int = LIMIT) -> DataFrame:
    """key, p, n, quantile: the exact quantiles of the values of each group, interpolated between neighbours as `percentile` does.

    n counts the values; NULLs are none, and a group without values has no rows. NaN is greater than any number. Ties and
    repeated rows count each. `df` is read at least twice, so give a stored table where it is dear to compute.
    """
    if not probabilities or not all(0 <= p <= 1 for p in probabilities) or limit < 1:
        raise ValueError("probabilities lie in 0 to 1, and a part holds at least one row")
    spark, name, by = df.sparkSession, [*key, "p"], list(key)
    known = F.col(value).isNotNull()
    for k in key:
        known = known & F.col(k).isNotNull()
    rows = df.filter(known).select(*key, F.col(value).cast("double").alias("_v"))
    wanted = F.explode(F.array(*[F.lit(float(p)) for p in sorted(set(probabilities))]))
    targets = stored(spark, rows.groupBy(*key).agg(F.count("*").alias("n")).select(*key, "n", F.lit(0).cast("long").alias("_skip"), F.col("n").alias("_m"), wanted.alias("p")), "quantile-targets")
    found = [_sorted(rows, targets.filter(F.col("_m") <= limit), by, name)]
    while not targets.filter(F.col("_m") > limit).isEmpty():
        round_ = _narrowed(rows, targets.filter(F.col("_m") > limit), by, name)
        found.append(round_.filter("_area IS NULL").select(*name, "n", "quantile"))
        still = round_.filter("_area IS NOT NULL")
        inside = F.lit(False)
        for k, part in enumerate(_parts(F.col("_lo"), F.col("_hi"))):
            inside = inside | ((F.col("_area") == k) & part)
        rows = stored(spark, rows.join(still.select(*name, "_lo", "_hi", "_area"), by).filter(inside).select(*name, "_v"), "candidates")
        targets, by = still.select(*name, "n", "_skip", "_m"), name
        found.append(_sorted(rows, targets.filter(F.col("_m") <= limit), by, name))
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out.select(*name, "n", "quantile")


def long_form(df: DataFrame, key: list[str], columns: dict[str, Column]) -> DataFrame:
    """key, factor, x: a row for each column of each row."""
    each = [F.struct(F.lit(c).alias("factor"), x.cast("double").alias("x")) for c, x in columns.items()]
    return df.select(*key, F.explode(F.array(*each)).alias("_f")).select(*key, "_f.*")


def z_scores(df: DataFrame, columns: dict[str, Column], winsorise: bool, limit: int = LIMIT) -> DataFrame:
    """ranking.z_scores for sessions that no task holds: edges by `quantiles`, mean and spread by partial aggregation.

    Rows without a time are in no session and have NULL scores.
    """
    spark = df.sparkSession
    raw = df.select("*", *[x.alias(f"_x_{c}") for c, x in columns.items()])
    if winsorise:
        raw = stored(spark, raw, "cross-section")
        q = quantiles(long_form(raw, ["time"], {c: F.col(f"_x_{c}") for c in columns}), ["time", "factor"], "x", (0.05, 0.95), limit)
        edge = {(c, p): F.max(F.when((F.col("factor") == c) & (F.col("p") == p), F.col("quantile"))) for c in columns for p in (0.05, 0.95)}
        edges = stored(spark, q.groupBy("time").agg(*[x.alias(f"_q_{c}_{int(p * 100)}") for (c, p), x in edge.items()]), "edges")
        clipped = {f"_x_{c}": clip(F.col(f"_x_{c}"), F.col(f"_q_{c}_5"), F.col(f"_q_{c}_95")) for c in columns}
        raw = raw.join(edges, "time", "left").withColumns(clipped).select(*raw.columns)
    stats = [f(f"_x_{c}").alias(f"_{n}_{c}") for c in columns for n, f in (("m", F.avg), ("s", F.stddev_samp))]
    moments = stored(spark, raw.filter(F.col("time").isNotNull()).groupBy("time").agg(*stats), "moments")
    scores = {c: clip(F.try_divide(F.col(f"_x_{c}") - F.col(f"_m_{c}"), F.col(f"_s_{c}")), -3, 3) for c in columns}
    return raw.join(moments, "time", "left").select(*df.columns, *[x.alias(c) for c, x in scores.items()])
