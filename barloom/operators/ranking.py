"""Cross-sectional ranking: factors standardised over the symbols of one session and combined to an alpha score."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.functions.series import clip
from barloom.operators.decisions import possible

#: Weights of the 3, 6 and 1 month momentum, and of (momentum, trend, volatility, rsi).
MOMENTUM = {1: (0.40, 0.35, 0.25), 2: (0.50, 0.30, 0.20), 3: (0.50, 0.30, 0.20)}
ALPHA = {(1, "plain"): (0.45, 0.30, 0.15, 0.10), (2, "plain"): (0.40, 0.30, 0.20, 0.10), (2, "uncorr"): (0.50, 0.10, 0.20, 0.10), (3, "uncorr"): (0.10, 0.10, 0.20, 0.50)}
ACTIVE = {1: "plain", 2: "uncorr", 3: "uncorr"}
FACTORS = ["momentum_adjusted", "trend_score", "volatility_score", "rsi_14_z"]
UNIVERSES = ["all", "possible_v1", "possible_v2", "possible_v3"]


def z_scores(df: DataFrame, columns: dict[str, Column], winsorise: bool) -> DataFrame:
    """Adds z-scores over the rows of each session, clipped to +-3; first clipped to the 5 % and 95 % quantiles if asked.

    All windows share one partitioning by time; a spread of 0 or a single row gives NULL.
    """
    day = Window.partitionBy("time")
    df = df.select("*", *[x.alias(f"_x_{c}") for c, x in columns.items()])
    if winsorise:
        for c in columns:
            q = F.percentile(f"_x_{c}", F.array(F.lit(0.05), F.lit(0.95))).over(day)
            df = df.withColumn(f"_q_{c}", q)
        df = df.select(*[k for k in df.columns if not k.startswith(("_x_", "_q_"))], *[clip(F.col(f"_x_{c}"), F.col(f"_q_{c}")[0], F.col(f"_q_{c}")[1]).alias(f"_x_{c}") for c in columns])
    stats = [f(f"_x_{c}").over(day).alias(f"_{n}_{c}") for c in columns for n, f in (("m", F.avg), ("s", F.stddev_samp))]
    df = df.select("*", *stats)
    for c in columns:
        df = df.withColumn(c, clip(F.try_divide(F.col(f"_x_{c}") - F.col(f"_m_{c}"), F.col(f"_s_{c}")), -3, 3))
    return df.drop(*[f"_{n}_{c}" for n in "xms" for c in columns])


def in_universe(features: DataFrame, universe: str) -> DataFrame:
    if universe not in UNIVERSES:
        raise ValueError(f"universe is one of {UNIVERSES}")
    return features if universe == "all" else features.filter(possible(int(universe[-1])))


def factors(features: DataFrame, version: int, keep: tuple[str, ...] = (), scores: Callable[[DataFrame, dict[str, Column], bool], DataFrame] = z_scores) -> DataFrame:
    """The four factor scores of each row, and the columns to keep; `features` with the index momentum. `scores` standardises:
    by windows, or as `crosssection.z_scores` does where a session is too large for a task."""
    c = F.col
    d = scores(
        features,
        {
            "m1_z": c("sm_1") - c("vnim_1"),
            "m3_z": c("sm_3") - c("vnim_3"),
            "m6_z": c("sm_6") - c("vnim_6"),
            "close_sma50_z": F.try_divide("close", "sma_50"),
            "sma20_sma50_z": F.try_divide("sma_20", "sma_50"),
            "atr14_close_z": F.try_divide("atr_14_w", "close"),
            "vol_pct_z": c("vol_20d_pct_126"),
        },
        True,
    )
    d = scores(d, {"rsi_14_z": -F.abs(c("rsi_14") - 55)}, False)
    w3, w6, w1 = MOMENTUM[version]
    return d.select(
        "symbol",
        "time",
        ((w3 * c("m3_z") + w6 * c("m6_z") + w1 * c("m1_z")) * (1 - c("vol_20d_pct_126"))).alias("momentum_adjusted"),
        (0.6 * c("close_sma50_z") + 0.4 * c("sma20_sma50_z")).alias("trend_score"),
        (-0.5 * c("atr14_close_z") - 0.5 * c("vol_pct_z")).alias("volatility_score"),
        "rsi_14_z",
        *keep,
    )


def alpha(version: int, kind: str | None = None) -> Column:
    """The score of a version; kind 'mean' is the mean of the mean of momentum and trend, volatility and rsi."""
    kind = kind or ACTIVE[version]
    m, t, v, r = (F.col(f) for f in FACTORS)
    if kind == "mean":
        present = m.isNotNull().cast("int") + t.isNotNull().cast("int")
        both = F.try_divide(F.coalesce(m, F.lit(0.0)) + F.coalesce(t, F.lit(0.0)), present)
        return (both + v + r) / 3
    if (version, kind) not in ALPHA:
        raise ValueError(f"no alpha {kind!r} in version {version}")
    return sum((w * x for w, x in zip(ALPHA[version, kind][1:], (t, v, r), strict=True)), ALPHA[version, kind][0] * m)


def rank(features: DataFrame, version: int, kind: str | None = None, universe: str = "all", keep: tuple[str, ...] = (), scores: Callable[[DataFrame, dict[str, Column], bool], DataFrame] = z_scores) -> DataFrame:
    """time, symbol, alpha_score and the columns to keep of the universe's rows, best first only when sorted on output."""
    return factors(in_universe(features, universe), version, keep, scores).select("time", "symbol", alpha(version, kind).alias("alpha_score"), *keep)


def placed(ranking: DataFrame) -> DataFrame:
    """Adds each symbol's place within its session: best score first, missing scores last, ties by symbol."""
    w = Window.partitionBy("time").orderBy(F.col("alpha_score").desc_nulls_last(), "symbol")
    return ranking.withColumn("place", F.row_number().over(w).cast("long"))


def ordered(ranking: DataFrame) -> DataFrame:
    """Newest session first, best score first."""
    return placed(ranking).orderBy(F.col("time").desc(), "place").drop("place")


def factor_correlation(scores: DataFrame, least: int = 2) -> DataFrame:
    """Pearson correlation of each pair of factors within each session of at least `least` symbols; NULL where one does not vary."""
    rows = []
    for k, a in enumerate(FACTORS):
        for b in FACTORS[k + 1 :]:
            both = F.col(a).isNotNull() & F.col(b).isNotNull()
            x, y = F.when(both, F.col(a)), F.when(both, F.col(b))
            rows.append((a, b, x, y))
    stats = [f.alias(f"{n}{k}") for k, (_, _, x, y) in enumerate(rows) for n, f in (("c", F.covar_pop(x, y)), ("x", F.stddev_pop(x)), ("y", F.stddev_pop(y)))]
    d = scores.groupBy("time").agg(F.count("*").alias("_n"), *stats).filter(F.col("_n") >= least)
    pairs = F.array(*[F.struct(F.lit(a).alias("factor_a"), F.lit(b).alias("factor_b"), F.try_divide(F.col(f"c{k}"), F.col(f"x{k}") * F.col(f"y{k}")).alias("correlation")) for k, (a, b, _, _) in enumerate(rows)])
    return d.select("time", F.explode(pairs).alias("p")).select("time", "p.*")
