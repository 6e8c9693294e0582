"""Prices that reach 0: changes from them are infinite or NaN, not missing, and are ranked as the greatest values."""

import math

import numpy as np
from pyspark.sql import functions as F

from barloom.functions import slidingrank
from barloom.operators import indicators, ranking, trades
from barloom.streaming import windows
from tests.test_indicators import frame, pandas_of, walk

CLOSES = [0.0 if k in (200, 260, 281) else c for k, c in enumerate(walk(420))]


def same(a, b):
    return (a is None or b is None) and a is b or a is not None and b is not None and (math.isnan(a) and math.isnan(b) or a == b or math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-12))


def want_changes(n):
    with np.errstate(divide="ignore", invalid="ignore"):
        x = np.array(CLOSES)
        return [None] * n + (x[n:] / x[:-n] - 1).tolist()


def want_ranks(n):
    with np.errstate(divide="ignore", invalid="ignore"):
        x = np.array(CLOSES)
        r = np.log(x[1:] / x[:-1])
        vol = [None] * 20 + [float(np.round(np.std(r[k - 20 : k], ddof=1) * math.sqrt(252), 12)) for k in range(20, len(x))]
    rank = {v: k for k, v in enumerate(sorted({v for v in vol if v is not None and not math.isnan(v)}))}
    place = [None if v is None else rank.get(v, len(rank)) for v in vol]  # NaN is the greatest
    out = []
    for k in range(len(place)):
        w = place[max(0, k - n + 1) : k + 1]
        out.append(None if len(w) < n or None in w else (sum(v < w[-1] for v in w) + (sum(v == w[-1] for v in w) + 1) / 2) / n)
    return out


def test_changes_and_ranks_after_a_price_of_zero(spark):
    f = indicators.features(frame(spark, CLOSES)).orderBy("time").collect()
    assert all(same(r["sm_1"], x) for r, x in zip(f, want_changes(21), strict=True))
    assert f[221]["sm_1"] == math.inf and math.isnan(f[281]["sm_1"])
    assert all(same(r["vol_20d_pct_126"], x) for r, x in zip(f, want_ranks(126), strict=True))


def test_ranks_by_blocks_after_a_price_of_zero(spark):
    v = indicators.stock_volatility(frame(spark, CLOSES))
    got = slidingrank.percentile_ranks(v, ["symbol"], F.round("vol_20d", indicators.TIE_DIGITS), {"p": 126}, 130)
    assert all(same(r["p"], x) for r, x in zip(got.orderBy("time").collect(), want_ranks(126), strict=True))


def test_signals_after_a_price_of_zero(spark):
    x = walk(420, 6)
    x[300] = 0.0
    f = indicators.features(frame(spark, x)).withColumn("vnim_1", F.lit(0.1))
    ranked = trades.signals(f, "bsr").filter("time >= '2024-10-28'").select("vol_20d_pct_126").collect()
    assert ranked and all(r[0] is not None for r in ranked)


def test_stream_after_a_price_of_zero():
    got = windows.values(np.array(CLOSES), np.ones(len(CLOSES)))["m_1"]
    want = np.array(want_changes(21), float)
    assert np.allclose(got, want, equal_nan=True) and np.isinf(got[221])


def test_range_from_a_low_of_zero(spark):
    bars = frame(spark, walk(60)).withColumn("low", F.when(F.dayofyear("time") == 30, 0.0).otherwise(F.col("low")))
    v = pandas_of(indicators.stock_volatility(bars))
    assert np.isinf(v["parkinson_20d"][29:49]).all() and np.isfinite(v["parkinson_20d"][49:]).all()


def test_ranking_after_a_price_of_zero(spark):
    x = {s: walk(420, seed) for s, seed in (("A", 1), ("B", 2), ("C", 3), ("D", 4))}
    x["B"][300] = 0.0
    bars = [frame(spark, closes, s, 2_000_000) for s, closes in x.items()]
    both = bars[0].unionByName(bars[1]).unionByName(bars[2]).unionByName(bars[3])
    f = indicators.features(both).withColumns({c: F.lit(0.1) for c in ("vnim_1", "vnim_3", "vnim_6")})
    got = ranking.rank(f, 3, None, "possible_v3").filter("symbol = 'B' AND time >= '2024-10-28'").join(ranking.in_universe(f, "possible_v3").groupBy("time").count().filter("count > 1"), "time").collect()
    assert got and all(r["alpha_score"] is not None for r in got)
