"""Indicators against plain Python loops, at the edges of their windows."""

import math
from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from barloom.functions.series import ewm, streak
from barloom.operators import asof, backtest, decisions, indicators, ranking, state, trades
from barloom.schemas import OHLCV


def frame(spark, closes, symbol="A", volume=1000):
    rows = [(symbol, datetime(2024, 1, 1, 7) + timedelta(days=k), c, c * 1.02, c * 0.97, c, volume) for k, c in enumerate(closes)]
    return spark.createDataFrame(rows, OHLCV)


def walk(n, seed=1, ties=False):
    r = np.random.default_rng(seed)
    steps = r.choice([-1.0, 0.0, 1.0], n) if ties else r.normal(0, 1, n)
    return (50 + np.maximum(np.cumsum(steps), -40)).tolist()


def pandas_of(df):
    return df.orderBy("time").toPandas()


@pytest.mark.parametrize("n", [1, 13, 14, 15, 16, 300])
def test_rsi_against_a_loop(spark, n):
    x = walk(n)
    got = pandas_of(indicators.stock_rsi(frame(spark, x)))
    g = l = None
    for k in range(n):
        if k == 1:
            d = x[1] - x[0]
            g, l = max(d, 0), max(-d, 0)
        elif k > 1:
            d = x[k] - x[k - 1]
            g, l = (13 * g + max(d, 0)) / 14, (13 * l + max(-d, 0)) / 14
        if k < 14:
            assert pd.isna(got.rsi_14[k])
        else:
            assert got.rsi_14[k] == pytest.approx(100 - 100 / (1 + g / l), rel=1e-12)
            assert 0 <= got.rsi_14[k] <= 100


def test_rsi_without_losses_or_moves(spark):
    rising = pandas_of(indicators.stock_rsi(frame(spark, [10.0 + k for k in range(40)])))
    assert (rising.rsi_14[14:] == 100).all()
    flat = pandas_of(indicators.stock_rsi(frame(spark, [10.0] * 40)))
    assert flat.rsi_14.isna().all() and (flat.average_gain_14[14:] == 0).all()


@pytest.mark.parametrize("n", [13, 14, 15, 120])
def test_wilder_atr_against_a_loop(spark, n):
    x = walk(n, 2)
    bars = frame(spark, x)
    got, old = pandas_of(indicators.stock_volatility(bars)), pandas_of(indicators.stock_atr_ewm(bars))
    tr = [c * 1.02 - c * 0.97 if k == 0 else max(c * 1.02 - c * 0.97, abs(c * 1.02 - x[k - 1]), abs(c * 0.97 - x[k - 1])) for k, c in enumerate(x)]
    a, e = None, tr[0]
    for k in range(n):
        a = sum(tr[:14]) / 14 if k == 13 else (13 * a + tr[k]) / 14 if k > 13 else None
        e = e if k == 0 else (13 * e + tr[k]) / 14
        assert old.atr_14_e[k] == pytest.approx(e, rel=1e-12)
        if k < 13:
            assert pd.isna(got.atr_14_w[k])
        else:
            assert got.atr_14_w[k] == pytest.approx(a, rel=1e-12)


def test_exponential_average_over_many_blocks(spark):
    from pyspark.sql import functions as F

    x = walk(1000, 3)
    df = frame(spark, x).withColumn("_i", F.datediff("time", F.lit("2024-01-01")))
    got = pandas_of(ewm(df, {"y": F.when(F.col("_i") == 0, F.col("close")).otherwise(F.col("close") / 14)}, 0, 13 / 14, ["symbol"], "_i", block=400))
    y = x[0]
    for k in range(1000):
        y = y if k == 0 else 13 / 14 * y + x[k] / 14
        assert got.y[k] == pytest.approx(y, rel=1e-9)


def test_windows_exclude_or_include_the_current_row(spark):
    x = walk(300, 4)
    s = pd.Series(x)
    bars = frame(spark, x)
    sma, vol = pandas_of(indicators.stock_moving_average(bars)), pandas_of(indicators.stock_volatility(bars))
    for n in (20, 50, 200):
        np.testing.assert_allclose(sma[f"sma_{n}"], s.rolling(n).mean().shift(1), rtol=1e-9)
    log_return = np.log(s / s.shift(1))
    for n in (20, 60, 126, 252):
        np.testing.assert_allclose(vol[f"vol_{n}d"], log_return.rolling(n).std() * math.sqrt(252), rtol=1e-7)
    np.testing.assert_allclose(vol.parkinson_20d.dropna(), math.sqrt(math.log(1.02 / 0.97) ** 2 / (4 * math.log(2))) * math.sqrt(252), rtol=1e-9)


def test_percentile_rank_against_a_loop(spark):
    x = walk(420, 5, ties=True)
    vol = pandas_of(indicators.stock_volatility(frame(spark, x)))
    v = vol.vol_20d.round(12).tolist()
    for n in (126, 252):
        for k in range(len(v)):
            window = v[max(0, k - n + 1) : k + 1]
            if len(window) < n or any(pd.isna(z) for z in window):
                assert pd.isna(vol[f"vol_20d_pct_{n}"][k])
                continue
            rank = sum(z < v[k] for z in window) + (sum(z == v[k] for z in window) + 1) / 2
            assert vol[f"vol_20d_pct_{n}"][k] == pytest.approx(rank / n) and 0 < rank / n <= 1


def test_zero_volume_gives_null_ratios(spark):
    v = pandas_of(indicators.stock_volume(frame(spark, walk(90), volume=0)))
    assert v.volume_ratio.isna().all() and v.volume_spike.isna().all() and (v.vol_20d[20:] == 0).all()


def test_streak_resets_and_null_is_false(spark):
    flags = [True, True, None, True, False, True, True, True]
    df = spark.createDataFrame([("A", k, f) for k, f in enumerate(flags)], "symbol string, time int, ok boolean")
    assert pandas_of(streak(df, "ok", "n", ["symbol"])).n.tolist() == [1, 2, 0, 1, 0, 1, 2, 3]


def test_single_pass_features_equal_the_joins(spark):
    bars = frame(spark, walk(200, 6)).unionByName(frame(spark, walk(180, 7), "B"))
    joined = indicators.joined_features(bars, indicators.stock_momentum(bars), indicators.stock_moving_average(bars), indicators.stock_rsi(bars), indicators.stock_volatility(bars), None, indicators.stock_volume(bars))
    one = indicators.features(bars)
    a = joined.select(sorted(joined.columns)).orderBy("symbol", "time").toPandas()
    b = one.select(sorted(joined.columns)).orderBy("symbol", "time").toPandas()
    pd.testing.assert_frame_equal(a, b, check_exact=False, rtol=1e-9)


def test_version_and_mode_are_checked():
    with pytest.raises(ValueError):
        decisions.possible(4)
    with pytest.raises(ValueError):
        state.check_mode("other")
    with pytest.raises(ValueError):
        ranking.in_universe(None, "some")
    with pytest.raises(ValueError):
        trades.signals(None, "abc")


def test_factor_scores_of_one_symbol_are_null(spark):
    f = indicators.features(frame(spark, walk(160, 8)), indicators.index_momentum(frame(spark, walk(160, 9)).drop("symbol")))
    assert pandas_of(ranking.rank(f, 1)).alpha_score.isna().all()


def _scored(spark, sizes, seed=0):
    r = np.random.default_rng(seed)
    rows = []
    for k, n in enumerate(sizes):
        a = r.integers(0, 12, n) / 4  # with ties
        for j in range(n):
            rows.append((datetime(2024, 1, 1) + timedelta(days=k), f"S{j:02d}", float(a[j]), float(r.integers(-6, 6)) / 10))
    return spark.createDataFrame(rows, "time timestamp_ntz, symbol string, alpha_score double, fwd_return_20d double"), pd.DataFrame(rows, columns=["time", "symbol", "alpha_score", "r"])


def test_spearman_spread_and_quintiles_against_pandas(spark):
    sizes = [3, 5, 6, 9, 10, 23, 23, 40]
    df, p = _scored(spark, sizes)
    ic, spread = pandas_of(backtest.ic_daily(df)), backtest.spread_daily(df).toPandas().set_index("time")
    for k, (t, g) in enumerate(p.groupby("time")):
        want = g.alpha_score.rank().corr(g.r.rank()) if len(g) >= 5 else np.nan
        assert ic.ic[k] == pytest.approx(want, nan_ok=True)
        if len(g) >= 6:
            g = g.sort_values(["alpha_score", "symbol"], ascending=[False, True])
            n = max(1, int(len(g) * 0.46))
            assert spread.loc[t, "spread"] == pytest.approx(g.r.head(n).mean() - g.r.tail(n).mean())
        else:
            assert t not in spread.index
    q = backtest.quintiles(df).toPandas()
    for t, g in p.groupby("time"):
        edges = g.alpha_score.quantile([0, 0.2, 0.4, 0.6, 0.8, 1.0])
        if len(g) < 10 or edges.duplicated().any():
            assert t not in set(q.time)
            continue
        want = pd.qcut(g.set_index("symbol").alpha_score, 5, labels=[1, 2, 3, 4, 5]).astype(int)
        assert q[q.time == t].set_index("symbol").quintile.to_dict() == want.to_dict()


def test_newey_west_against_numpy(spark):
    x = walk(90, 11)
    df = spark.createDataFrame([(datetime(2024, 1, 1) + timedelta(days=k), v if k % 9 else None) for k, v in enumerate(x)], "time timestamp_ntz, ic double")
    row = backtest.newey_west(df).first()
    e = np.array([v for k, v in enumerate(x) if k % 9])
    mean, n = e.mean(), len(e)
    e = e - mean
    s = (e @ e + 2 * sum((1 - k / 21) * (e[k:] @ e[:-k]) for k in range(1, 21))) / n
    assert (row["mean"], row["tstat"]) == (pytest.approx(mean), pytest.approx(mean / math.sqrt(s / n)))


def test_equity_is_the_running_product(spark):
    df = spark.createDataFrame([(k, s) for k, s in enumerate([0.1, -0.2, 0.05, -1.0, 0.3])], "time int, spread double")
    assert pandas_of(backtest.spread_equity(df)).cum_spread.tolist() == pytest.approx([1.1, 0.88, 0.924, 0, 0])


@pytest.mark.parametrize("hold", [1, 15])
def test_matcher_against_the_two_pointer_loop(spark, hold):
    r = np.random.default_rng(3)
    up, down = r.random(60) < 0.3, r.random(60) < 0.1
    up[58] = True  # an entry after the last exit
    down[45], up[30] = True, True  # an exit at exactly +15
    rows = [("A", datetime(2024, 1, 1) + timedelta(days=k), 10.0 + k, bool(up[k]), bool(down[k])) for k in range(60)]
    got = trades.trades(spark.createDataFrame(rows, "symbol string, time timestamp_ntz, close double, up boolean, down boolean"), hold).orderBy("entry_time").toPandas()
    want = []
    for k in np.flatnonzero(up):
        ahead = [x for x in np.flatnonzero(down) if x >= k + hold]
        if ahead:
            want.append((rows[k][1], rows[ahead[0]][1], ahead[0] - k))
    assert list(zip(got.entry_time, got.exit_time, got.holding_days, strict=True)) == want


def test_steps_equal_the_backfill(spark):
    x = walk(320, 12)
    bars = frame(spark, x).unionByName(frame(spark, x[::-1], "B"))
    dates = [datetime(2024, 1, 1, 7) + timedelta(days=k) for k in range(320)]
    day = dates[310].strftime("%Y-%m-%d")
    at = f"time = timestamp_ntz'{day} 07:00:00'"
    rsi, vol = indicators.stock_rsi(bars), indicators.stock_volatility(bars)
    pairs = [
        (state.rsi_step(rsi, bars, day), rsi.filter(at)),
        (state.atr_step(vol.select("symbol", "time", "atr_14_w"), bars, day), vol.filter(at).select("symbol", "time", "atr_14_w")),
        (state.incremental(indicators.stock_moving_average, bars, 201, day), indicators.stock_moving_average(bars).filter(at)),
        (state.incremental(indicators.stock_momentum, bars, 253, day), indicators.stock_momentum(bars).filter(at)),
        (state.incremental(indicators.stock_volume, bars, 61, day), indicators.stock_volume(bars).filter(at)),
        (state.incremental(lambda b: indicators.stock_volatility(b).drop("atr_14_w"), bars, 272, day), vol.drop("atr_14_w").filter(at)),
    ]
    for a, b in pairs:
        pd.testing.assert_frame_equal(a.orderBy("symbol").toPandas(), b.select(a.columns).orderBy("symbol").toPandas(), rtol=1e-9)
    f = indicators.features(bars)
    for v in (1, 2, 3):
        s = decisions.structural(f, v)
        step = state.decision_step(s, state.latest(f, day), decisions.possible(v), "symbol", "POSSIBLE", "AVOID").orderBy("symbol").toPandas()
        want = s.filter(at).select(step.columns.tolist()).orderBy("symbol").toPandas()
        pd.testing.assert_frame_equal(step, want)


def test_upsert_and_duplicate_keys(spark):
    old = spark.createDataFrame([("A", 1, 1.0), ("B", 1, 2.0)], "symbol string, time int, close double")
    new = spark.createDataFrame([("B", 1, 9.0), ("C", 1, 3.0)], old.schema)
    assert sorted(map(tuple, state.upsert(old, new, ["symbol", "time"]).collect())) == [("A", 1, 1.0), ("B", 1, 9.0), ("C", 1, 3.0)]
    with pytest.raises(Exception, match="duplicate key"):
        state.upsert(old, new.unionByName(new), ["symbol", "time"]).collect()


def test_scoped_replace_keeps_null_scopes(spark):
    from pyspark.sql import functions as F

    old = spark.createDataFrame([("A", 1), (None, 2), ("B", 3)], "symbol string, time int")
    got = state.scoped_replace(old, old.limit(0), F.col("symbol") == "A").collect()
    assert sorted(map(tuple, got), key=str) == [("B", 3), (None, 2)]


@pytest.mark.parametrize("strict", [True, False])
def test_as_of_against_a_loop(spark, strict):
    r = np.random.default_rng(5)
    day = datetime(2024, 1, 1)
    rows = [(["A", "B", None][int(r.integers(3))], day + timedelta(days=int(r.integers(40))), k % 50) for k in range(300)]
    rows += [("A", None, 1), ("only here", day, 2)]
    states = [(s, day + timedelta(days=d), float(d), None if d % 4 else "x") for s in ("A", "B", "hot", None) for d in range(0, 40, 3)] + [("A", None, 9.0, "y")]
    left = spark.createDataFrame(rows, "symbol string, time timestamp_ntz, n int")
    right = spark.createDataFrame(states, "symbol string, time timestamp_ntz, n double, note string")
    want = []
    for s, t, n in rows:
        met = [x for x in states if s and t and x[0] == s and x[1] and (x[1] < t if strict else x[1] <= t)]
        want.append((s, t, n, *(max(met, key=lambda x: x[1])[1:] if met else (None, None, None))))
    got = [tuple(x) for x in asof.as_of(left, right, strict=strict).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert asof.as_of(left, right.limit(0)).filter("prev_time IS NULL").count() == len(rows)
    assert asof.as_of(left.limit(0), right).count() == 0


def test_several_new_bars_of_a_symbol_take_the_stored_row_before_each(spark):
    bars = frame(spark, walk(40))
    day = F.dayofyear("time")
    stored = bars.select("symbol", "time", F.col("close").alias("average")).filter(day <= 30)
    new = bars.filter(day > 25)
    got = {x["time"].timetuple().tm_yday: x["prev_time"].timetuple().tm_yday for x in state.state_before(stored, new).collect()}
    assert got == {d: min(d - 1, 30) for d in range(26, 41)}
    assert "Join" not in state.state_before(stored, new)._jdf.queryExecution().executedPlan().toString()
