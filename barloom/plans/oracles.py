"""The registered queries as DuckDB SQL, written another way: recursions, self-joins, lists and quantile_cont."""

from __future__ import annotations

from barloom.plans.registry import DATE, END, START, SYMBOL
from barloom.sources import fixtures

W = "WINDOW w AS (PARTITION BY symbol ORDER BY time)"
WI = "WINDOW w AS (ORDER BY time)"


def _before(x: str, n: int, part: str = "PARTITION BY symbol ") -> str:
    over = f"OVER ({part}ORDER BY time ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING)"
    return f"CASE WHEN count({x}) {over} = {n} THEN avg({x}) {over} END"


def _roll(f: str, x: str, n: int, part: str = "PARTITION BY symbol ") -> str:
    over = f"OVER ({part}ORDER BY time ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
    return f"CASE WHEN count({x}) {over} = {n} THEN {f}({x}) {over} END"


def _pct(n: int) -> str:
    return f"""SELECT a.symbol, a.i, CASE WHEN a.vol_20d IS NOT NULL AND count(x.vol_20d) = {n}
  THEN (count(*) FILTER (x.vol_20d < a.vol_20d) + (count(*) FILTER (x.vol_20d = a.vol_20d) + 1) / 2e0) / {n}e0 END AS p
  FROM tie a JOIN tie x ON x.symbol = a.symbol AND x.i BETWEEN a.i - {n - 1} AND a.i GROUP BY a.symbol, a.i, a.vol_20d"""


YEAR = "sqrt(252e0)"
#: Correlation of doubled ranks x and y by sums of whole numbers, which have no order.
IC = "CASE WHEN count(*) >= 5 THEN (count(*) * sum(x * y) - sum(x) * sum(y))::DOUBLE / nullif(sqrt((count(*) * sum(x * x) - sum(x) * sum(x))::DOUBLE) * sqrt((count(*) * sum(y * y) - sum(y) * sum(y))::DOUBLE), 0) END"
CTE = {
    "ohlcv": (fixtures.OHLCV_SQL, []),
    "vnindex": (fixtures.INDEX_SQL, []),
    "b": (f"SELECT *, row_number() OVER w - 1 AS i, lag(close) OVER w AS pc FROM ohlcv {W}", ["ohlcv"]),
    "mom": (f"SELECT symbol, time, close/lag(close,21) OVER w - 1 AS m_1, close/lag(close,63) OVER w - 1 AS m_3, close/lag(close,126) OVER w - 1 AS m_6, close/lag(close,252) OVER w - 1 AS m_12 FROM ohlcv {W}", ["ohlcv"]),
    "sma": ("SELECT symbol, time, " + ", ".join(f"{_before('close', n)} AS sma_{n}" for n in (20, 50, 200)) + " FROM ohlcv", ["ohlcv"]),
    "volume0": (f"SELECT symbol, time, volume, {_before('volume', 20)} AS vol_20d, {_before('volume', 60)} AS vol_60d FROM ohlcv", ["ohlcv"]),
    "volume": ("SELECT symbol, time, vol_20d, vol_60d, vol_20d/nullif(vol_60d,0) AS volume_ratio, volume/nullif(vol_20d,0) AS volume_spike FROM volume0", ["volume0"]),
    "rsi_r": (
        """SELECT symbol, i, greatest(close-pc,0e0) AS g, greatest(pc-close,0e0) AS l FROM b WHERE i = 1
  UNION ALL SELECT b.symbol, b.i, (13e0*r.g+greatest(b.close-b.pc,0e0))/14e0, (13e0*r.l+greatest(b.pc-b.close,0e0))/14e0 FROM rsi_r r JOIN b ON b.symbol = r.symbol AND b.i = r.i + 1""",
        ["b"],
    ),
    "rsi": ("SELECT b.symbol, b.time, CASE WHEN l > 0 THEN 100-100/(1+g/l) WHEN g > 0 THEN 100e0 END AS rsi_14, g AS average_gain_14, l AS average_loss_14 FROM b LEFT JOIN rsi_r r ON r.symbol = b.symbol AND r.i = b.i AND r.i >= 14", ["rsi_r"]),
    "tr": ("SELECT *, greatest(high-low, abs(high-pc), abs(low-pc)) AS tr, ln(close/pc) AS r, pow(ln(high/low),2) AS hl FROM b", ["b"]),
    "atr_r": (
        """SELECT symbol, 13::BIGINT AS i, avg(tr) AS a FROM tr WHERE i <= 13 GROUP BY symbol HAVING count(*) = 14
  UNION ALL SELECT t.symbol, t.i, (13e0*r.a+t.tr)/14e0 FROM atr_r r JOIN tr t ON t.symbol = r.symbol AND t.i = r.i + 1""",
        ["tr"],
    ),
    "atr_e": ("SELECT symbol, i, tr AS a FROM tr WHERE i = 0 UNION ALL SELECT t.symbol, t.i, (13e0*r.a+t.tr)/14e0 FROM atr_e r JOIN tr t ON t.symbol = r.symbol AND t.i = r.i + 1", ["tr"]),
    "vols": ("SELECT symbol, time, i, " + ", ".join(f"{_roll('stddev_samp', 'r', n)} * {YEAR} AS vol_{n}d" for n in (20, 60, 126, 252)) + f", {_roll('avg', 'tr', 14)} AS atr_14_r, sqrt(({_roll('sum', 'hl', 20)}) / (80e0*ln(2e0))) * {YEAR} AS parkinson_20d FROM tr", ["tr"]),
    "tie": ("SELECT symbol, i, round(vol_20d, 12) AS vol_20d FROM vols", ["vols"]),
    "pct126": (_pct(126), ["tie"]),
    "pct252": (_pct(252), ["tie"]),
    "imom": (f"SELECT time, close/lag(close,21) OVER w - 1 AS m_21d, close/lag(close,60) OVER w - 1 AS m_60d, close/lag(close,126) OVER w - 1 AS m_126d FROM vnindex {WI}", ["vnindex"]),
    "isma": (f"SELECT time, {_before('close', 150, '')} AS sma_150 FROM vnindex", ["vnindex"]),
    "idd": (f"SELECT time, (close - m)/m AS drawdown_40d FROM (SELECT time, close, {_roll('max', 'close', 40, '')} AS m FROM vnindex) x", ["vnindex"]),
    "ivol": (f"SELECT time, {_roll('stddev_samp', 'r', 20, '')} * {YEAR} AS vol_20d FROM (SELECT time, ln(close/lag(close) OVER w) AS r FROM vnindex {WI}) x", ["vnindex"]),
    "reg0": ("SELECT v.time, coalesce(v.close > sma_150 AND m_60d > 0.03e0 AND drawdown_40d > -0.08e0 AND vol_20d < 0.25e0, false) AS ok FROM vnindex v JOIN imom USING (time) JOIN isma USING (time) JOIN idd USING (time) JOIN ivol USING (time)", ["vnindex", "imom", "isma", "idd", "ivol"]),
    "reg": ("SELECT time, CASE WHEN ok THEN 'SAFE' ELSE 'DEFENSIVE' END AS suggestion, CASE WHEN ok THEN n - coalesce(max(CASE WHEN NOT ok THEN n END) OVER (ORDER BY n), 0) ELSE 0 END::BIGINT AS positive_streak FROM (SELECT *, row_number() OVER (ORDER BY time) AS n FROM reg0) x", ["reg0"]),
    "feat": (
        """SELECT b.symbol, b.time, b.close, b.volume::DOUBLE AS volume, s.sma_20, s.sma_50, m.m_1 AS sm_1, m.m_3 AS sm_3, m.m_6 AS sm_6, r.rsi_14, p.p AS vol_20d_pct_126, a.a AS atr_14_w, v.volume_ratio
  FROM b JOIN sma s USING (symbol, time) JOIN mom m USING (symbol, time) JOIN rsi r USING (symbol, time) JOIN volume v USING (symbol, time) JOIN pct126 p ON p.symbol = b.symbol AND p.i = b.i LEFT JOIN atr_r a ON a.symbol = b.symbol AND a.i = b.i""",
        ["b", "sma", "mom", "rsi", "volume", "pct126", "atr_r"],
    ),
    "featx": ("SELECT f.*, i.m_21d AS vnim_1, i.m_60d AS vnim_3, i.m_126d AS vnim_6 FROM feat f JOIN imom i USING (time)", ["feat", "imom"]),
}
CONDITION = {
    1: "close > sma_50 AND sma_20 > sma_50 AND sm_3 > -0.1e0 AND sm_1 > -0.05e0 AND rsi_14 < 75 AND vol_20d_pct_126 < 90 AND atr_14_w/nullif(close,0) < 0.12e0 AND volume_ratio < 0.7e0",
    2: "close > sma_50 AND sma_20 > sma_50 AND sm_3 > -0.1e0 AND sm_1 > -0.05e0",
    3: "close > sma_20 AND close > sma_50 AND volume > 1000000",
}
for _v, _c in CONDITION.items():
    CTE[f"str0_{_v}"] = (f"SELECT symbol, time, coalesce({_c}, false) AS ok, row_number() OVER (PARTITION BY symbol ORDER BY time) AS n FROM feat", ["feat"])
    CTE[f"str_{_v}"] = (
        f"SELECT symbol, time, CASE WHEN ok THEN 'POSSIBLE' ELSE 'AVOID' END AS suggestion, CASE WHEN ok THEN n - coalesce(max(CASE WHEN NOT ok THEN n END) OVER (PARTITION BY symbol ORDER BY n), 0) ELSE 0 END::BIGINT AS positive_streak FROM str0_{_v}",
        [f"str0_{_v}"],
    )

_X = {"m1": "sm_1-vnim_1", "m3": "sm_3-vnim_3", "m6": "sm_6-vnim_6", "cs": "close/nullif(sma_50,0)", "ss": "sma_20/nullif(sma_50,0)", "ax": "atr_14_w/nullif(close,0)", "vp": "vol_20d_pct_126"}


def _z(x: str) -> str:
    z = f"(({x} - avg({x}) OVER d) / nullif(stddev_samp({x}) OVER d, 0))"
    return f"CASE WHEN {z} IS NOT NULL THEN greatest(least({z}, 3e0), -3e0) END"


for _u in ("all", "possible_v1", "possible_v2", "possible_v3"):
    _where = "" if _u == "all" else f" WHERE coalesce({CONDITION[int(_u[-1])]}, false)"
    CTE[f"u_{_u}"] = (f"SELECT symbol, time, {', '.join(f'{x} AS {n}' for n, x in _X.items())}, -abs(rsi_14-55) AS rs FROM featx{_where}", ["featx"])
    CTE[f"q_{_u}"] = (
        "SELECT symbol, time, vp AS pct, rs, " + ", ".join(f"CASE WHEN {n} IS NOT NULL THEN greatest(least({n}, quantile_cont({n}, 0.95) OVER d), quantile_cont({n}, 0.05) OVER d) END AS {n}" for n in _X) + f" FROM u_{_u} WINDOW d AS (PARTITION BY time)",
        [f"u_{_u}"],
    )
    # a spread of rounding errors only is none: it is compared after a z that clips it
    CTE[f"z_{_u}"] = ("SELECT symbol, time, pct, " + ", ".join(f"CASE WHEN isfinite(z_{n}) THEN z_{n} END AS {n}" for n in [*_X, "rs"]) + " FROM (SELECT *, " + ", ".join(f"{_z(n)} AS z_{n}" for n in [*_X, "rs"]) + f" FROM q_{_u} WINDOW d AS (PARTITION BY time)) x", [f"q_{_u}"])
    for _v, (_a, _b, _c) in {1: ("0.4e0", "0.35e0", "0.25e0"), 2: ("0.5e0", "0.3e0", "0.2e0"), 3: ("0.5e0", "0.3e0", "0.2e0")}.items():
        CTE[f"f_{_u}_{_v}"] = (f"SELECT symbol, time, ({_a}*m3 + {_b}*m6 + {_c}*m1)*(1-pct) AS momentum_adjusted, 0.6e0*cs + 0.4e0*ss AS trend_score, -0.5e0*ax - 0.5e0*vp AS volatility_score, rs AS rsi_14_z FROM z_{_u}", [f"z_{_u}"])

ALPHA = {
    "1": "0.45e0*momentum_adjusted + 0.3e0*trend_score + 0.15e0*volatility_score + 0.1e0*rsi_14_z",
    "2": "0.5e0*momentum_adjusted + 0.1e0*trend_score + 0.2e0*volatility_score + 0.1e0*rsi_14_z",
    "3": "0.1e0*momentum_adjusted + 0.1e0*trend_score + 0.2e0*volatility_score + 0.5e0*rsi_14_z",
    "2_plain": "0.4e0*momentum_adjusted + 0.3e0*trend_score + 0.2e0*volatility_score + 0.1e0*rsi_14_z",
    "2_mean": "((coalesce(momentum_adjusted,0)+coalesce(trend_score,0))/nullif((momentum_adjusted IS NOT NULL)::INT+(trend_score IS NOT NULL)::INT,0)+volatility_score+rsi_14_z)/3",
}
for _u in ("all", "possible_v1", "possible_v2", "possible_v3"):
    for _k, _x in ALPHA.items():
        CTE[f"rank_{_u}_{_k}"] = (f"SELECT time, symbol, {_x} AS alpha_score FROM f_{_u}_{_k[0]}", [f"f_{_u}_{_k[0]}"])
    CTE[f"sc_{_u}"] = (
        f"""SELECT k.time, k.symbol, k.alpha_score, greatest(least(c20/close-1, 0.5e0), -0.5e0) AS r FROM rank_{_u}_3 k
  JOIN (SELECT symbol, time, close, lead(close, 7) OVER (PARTITION BY symbol ORDER BY time) AS c20 FROM ohlcv) f USING (time, symbol) WHERE k.alpha_score IS NOT NULL AND c20 IS NOT NULL""",
        [f"rank_{_u}_3", "ohlcv"],
    )
    CTE[f"ic_{_u}"] = (
        f"""SELECT time, {IC} AS ic, count(*) AS n FROM (SELECT a.time, a.symbol,
   (SELECT 2 * count(*) FILTER (b.alpha_score < a.alpha_score) + count(*) FILTER (b.alpha_score = a.alpha_score) + 1 FROM sc_{_u} b WHERE b.time = a.time) AS x,
   (SELECT 2 * count(*) FILTER (b.r < a.r) + count(*) FILTER (b.r = a.r) + 1 FROM sc_{_u} b WHERE b.time = a.time) AS y FROM sc_{_u} a) z GROUP BY time""",
        [f"sc_{_u}"],
    )
    CTE[f"sp_{_u}"] = (
        f"""SELECT time, top_return, bottom_return, top_return - bottom_return AS spread, k AS top_n, n AS universe_size FROM (
   SELECT time, n, k, avg(r) FILTER (rn <= k) AS top_return, avg(r) FILTER (rn > n - k) AS bottom_return FROM (
    SELECT *, greatest(1, floor(n * 0.46e0))::BIGINT AS k FROM (SELECT *, count(*) OVER (PARTITION BY time) AS n, row_number() OVER (PARTITION BY time ORDER BY alpha_score DESC, symbol) AS rn FROM sc_{_u}) x WHERE n >= 6) y GROUP BY time, n, k) z""",
        [f"sc_{_u}"],
    )
    CTE[f"qr_{_u}"] = (
        f"""SELECT quintile, avg(m) AS mean_return, count(*) AS n_days FROM (SELECT time, quintile, avg(r) AS m FROM (
   SELECT s.time, s.r, 1 + (alpha_score > e[2])::BIGINT + (alpha_score > e[3])::BIGINT + (alpha_score > e[4])::BIGINT + (alpha_score > e[5])::BIGINT AS quintile
   FROM sc_{_u} s JOIN (SELECT time, count(*) AS n, quantile_cont(alpha_score, [0.0, 0.2, 0.4, 0.6, 0.8, 1.0]) AS e FROM sc_{_u} GROUP BY time) q ON q.time = s.time WHERE n >= 10 AND len(list_distinct(e)) = 6) x GROUP BY time, quintile) y GROUP BY quintile""",
        [f"sc_{_u}"],
    )


def _held(x: str, k: int, f: str = "sum") -> str:
    return f"CASE WHEN n >= {k} THEN {f}({x}::INT) OVER (PARTITION BY symbol ORDER BY time ROWS BETWEEN {k - 1} PRECEDING AND CURRENT ROW) END"


CTE["sim"] = (
    f"""SELECT *, row_number() OVER w AS n, coalesce(rsi_14 > 55 AND lag(rsi_14) OVER w <= 55, false) AS rc, coalesce(sm_1 > 0 AND lag(sm_1) OVER w <= 0, false) AS mc,
  coalesce(close > sma_20 AND lag(close) OVER w <= lag(sma_20) OVER w, false) AS pc, coalesce(rsi_14 > 70 AND lag(rsi_14) OVER w <= 70, false) AS xc, coalesce(rsi_14 < 50 AND lag(rsi_14) OVER w >= 50, false) AS nc,
  coalesce(rsi_14 > 55, false) AS r55, coalesce(rsi_14 > 85, false) AS r85, coalesce(rsi_14 > 70, false) AS r70, coalesce(rsi_14 BETWEEN 50 AND 60, false) AS zone, coalesce(sm_1 > 0, false) AS m1, coalesce(sm_3 > 0, false) AS m3,
  coalesce(close > sma_20, false) AS above, coalesce(sma_20 > sma_50, false) AS trend, coalesce(vnim_1 > 0, false) AS vn FROM featx WHERE time >= '{START}'::TIMESTAMP {W}""",
    ["featx"],
)
CTE["sig_bsr"] = (
    f"""SELECT symbol, time, close, rsi_14, n, (mr + rr + pr + expand::INT)::BIGINT AS score,
  coalesce(mr = 1 AND rr = 1 AND pr = 1 AND expand AND r55n >= 2 AND zone AND m1n >= 2 AND an >= 2 AND vol_20d_pct_126 BETWEEN 0.3e0 AND 0.8e0 AND m6 = 1 AND r3 = 1, false) AS up,
  coalesce(hr = 1 AND ar = 1 AND hn = 3 AND an = 3, false) AS down
  FROM (SELECT *, {_held('mc', 5, 'max')} AS mr, {_held('rc', 5, 'max')} AS rr, {_held('pc', 5, 'max')} AS pr, coalesce(({_roll('avg', 'atr_14_w', 5)}) > 0, false) AS expand, {_held('r55', 3)} AS r55n, {_held('m1', 3)} AS m1n, {_held('above', 3)} AS an,
   {_held('mc', 6, 'max')} AS m6, {_held('rc', 3, 'max')} AS r3, {_held('r85', 3, 'max')} AS hr, {_held('above', 3, 'max')} AS ar, {_held('r85', 3)} AS hn FROM sim) x""",
    ["sim"],
)
CTE["sig_pvd"] = (
    f"""SELECT symbol, time, close, rsi_14, n, NULL::BIGINT AS score, coalesce(expand AND zn = 3 AND an = 3 AND tn = 3 AND m1n = 3 AND m3n = 3 AND vnn = 5, false) AS up, coalesce(xr = 1 AND xn = 2, false) OR nc AS down
  FROM (SELECT *, coalesce(({_roll('avg', 'atr_14_w', 3)}) > 0, false) AS expand, {_held('zone', 3)} AS zn, {_held('above', 3)} AS an, {_held('trend', 3)} AS tn, {_held('m1', 3)} AS m1n, {_held('m3', 3)} AS m3n, {_held('vn', 5)} AS vnn, {_held('xc', 2, 'max')} AS xr, {_held('r70', 2)} AS xn FROM sim) x""",
    ["sim"],
)


def sql(select: str, *uses: str) -> str:
    """The statement with the tables that it uses, and those that they use, in front."""
    order: list[str] = []

    def need(name: str) -> None:
        for x in CTE[name][1]:
            need(x)
        if name not in order:
            order.append(name)

    for u in uses:
        need(u)
    recursive = {"rsi_r", "atr_r", "atr_e"}
    parts = [f"{n} AS {'' if n in recursive else 'MATERIALIZED '}({CTE[n][0]})" for n in order]
    return ("WITH RECURSIVE " + ",\n".join(parts) + "\n" if parts else "") + select


def r(*columns: str) -> str:
    """Columns rounded like the queries'."""
    return ", ".join(f"round({c}, 6) + 0e0 AS {c}" for c in columns)


def _latest(table: str, columns: str, key: str = "symbol") -> str:
    part = f"PARTITION BY {key} " if key else ""
    return f"SELECT {columns} FROM (SELECT *, row_number() OVER ({part}ORDER BY time DESC) AS rn_ FROM {table} WHERE time < DATE '{DATE}' + INTERVAL 1 DAY) x WHERE rn_ = 1"


THRESHOLDS = "-0.1e0 AS m_3_threshold, -0.05e0 AS m_1_threshold, 75e0 AS rsi_14_threshold, 90e0 AS vol_20d_pct_126_threshold, 0.12e0 AS rsi_14_close_threshold, 0.7e0 AS volume_ratio_threshold"
VOLS = ["vol_20d", "vol_60d", "vol_126d", "vol_252d", "atr_14_r", "parkinson_20d"]
FEAT = ["sma_20", "sma_50", "sm_1", "sm_3", "sm_6", "rsi_14", "vol_20d_pct_126", "atr_14_w"]
VN = ["vnim_1", "vnim_3", "vnim_6"]
M = ["m_1", "m_3", "m_6", "m_12"]

ORACLES = {
    "ohlcv_view": sql("SELECT * FROM ohlcv", "ohlcv"),
    "index_view": sql(f"SELECT time, open, high, low, close, volume, {r('change_percentage')} FROM vnindex", "vnindex"),
    "universe_industry_exchange": f"SELECT i.symbol FROM ({fixtures.INDUSTRY_SQL}) i JOIN ({fixtures.EXCHANGE_SQL}) e ON i.symbol = e.symbol WHERE i.icb_name4 IN ('Industry 0', 'Industry 2') AND e.exchange = 'HSX' AND i.symbol <> 'Brand#12'",
    "universe_in_list": sql("SELECT DISTINCT symbol FROM ohlcv WHERE symbol IN ('Brand#11', 'Brand#22', 'Brand#33', 'Brand#99')", "ohlcv"),
    "symbol_difference": f"SELECT symbol FROM ({fixtures.INDUSTRY_SQL}) i WHERE symbol NOT IN (SELECT symbol FROM ({fixtures.EXCHANGE_SQL}) e WHERE exchange = 'HSX')",
    "stock_momentum": sql(f"SELECT symbol, time, {r(*M)} FROM mom", "mom"),
    "momentum_latest": sql(_latest("mom", f"symbol, time, {r(*M)}"), "mom"),
    "momentum_composite": sql(f"SELECT symbol, time, {r('m_3', 'm_6', 'm_12')}, round((m_3+m_6+m_12)/3, 6) + 0e0 AS m_composite FROM mom", "mom"),
    "stock_sma": sql(f"SELECT symbol, time, {r('sma_20', 'sma_50', 'sma_200')} FROM sma", "sma"),
    "stock_volume": sql(f"SELECT symbol, time, {r('vol_20d', 'vol_60d', 'volume_ratio', 'volume_spike')} FROM volume", "volume"),
    "stock_rsi": sql(f"SELECT symbol, time, {r('rsi_14', 'average_gain_14', 'average_loss_14')} FROM rsi", "rsi"),
    "stock_volatility": sql(f"SELECT symbol, time, {r(*VOLS)} FROM vols", "vols"),
    "stock_atr_wilder": sql("SELECT b.symbol, b.time, round(a, 6) + 0e0 AS atr_14_w FROM b LEFT JOIN atr_r USING (symbol, i)", "atr_r"),
    "atr_ewm": sql("SELECT b.symbol, b.time, round(a, 6) + 0e0 AS atr_14_e FROM b LEFT JOIN atr_e USING (symbol, i)", "atr_e"),
    "vol_percentile": sql("SELECT v.symbol, v.time, round(p.p, 6) + 0e0 AS vol_20d_pct_126, round(q.p, 6) + 0e0 AS vol_20d_pct_252 FROM vols v JOIN pct126 p USING (symbol, i) JOIN pct252 q USING (symbol, i)", "pct126", "pct252"),
    "index_momentum": sql(f"SELECT time, {r('m_21d', 'm_60d', 'm_126d')} FROM imom", "imom"),
    "index_sma": sql(f"SELECT time, {r('sma_150')} FROM isma", "isma"),
    "index_drawdown": sql(f"SELECT time, {r('drawdown_40d')} FROM idd", "idd"),
    "index_volatility": sql(f"SELECT time, {r('vol_20d')} FROM ivol", "ivol"),
    "regime": sql("SELECT time, 0.03e0 AS m_60d_threshold, -0.08e0 AS drawdown_40d_threshold, 0.25e0 AS vol_20d_threshold, suggestion, positive_streak FROM reg", "reg"),
    **{f"structural_v{v}": sql(f"SELECT symbol, time, {THRESHOLDS}, suggestion, positive_streak FROM str_{v}", f"str_{v}") for v in (1, 2, 3)},
    "feature_join": sql(f"SELECT symbol, time, {r('close', 'volume', *FEAT, 'volume_ratio', *VN)} FROM featx", "featx"),
    "agent_features": sql(f"SELECT time, symbol, {r('close', *FEAT, *VN)} FROM featx WHERE symbol = '{SYMBOL}' AND time >= '{START}'::TIMESTAMP", "featx"),
    **{f"rank_v{v}": sql(f"SELECT time, symbol, {r('alpha_score')} FROM rank_all_{v}", f"rank_all_{v}") for v in (1, 2, 3)},
    **{f"rank_v{v}_possible": sql(f"SELECT time, symbol, {r('alpha_score')} FROM rank_possible_v{v}_{v}", f"rank_possible_v{v}_{v}") for v in (1, 2, 3)},
    "rank_v2_plain": sql(f"SELECT time, symbol, {r('alpha_score')} FROM rank_all_2_plain", "rank_all_2_plain"),
    "rank_mean": sql(f"SELECT time, symbol, {r('alpha_score')} FROM rank_all_2_mean", "rank_all_2_mean"),
    "forward_returns": sql(
        f"""SELECT symbol, time, close, close_20 FROM (SELECT symbol, time, close, lag(close, 7) OVER (PARTITION BY symbol ORDER BY time DESC) AS close_20 FROM ohlcv
 JOIN (SELECT DISTINCT symbol FROM feat WHERE time BETWEEN '{START}'::TIMESTAMP AND '{END}'::TIMESTAMP AND {CONDITION[1]}) s USING (symbol)) t WHERE time BETWEEN '{START}'::TIMESTAMP AND '{END}'::TIMESTAMP""",
        "feat",
    ),
    "ic_daily": sql(f"SELECT time, {r('ic')}, n FROM ic_all", "ic_all"),
    "ic_daily_possible": sql(f"SELECT time, {r('ic')}, n FROM ic_possible_v2", "ic_possible_v2"),
    "ic_summary": sql("SELECT round(avg(ic), 6) + 0e0 AS ic_mean, round(stddev_samp(ic), 6) + 0e0 AS ic_std, count(*) AS n_days, round(avg(ic)/(stddev_samp(ic)/sqrt(count(*))), 6) + 0e0 AS ic_tstat, round(avg(coalesce(ic > 0, false)::INT), 6) + 0e0 AS positive_share FROM ic_all", "ic_all"),
    "ic_newey_west": sql(
        """SELECT round(m, 6) + 0e0 AS mean, n, round(m/sqrt(s/n), 6) + 0e0 AS tstat FROM (SELECT any_value(m) AS m, any_value(n) AS n, sum(CASE WHEN l = 0 THEN 1e0 ELSE 2e0*(1e0-l/21e0) END * g) AS s FROM (
 SELECT b.k - a.k AS l, any_value(a.m) AS m, any_value(a.n) AS n, sum((a.ic-a.m)*(b.ic-b.m))/any_value(a.n) AS g FROM e a JOIN e b ON b.k - a.k BETWEEN 0 AND 20 GROUP BY b.k - a.k) x) y""",
        "ic_all",
    ).replace("\nSELECT round(m", ",\ne AS MATERIALIZED (SELECT ic, row_number() OVER (ORDER BY time) AS k, avg(ic) OVER () AS m, count(*) OVER () AS n FROM ic_all WHERE ic IS NOT NULL)\nSELECT round(m"),
    "factor_decay": sql(
        f"""SELECT horizon::BIGINT AS horizon, round(avg(ic), 6) + 0e0 AS mean_ic, count(ic) AS n_days FROM (SELECT time, horizon, {IC} AS ic FROM (
 SELECT time, horizon, 2 * rank() OVER (PARTITION BY time, horizon ORDER BY alpha_score) + count(*) OVER (PARTITION BY time, horizon, alpha_score) - 1 AS x, 2 * rank() OVER (PARTITION BY time, horizon ORDER BY r) + count(*) OVER (PARTITION BY time, horizon, r) - 1 AS y FROM (
  SELECT time, alpha_score, h AS horizon, greatest(least(list_extract([{', '.join(f'c{h}' for h in range(5, 65, 5))}], h // 5) / close - 1, 0.5e0), -0.5e0) AS r FROM rank_all_3
  JOIN (SELECT symbol, time, close, {', '.join(f'lead(close, {h}) OVER w AS c{h}' for h in range(5, 65, 5))} FROM ohlcv {W}) f USING (symbol, time) CROSS JOIN (SELECT unnest(range(5, 65, 5)) AS h) hs
  WHERE alpha_score IS NOT NULL AND {' AND '.join(f'c{h} IS NOT NULL' for h in range(5, 65, 5))}) a) b GROUP BY time, horizon) c GROUP BY horizon""",
        "rank_all_3",
    ),
    **{f"spread_daily{s}": sql(f"SELECT time, {r('top_return', 'bottom_return', 'spread')}, top_n, universe_size FROM sp_{u}", f"sp_{u}") for s, u in (("", "all"), ("_possible", "possible_v2"))},
    "spread_summary": sql(
        "SELECT round(avg(spread), 6) + 0e0 AS spread_mean, round(stddev_samp(spread), 6) + 0e0 AS spread_std, count(*) AS n_days, round(avg((spread > 0)::INT), 6) + 0e0 AS positive_share, round(avg(top_return), 6) + 0e0 AS mean_top_return, round(avg(bottom_return), 6) + 0e0 AS mean_bottom_return, round(avg(universe_size), 6) + 0e0 AS mean_universe_size, round(avg(top_n), 6) + 0e0 AS mean_top_n, round(avg(spread)/(stddev_samp(spread)/sqrt(count(*))), 6) + 0e0 AS spread_tstat FROM sp_all",
        "sp_all",
    ),
    "spread_equity": sql("SELECT time, round(spread, 6) + 0e0 AS spread, round(product(1 + spread) OVER (ORDER BY time), 6) + 0e0 AS cum_spread FROM sp_all", "sp_all"),
    **{f"quintile_returns{s}": sql(f"SELECT quintile, {r('mean_return')}, n_days FROM qr_{u}", f"qr_{u}") for s, u in (("", "all"), ("_possible", "possible_v2"))},
    **{f"signals_{s}": sql(f"SELECT symbol, time, {r('close', 'rsi_14')}{', score' if s == 'bsr' else ''}, up, down FROM sig_{s} WHERE up OR down", f"sig_{s}") for s in ("bsr", "pvd")},
    **{
        f"trades_{s}_{v}": sql(
            f"""SELECT a.symbol, a.time AS entry_time, x.time AS exit_time, {r('entry_price', 'exit_price')}, round(exit_price/entry_price - 1, 6) + 0e0 AS "return", (x.n - a.n)::BIGINT AS holding_days FROM (
 SELECT a.symbol, a.time, a.n, a.close AS entry_price, min(x.n) AS m FROM sig_{s} a JOIN sig_{s} x ON x.symbol = a.symbol AND x.down AND x.n >= a.n + {h} WHERE a.up GROUP BY ALL) a JOIN (SELECT symbol, time, n, close AS exit_price FROM sig_{s}) x ON x.symbol = a.symbol AND x.n = a.m""",
            f"sig_{s}",
        )
        for s in ("bsr", "pvd")
        for v, h in (("v2", 15), ("v1", 1))
    },
    "rsi_step": sql(_latest("rsi", f"symbol, time, {r('rsi_14', 'average_gain_14', 'average_loss_14')}"), "rsi"),
    "atr_step": sql(_latest("(SELECT symbol, time, a AS atr_14_w FROM b LEFT JOIN atr_r USING (symbol, i)) y", f"symbol, time, {r('atr_14_w')}"), "atr_r"),
    "streak_step": sql(_latest("str_1", "symbol, time, suggestion, positive_streak"), "str_1"),
    **{f"structural_step_v{v}": sql(_latest(f"str_{v}", "symbol, time, suggestion, positive_streak"), f"str_{v}") for v in (2, 3)},
    **{f"incremental_rank_v{v}": sql(f"SELECT time, symbol, {r('alpha_score')} FROM rank_all_{v} WHERE time = '{DATE} 07:00:00'::TIMESTAMP", f"rank_all_{v}") for v in (1, 2)},
    "ranking_order": sql("SELECT time, symbol, row_number() OVER (PARTITION BY time ORDER BY alpha_score DESC NULLS LAST, symbol) AS place FROM rank_all_3", "rank_all_3"),
    "prices_between": sql(f"SELECT symbol, time, close FROM ohlcv WHERE symbol = '{SYMBOL}' AND time BETWEEN '{START}'::TIMESTAMP AND '{END}'::TIMESTAMP", "ohlcv"),
    "vendor_bars": sql(f"SELECT 'X' AS symbol, time, open, high, low, close, volume FROM ohlcv WHERE symbol = '{SYMBOL}'", "ohlcv"),
    "incremental_regime": sql(_latest("reg", "time, suggestion, positive_streak", ""), "reg"),
    "last_n_window": sql(f"SELECT symbol, time, close FROM (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY time DESC) AS k FROM ohlcv WHERE time < DATE '{DATE}' + INTERVAL 1 DAY) x WHERE k <= 21", "ohlcv"),
    "incremental_sma": sql(_latest("sma", f"symbol, time, {r('sma_20', 'sma_50', 'sma_200')}"), "sma"),
    "incremental_volume": sql(_latest("volume", f"symbol, time, {r('vol_20d', 'vol_60d', 'volume_ratio', 'volume_spike')}"), "volume"),
    "incremental_volatility": sql(_latest("(SELECT v.*, p.p AS vol_20d_pct_126, q.p AS vol_20d_pct_252 FROM vols v JOIN pct126 p USING (symbol, i) JOIN pct252 q USING (symbol, i)) y", f"symbol, time, {r(*VOLS, 'vol_20d_pct_126', 'vol_20d_pct_252')}"), "pct126", "pct252"),
    "incremental_index_momentum": sql(_latest("imom", f"time, {r('m_21d', 'm_60d', 'm_126d')}", ""), "imom"),
    "incremental_index_sma": sql(_latest("isma", f"time, {r('sma_150')}", ""), "isma"),
    "incremental_index_drawdown": sql(_latest("idd", f"time, {r('drawdown_40d')}", ""), "idd"),
    "incremental_index_volatility": sql(_latest("ivol", f"time, {r('vol_20d')}", ""), "ivol"),
    "incremental_rank": sql(f"SELECT time, symbol, {r('alpha_score')} FROM rank_all_3 WHERE time = '{DATE} 07:00:00'::TIMESTAMP", "rank_all_3"),
    "upsert_prices": sql(
        f"""SELECT * FROM ohlcv WHERE time < '{END}'::TIMESTAMP UNION ALL SELECT symbol, time, open, high, low, close + 1, volume FROM ohlcv WHERE time >= '{END}'::TIMESTAMP
 UNION ALL SELECT symbol || 'x', time, open, high, low, close, volume FROM ohlcv WHERE time >= '{END}'::TIMESTAMP""",
        "ohlcv",
    ),
    "scoped_replace": sql(f"SELECT symbol, time, round(m_1 * CASE WHEN symbol = '{SYMBOL}' AND time >= '{START}'::TIMESTAMP THEN 2e0 ELSE 1e0 END, 6) + 0e0 AS m_1, {r('m_3', 'm_6', 'm_12')} FROM mom", "mom"),
    "range_replace": sql("SELECT time, symbol, CASE WHEN time BETWEEN '1995-03-01 07:00:00'::TIMESTAMP AND '1995-03-31 07:00:00'::TIMESTAMP THEN 0.5e0 ELSE round(alpha_score, 6) + 0e0 END AS alpha_score FROM rank_all_1", "rank_all_1"),
    "parse_index_csv": f"""SELECT strptime(trim(time), '%d/%m/%Y') + INTERVAL 7 HOURS AS time, replace(trim(open), ',', '')::DOUBLE AS open, replace(trim(high), ',', '')::DOUBLE AS high, replace(trim(low), ',', '')::DOUBLE AS low, replace(trim(close), ',', '')::DOUBLE AS close,
 round_even(nullif(regexp_extract(upper(volume), '([\\d.]+)([KMB])', 1), '')::DOUBLE * CASE regexp_extract(upper(volume), '([\\d.]+)([KMB])', 2) WHEN 'K' THEN 1e3 WHEN 'M' THEN 1e6 WHEN 'B' THEN 1e9 END, 0)::DOUBLE AS volume, replace(trim(change_percentage), '%', '')::DOUBLE AS change_percentage FROM ({fixtures.RAW_INDEX_SQL}) y""",
    "date_sequence": sql("SELECT unnest(generate_series((SELECT min(time) FROM ohlcv), (SELECT max(time) FROM ohlcv), INTERVAL 1 DAY)) AS time", "ohlcv"),
}

_PAIRS = [(a, b) for k, a in enumerate(["momentum_adjusted", "trend_score", "volatility_score", "rsi_14_z"]) for b in ["momentum_adjusted", "trend_score", "volatility_score", "rsi_14_z"][k + 1 :]]
ORACLES["factor_corr"] = sql(
    "\nUNION ALL ".join(
        f"SELECT time, '{a}' AS factor_a, '{b}' AS factor_b, round(covar_pop({a}, {b}) / nullif(stddev_pop({a}) FILTER ({b} IS NOT NULL) * stddev_pop({b}) FILTER ({a} IS NOT NULL), 0), 6) + 0e0 AS correlation FROM f_possible_v2_2 GROUP BY time HAVING count(*) >= 5" for a, b in _PAIRS
    ),
    "f_possible_v2_2",
)
_SHOWN = ["time", "symbol", "close", "atr_14_w", "rsi_14", "sm_1", "sm_3", "sm_6", "sma_20", "sma_50", "vnim_1", "vnim_3", "vnim_6", "vol_20d_pct_126"]


def _cell(c: str) -> str:
    return "strftime(time, '%Y-%m-%dT%H:%M:%S')" if c == "time" else "symbol" if c == "symbol" else f"coalesce(printf('%.4f', {c}), 'None')"


ORACLES["agent_table"] = sql(
    f"""SELECT (k + 1)::BIGINT AS line_no, {" || ' | ' || ".join(f"rpad(c_{c}, w_{c}, ' ')" for c in _SHOWN)} AS line FROM c, wd
UNION ALL SELECT 0::BIGINT, {" || ' | ' || ".join(f"rpad('{c}', w_{c}, ' ')" for c in _SHOWN)} FROM wd UNION ALL SELECT 1::BIGINT, {" || '-+-' || ".join(f"repeat('-', w_{c})" for c in _SHOWN)} FROM wd""",
    "featx",
).replace(
    "\nSELECT (k + 1)",
    f",\nc AS MATERIALIZED (SELECT row_number() OVER (ORDER BY time DESC) AS k, {', '.join(f'{_cell(c)} AS c_{c}' for c in _SHOWN)} FROM featx WHERE symbol = '{SYMBOL}' AND time >= '1998-01-01'::TIMESTAMP),\n"
    f"wd AS MATERIALIZED (SELECT {', '.join(f'greatest(coalesce(max(length(c_{c})), 0), {len(c)})::INT AS w_{c}' for c in _SHOWN)} FROM c)\nSELECT (k + 1)",
    1,
)

#: The same results by two-level scans.
for _name, _plain in {"regime_by_blocks": "regime", "index_momentum_by_blocks": "index_momentum", "stock_rsi_by_blocks": "stock_rsi", "stock_volatility_by_blocks": "stock_volatility", "spread_equity_by_blocks": "spread_equity", "newey_west_by_blocks": "ic_newey_west"}.items():
    ORACLES[_name] = ORACLES[_plain]

for _name, _plain, _columns in (("momentum_pipeline", "stock_momentum", "*"), ("rsi_pipeline", "stock_rsi", "*"), ("decision_pipeline", "structural_v1", "symbol, time, suggestion, positive_streak")):
    ORACLES[_name] = f"SELECT {_columns} FROM ({ORACLES[_plain]}) y WHERE time < '{END}'::TIMESTAMP + INTERVAL 1 DAY"
ORACLES["missing_symbols_pipeline"] = f"SELECT * FROM ({ORACLES['ohlcv_view']}) y WHERE symbol < 'Brand#3' OR symbol IN (SELECT symbol FROM ({fixtures.EXCHANGE_SQL}) x WHERE exchange = 'HSX')"
ORACLES["committed_scope"] = f"SELECT * REPLACE (volume + (symbol = '{SYMBOL}' AND year(time) = 1995)::BIGINT AS volume) FROM ({ORACLES['ohlcv_view']}) y"
ORACLES["bars_source_whole"] = ORACLES["bars_source_stream"] = ORACLES["ohlcv_view"]
ORACLES["bars_source_filtered"] = f"SELECT symbol, time, close FROM ({ORACLES['ohlcv_view']}) y WHERE symbol IN ('Brand#11', 'Brand#22') AND time BETWEEN '{START}'::TIMESTAMP AND '{END}'::TIMESTAMP"
ORACLES["feature_join_stored"] = ORACLES["feature_join"]
ORACLES["agent_json"] = ORACLES["agent_features"]
ORACLES["agent_prompt"] = f"SELECT 'Judge these rows.' || chr(10) || string_agg(line, chr(10) ORDER BY line_no) AS prompt FROM ({ORACLES['agent_table']}) y"
ORACLES["trades_csv"] = ORACLES["trades_bsr_v2"]
ORACLES["parallel_pipelines"] = f"""SELECT symbol, time, m_3, sma_50, volume_ratio FROM ({ORACLES['stock_momentum']}) m JOIN ({ORACLES['stock_sma']}) a USING (symbol, time) JOIN ({ORACLES['stock_volume']}) v USING (symbol, time)
WHERE time < '{END}'::TIMESTAMP + INTERVAL 1 DAY"""
ORACLES["rolling_stream"] = sql(f"SELECT symbol, time, {r(*M, 'sma_20', 'sma_50', 'sma_200', 'vol_20d', 'vol_60d', 'volume_ratio', 'volume_spike')} FROM mom JOIN sma USING (symbol, time) JOIN volume USING (symbol, time) WHERE time < (SELECT max(time) FROM ohlcv) - INTERVAL 30 DAY", "mom", "sma", "volume")
ORACLES["asof_month_close"] = sql(
    """SELECT o.symbol, o.time, o.close, m.time AS since, round(o.close / m.close - 1, 6) + 0e0 AS moved
 FROM ohlcv o ASOF LEFT JOIN (SELECT symbol, max(time) AS time, arg_max(close, time) AS close FROM ohlcv GROUP BY symbol, date_trunc('month', time)) m ON o.symbol = m.symbol AND o.time > m.time""",
    "ohlcv",
)
for _v in (1, 2, 3):
    ORACLES[f"rank_v{_v}_by_parts"] = ORACLES[f"rank_v{_v}"]
ORACLES["rank_v2_possible_by_parts"] = ORACLES["rank_v2_possible"]
_EDGES = {"m1": "m1", "trend": "cs", "atr": "ax", "vol": "vp"}
ORACLES["session_quantiles"] = sql(
    " UNION ALL ".join(f"SELECT time, '{f}' AS factor, {p}e0 AS p, count({x}) AS n, round(quantile_cont({x}, {p}), 6) + 0e0 AS quantile FROM u_all GROUP BY time HAVING count({x}) > 0" for f, x in _EDGES.items() for p in (0.05, 0.95)),
    "u_all",
)
_LINES = {"value": "l_extendedprice::DOUBLE", "price": "l_extendedprice::DOUBLE / nullif(l_quantity::DOUBLE, 0)"}
ORACLES["trade_quantiles"] = " UNION ALL ".join(
    f"SELECT l_returnflag AS flag, '{f}' AS factor, {p}e0 AS p, count({x}) AS n, round(quantile_cont({x}, {p}), 6) + 0e0 AS quantile FROM lineitem GROUP BY l_returnflag" for f, x in _LINES.items() for p in (0.01, 0.25, 0.5, 0.75, 0.99)
)
ORACLES["vol_percentile_by_blocks"] = ORACLES["vol_percentile"]
