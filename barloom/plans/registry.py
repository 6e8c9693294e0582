"""Registered queries: the operators on the derived bars, computed doubles rounded to six digits."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.functions import slidingrank
from barloom.operators import asof, backtest, crosssection, decisions, indicators, longseries, pipelines, ranking, serving, state, trades
from barloom.sources import bars_source, fixtures, ingest, layout, storage
from barloom.sources.commits import CommittedTable
from barloom.streaming import windows

#: The day up to which incremental steps look, and the range of forward returns and simulations.
DATE, START, END = "1997-06-30", "1994-01-01", "1997-12-31"
SYMBOL = "Brand#11"
QUERIES: dict = {}


def rounded(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Doubles to six digits, and no negative zero."""
    return df.select(*[(F.round(F.col(c), 6) + F.lit(0.0)).alias(c) if t == "double" and c not in keep else F.col(c) for c, t in df.dtypes])


def query(f):
    QUERIES[f.__name__] = f
    return f


def bars(s: SparkSession, d: str) -> DataFrame:
    return fixtures.ohlcv_prices(s, d)


def index(s: SparkSession, d: str) -> DataFrame:
    return fixtures.vnindex_history(s, d)


def features(s: SparkSession, d: str, ahead: tuple[int, ...] = ()) -> DataFrame:
    return indicators.features(bars(s, d), indicators.index_momentum(index(s, d)), ahead)


@query
def ohlcv_view(s, d):
    return bars(s, d)


@query
def index_view(s, d):
    return rounded(index(s, d), keep=("open", "high", "low", "close"))


@query
def universe_industry_exchange(s, d):
    by_exchange, by_industry = fixtures.symbol_by_exchange(s, d), fixtures.symbol_by_industry(s, d)
    met = by_industry.join(by_exchange, "symbol").filter(F.col("icb_name4").isin("Industry 0", "Industry 2") & (F.col("exchange") == "HSX") & (F.col("symbol") != "Brand#12"))
    return met.select("symbol")


@query
def universe_in_list(s, d):
    return bars(s, d).filter(F.col("symbol").isin("Brand#11", "Brand#22", "Brand#33", "Brand#99")).select("symbol").distinct()


@query
def symbol_difference(s, d):
    liquid = fixtures.symbol_by_exchange(s, d).filter("exchange = 'HSX'")
    return state.difference(fixtures.symbol_by_industry(s, d).select("symbol"), liquid, "symbol")


@query
def stock_momentum(s, d):
    return rounded(indicators.stock_momentum(bars(s, d)))


@query
def momentum_latest(s, d):
    return rounded(state.incremental(indicators.stock_momentum, bars(s, d), 253, DATE))


@query
def momentum_composite(s, d):
    return rounded(indicators.momentum_composite(bars(s, d)))


@query
def stock_sma(s, d):
    return rounded(indicators.stock_moving_average(bars(s, d)))


@query
def stock_volume(s, d):
    return rounded(indicators.stock_volume(bars(s, d)))


@query
def stock_rsi(s, d):
    return rounded(indicators.stock_rsi(bars(s, d)))


@query
def stock_volatility(s, d):
    return rounded(indicators.stock_volatility(bars(s, d)).select("symbol", "time", "vol_20d", "vol_60d", "vol_126d", "vol_252d", "atr_14_r", "parkinson_20d"))


@query
def stock_atr_wilder(s, d):
    return rounded(indicators.stock_volatility(bars(s, d)).select("symbol", "time", "atr_14_w"))


@query
def atr_ewm(s, d):
    return rounded(indicators.stock_atr_ewm(bars(s, d)))


@query
def vol_percentile(s, d):
    return rounded(indicators.stock_volatility(bars(s, d)).select("symbol", "time", "vol_20d_pct_126", "vol_20d_pct_252"))


@query
def index_momentum(s, d):
    return rounded(indicators.index_momentum(index(s, d)))


@query
def index_sma(s, d):
    return rounded(indicators.index_moving_average(index(s, d)))


@query
def index_drawdown(s, d):
    return rounded(indicators.index_drawdown(index(s, d)))


@query
def index_volatility(s, d):
    return rounded(indicators.index_volatility(index(s, d)))


@query
def regime(s, d):
    return decisions.regime(decisions.regime_input(index(s, d)))


@query
def structural_v1(s, d):
    return decisions.structural(indicators.features(bars(s, d)), 1)


@query
def structural_v2(s, d):
    return decisions.structural(indicators.features(bars(s, d)), 2)


@query
def structural_v3(s, d):
    return decisions.structural(indicators.features(bars(s, d)), 3)


@query
def feature_join(s, d):
    b = bars(s, d)
    out = indicators.joined_features(
        b, indicators.stock_momentum(b), indicators.stock_moving_average(b), indicators.stock_rsi(b), indicators.stock_volatility(b), indicators.index_momentum(index(s, d)), indicators.stock_volume(b)
    )
    return rounded(out.select("symbol", "time", "close", "volume", "sma_20", "sma_50", "sm_1", "sm_3", "sm_6", "rsi_14", "vol_20d_pct_126", "atr_14_w", "volume_ratio", "vnim_1", "vnim_3", "vnim_6"))


@query
def agent_features(s, d):
    return rounded(serving.agent_features(features(s, d), START, SYMBOL))


@query
def agent_table(s, d):
    return serving.render_table(serving.agent_features(features(s, d), "1998-01-01", SYMBOL))


def _rank(version: int, kind: str | None = None, universe: str = "all"):
    return lambda s, d: rounded(ranking.rank(features(s, d), version, kind, universe))


for _name, _args in {"rank_v1": (1,), "rank_v2": (2,), "rank_v3": (3,), "rank_v2_plain": (2, "plain"), "rank_mean": (2, "mean"), "rank_v1_possible": (1, None, "possible_v1"), "rank_v2_possible": (2, None, "possible_v2"), "rank_v3_possible": (3, None, "possible_v3")}.items():
    QUERIES[_name] = _rank(*_args)


@query
def factor_corr(s, d):
    return rounded(ranking.factor_correlation(ranking.factors(ranking.in_universe(features(s, d), "possible_v2"), 2), 5))


@query
def forward_returns(s, d):
    f = features(s, d)
    some = f.filter((F.col("time") >= F.lit(START).cast("timestamp_ntz")) & (F.col("time") <= F.lit(END).cast("timestamp_ntz")) & decisions.possible(1))
    return backtest.forward_returns(bars(s, d), some, START, END)


def ranked_ahead(s: SparkSession, d: str, horizons: tuple[int, ...], universe: str = "all", version: int = 3) -> DataFrame:
    """A ranking beside the closes that its returns need: one pass over the bars for both."""
    return ranking.rank(features(s, d, horizons), version, None, universe, ("close", *[f"close_ahead_{h}" for h in horizons]))


def scored(s: SparkSession, d: str, universe: str = "all") -> DataFrame:
    return backtest.scored_returns(ranked_ahead(s, d, (backtest.HORIZON,), universe))


@query
def ic_daily(s, d):
    return rounded(backtest.ic_daily(scored(s, d)).select("time", "ic", F.col("n").cast("long").alias("n")))


@query
def ic_daily_possible(s, d):
    return rounded(backtest.ic_daily(scored(s, d, "possible_v2")).select("time", "ic", F.col("n").cast("long").alias("n")))


@query
def ic_summary(s, d):
    return rounded(backtest.ic_summary(backtest.ic_daily(scored(s, d))))


@query
def ic_newey_west(s, d):
    return rounded(backtest.newey_west(backtest.ic_daily(scored(s, d))))


@query
def factor_decay(s, d):
    return rounded(backtest.factor_decay(ranked_ahead(s, d, backtest.DECAY_HORIZONS)))


@query
def spread_daily(s, d):
    return rounded(backtest.spread_daily(scored(s, d)))


@query
def spread_daily_possible(s, d):
    return rounded(backtest.spread_daily(scored(s, d, "possible_v2")))


@query
def spread_summary(s, d):
    return rounded(backtest.spread_summary(backtest.spread_daily(scored(s, d))))


@query
def spread_equity(s, d):
    return rounded(backtest.spread_equity(backtest.spread_daily(scored(s, d))))


@query
def quintile_returns(s, d):
    return rounded(backtest.quintile_returns(scored(s, d)))


@query
def quintile_returns_possible(s, d):
    return rounded(backtest.quintile_returns(scored(s, d, "possible_v2")))


def _signals(strategy: str):
    def run(s, d):
        x = trades.signals(features(s, d), strategy, START).filter("up OR down")
        score = ["score"] if strategy == "bsr" else []
        return rounded(x.select("symbol", "time", "close", "rsi_14", *score, "up", "down"))

    return run


def _trades(strategy: str, hold: int):
    return lambda s, d: rounded(trades.trades(trades.signals(features(s, d), strategy, START), hold))


for _s in ("bsr", "pvd"):
    QUERIES[f"signals_{_s}"] = _signals(_s)
    QUERIES[f"trades_{_s}_v2"] = _trades(_s, trades.MIN_HOLD)
    QUERIES[f"trades_{_s}_v1"] = _trades(_s, 1)


@query
def rsi_step(s, d):
    b = bars(s, d)
    return rounded(state.rsi_step(indicators.stock_rsi(b), b, DATE))


@query
def atr_step(s, d):
    b = bars(s, d)
    return rounded(state.atr_step(indicators.stock_volatility(b).select("symbol", "time", "atr_14_w"), b, DATE))


@query
def streak_step(s, d):
    f = indicators.features(bars(s, d))
    return state.decision_step(decisions.structural(f, 1), state.latest(f, DATE), decisions.possible(1), "symbol", "POSSIBLE", "AVOID")


def _structural_step(version: int):
    def run(s, d):
        f = indicators.features(bars(s, d))
        return state.decision_step(decisions.structural(f, version), state.latest(f, DATE), decisions.possible(version), "symbol", "POSSIBLE", "AVOID")

    return run


def _incremental_rank(version: int):
    return lambda s, d: rounded(ranking.rank(features(s, d).filter(F.col("time") == state.session(DATE)), version))


for _v in (2, 3):
    QUERIES[f"structural_step_v{_v}"] = _structural_step(_v)
for _v in (1, 2):
    QUERIES[f"incremental_rank_v{_v}"] = _incremental_rank(_v)


@query
def ranking_order(s, d):
    """Each symbol's place within its session."""
    return ranking.placed(ranking.rank(features(s, d), 3)).select("time", "symbol", "place")


@query
def prices_between(s, d):
    return ingest.query(s, "SELECT symbol, time, close FROM {bars} WHERE symbol = :symbol AND time BETWEEN CAST(:start AS TIMESTAMP_NTZ) AND CAST(:end AS TIMESTAMP_NTZ)", {"bars": bars(s, d)}, symbol=SYMBOL, start=START, end=END)


@query
def vendor_bars(s, d):
    """One symbol's bars as a vendor gives them: without the symbol, all of them text."""
    raw = bars(s, d).filter(F.col("symbol") == SYMBOL).drop("symbol")
    return ingest.vendor_bars(raw.select("time", *[F.col(x).cast("string").alias(x) for x in ("open", "high", "low", "close", "volume")]), "X")


@query
def incremental_regime(s, d):
    f = decisions.regime_input(index(s, d))
    return state.decision_step(decisions.regime(f), state.latest(f, DATE, None), decisions.safe(), None, "SAFE", "DEFENSIVE")


@query
def last_n_window(s, d):
    return state.last_n(bars(s, d), 21, DATE).select("symbol", "time", "close")


def _incremental(compute, rows: int, of_symbols: bool = True, columns: tuple[str, ...] = ()):
    def run(s, d):
        out = state.incremental(compute, bars(s, d) if of_symbols else index(s, d), rows, DATE, "symbol" if of_symbols else None)
        return rounded(out.select(*columns) if columns else out)

    return run


for _name, _args in {
    "incremental_sma": (indicators.stock_moving_average, 201),
    "incremental_volume": (indicators.stock_volume, 61),
    "incremental_volatility": (indicators.stock_volatility, 272, True, ("symbol", "time", "vol_20d", "vol_60d", "vol_126d", "vol_252d", "atr_14_r", "parkinson_20d", "vol_20d_pct_126", "vol_20d_pct_252")),
    "incremental_index_momentum": (indicators.index_momentum, 127, False),
    "incremental_index_sma": (indicators.index_moving_average, 151, False),
    "incremental_index_drawdown": (indicators.index_drawdown, 40, False),
    "incremental_index_volatility": (indicators.index_volatility, 21, False),
}.items():
    QUERIES[_name] = _incremental(*_args)


@query
def incremental_rank(s, d):
    return rounded(ranking.rank(features(s, d).filter(F.col("time") == state.session(DATE)), 3))


@query
def upsert_prices(s, d):
    b = bars(s, d)
    late = b.filter(F.col("time") >= F.lit(END).cast("timestamp_ntz"))
    new = late.withColumn("close", F.col("close") + 1).unionByName(late.withColumn("symbol", F.concat("symbol", F.lit("x"))))
    return state.upsert(b, new, ["symbol", "time"])


@query
def scoped_replace(s, d):
    m = indicators.stock_momentum(bars(s, d))
    scope = (F.col("symbol") == SYMBOL) & (F.col("time") >= F.lit(START).cast("timestamp_ntz"))
    return rounded(state.scoped_replace(m, m.filter(scope).withColumn("m_1", F.col("m_1") * 2), scope))


@query
def range_replace(s, d):
    r = ranking.rank(features(s, d), 1)
    scope = state.range_scope("1995-03-01", "1995-03-31")
    return rounded(state.scoped_replace(r, r.filter(scope).withColumn("alpha_score", F.lit(0.5)), scope))


@query
def parse_index_csv(s, d):
    """The index written as its text file, read and parsed again."""
    path = storage.fresh_path(s, "index-file")
    fixtures.index_file(s, d).write.option("header", True).option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    parsed = ingest.parse_index_csv(ingest.read_index_csv(s, path))
    return parsed.withColumn("volume", F.col("volume").cast("double"))  # NULL compares alike in any client


@query
def date_sequence(s, d):
    return state.date_sequence(bars(s, d))


#: Rows of a block of the two-level scans, so that the index of the given tables has eight.
BLOCK_ROWS = 320


@query
def regime_by_blocks(s, d):
    return longseries.regime(index(s, d), BLOCK_ROWS)


@query
def index_momentum_by_blocks(s, d):
    return rounded(longseries.index_momentum(index(s, d), BLOCK_ROWS))


@query
def stock_rsi_by_blocks(s, d):
    return rounded(longseries.stock_rsi(bars(s, d), BLOCK_ROWS))


@query
def stock_volatility_by_blocks(s, d):
    return rounded(longseries.stock_volatility(bars(s, d), BLOCK_ROWS).select("symbol", "time", "vol_20d", "vol_60d", "vol_126d", "vol_252d", "atr_14_r", "parkinson_20d"))


@query
def spread_equity_by_blocks(s, d):
    return rounded(longseries.spread_equity(backtest.spread_daily(scored(s, d)), BLOCK_ROWS))


@query
def newey_west_by_blocks(s, d):
    return rounded(longseries.newey_west(backtest.ic_daily(scored(s, d)), rows=BLOCK_ROWS))


def _table(s: SparkSession, name: str) -> CommittedTable:
    return CommittedTable(s, storage.fresh_path(s, name))


def _stored(pipeline: pipelines.Pipeline, given, columns: tuple[str, ...] = ()):
    """Backfill up to START, two steps of many sessions, one that finds nothing new, and what is then stored."""

    def run(s, d):
        table = _table(s, "pipeline")
        pipelines.run(pipeline, given(s, d), table, "backfill", START)
        for day in (DATE, END, END):
            pipelines.run(pipeline, given(s, d), table, "incremental", day)
        out = table.read()
        return rounded(out.select(*columns) if columns else out)

    return run


QUERIES["momentum_pipeline"] = _stored(pipelines.MOMENTUM, bars)
QUERIES["rsi_pipeline"] = _stored(pipelines.RSI, bars)
QUERIES["decision_pipeline"] = _stored(pipelines.structural(1), lambda s, d: indicators.features(bars(s, d)), ("symbol", "time", "suggestion", "positive_streak"))


@query
def missing_symbols_pipeline(s, d):
    """The universe's symbols that a stored table lacks, taken from the vendor's bars."""
    table, b = _table(s, "prices"), bars(s, d)
    table.replace(b.filter(F.col("symbol") < "Brand#3"))
    pipelines.ingest_missing(fixtures.symbol_by_exchange(s, d).filter("exchange = 'HSX'"), b, table)
    return table.read()


@query
def committed_scope(s, d):
    """A scoped delete and append in one commit, over a table of months."""
    table, b = _table(s, "prices"), bars(s, d)
    table.replace(b)
    scope = (F.col("symbol") == SYMBOL) & (F.year("time") == 1995)
    table.replace_scope(b.filter(scope).withColumn("volume", F.col("volume") + 1), scope)
    return table.read()


@query
def bars_source_whole(s, d):
    """All bars through the data source."""
    folder = storage.fresh_path(s, "published")
    bars_source.publish(bars(s, d), folder)
    return bars_source.published(s, folder)


@query
def bars_source_filtered(s, d):
    """Some symbols and sessions, left out by the reader."""
    folder = storage.fresh_path(s, "published")
    bars_source.publish(bars(s, d), folder)
    return bars_source.published(s, folder, ["Brand#11", "Brand#22"], START, END).select("symbol", "time", "close")


@query
def bars_source_stream(s, d):
    """Sessions published in two batches, taken by a streaming query that stops in between and goes on from its offset."""
    folder, out = storage.fresh_path(s, "published"), storage.fresh_path(s, "streamed")
    b = bars(s, d)
    early = F.col("time") <= F.lit(END).cast("timestamp_ntz")
    for part in (b.filter(early), b.filter(~early)):
        bars_source.publish(part, folder)
        bars_source.stream(s, folder).writeStream.format("parquet").option("path", f"{out}/rows").option("checkpointLocation", f"{out}/offsets").trigger(availableNow=True).start().awaitTermination()
    return s.read.schema(bars_source.SCHEMA).parquet(f"{out}/rows")


@query
def rolling_stream(s, d):
    """Momentum, averages and volumes of a stream of stored bars that come in two batches, the second with sessions that are
    late; the streaming query stops in between and goes on from its state."""
    folder, out = storage.fresh_path(s, "arriving"), storage.fresh_path(s, "rolled")
    b, end = bars(s, d), F.lit(END).cast("timestamp_ntz")
    late = (F.col("time") > end) | ((F.col("time") > end - F.expr("INTERVAL 20 DAYS")) & (F.dayofmonth("time") % 3 == 0))
    for part in (b.filter(~late), b.filter(late)):
        part.write.mode("append").parquet(folder)
        rows = windows.rolling_stream(s.readStream.schema(b.schema).parquet(folder), delay_days=30)
        rows.writeStream.format("parquet").option("path", f"{out}/rows").option("checkpointLocation", f"{out}/state").trigger(availableNow=True).start().awaitTermination()
    return rounded(s.read.schema(windows.OUTPUT).parquet(f"{out}/rows"))


@query
def asof_month_close(s, d):
    """Each bar beside the last close of an earlier month of its symbol, or of its own month's end, strictly before it."""
    b = bars(s, d)
    ends = b.groupBy("symbol", F.date_trunc("month", "time").alias("_m")).agg(F.max("time").alias("time"), F.max_by("close", "time").alias("close")).drop("_m")
    met = asof.as_of(b.select("symbol", "time", "close"), ends)
    return rounded(met.select("symbol", "time", "close", F.col("prev_time").alias("since"), (F.try_divide("close", "prev_close") - 1).alias("moved")), keep=("close",))


@query
def feature_join_stored(s, d):
    """The feature join from tables stored by symbol: no rows are exchanged, the small index table is broadcast."""
    b, stored = bars(s, d), layout.co_located(s)
    name, path = f"barloom_{storage.fresh_path(s, 'x').rpartition('-')[2]}", storage.fresh_path(s, "stored")
    tables = {"bars": b, "momentum": indicators.stock_momentum(b), "average": indicators.stock_moving_average(b), "rsi": indicators.stock_rsi(b), "volatility": indicators.stock_volatility(b), "volume": indicators.stock_volume(b)}
    for t, df in tables.items():
        layout.write_bucketed(df, f"{name}_{t}", f"{path}/{t}", 8)
    indicators.index_momentum(index(s, d)).write.parquet(f"{path}/index")
    read = {t: stored.table(f"{name}_{t}") for t in tables}
    out = indicators.joined_features(read["bars"], read["momentum"], read["average"], read["rsi"], read["volatility"], stored.read.parquet(f"{path}/index"), read["volume"])
    return rounded(out.select("symbol", "time", "close", "volume", "sma_20", "sma_50", "sm_1", "sm_3", "sm_6", "rsi_14", "vol_20d_pct_126", "atr_14_w", "volume_ratio", "vnim_1", "vnim_3", "vnim_6"))


@query
def agent_json(s, d):
    """The rows that are served as JSON, read back from it."""
    given = serving.agent_features(features(s, d), START, SYMBOL)
    text = serving.as_json(rounded(given))
    kinds = ", ".join(f"{c} {'string' if c == 'time' else t}" for c, t in given.dtypes)
    back = text.select(F.from_json("json", kinds).alias("j")).select("j.*")
    return back.withColumn("time", F.to_timestamp_ntz("time", F.lit("yyyy-MM-dd'T'HH:mm:ss")))


@query
def agent_prompt(s, d):
    return serving.prompt(serving.render_table(serving.agent_features(features(s, d), "1998-01-01", SYMBOL)), "Judge these rows.")


@query
def trades_csv(s, d):
    """Simulated trades, written as CSV by symbol and read back."""
    made = rounded(trades.trades(trades.signals(features(s, d), "bsr", START), trades.MIN_HOLD))
    path = storage.fresh_path(s, "trades")
    ingest.write_csv_by_symbol(made, path)
    schema = ", ".join(f"{c} {t}" for c, t in sorted(made.dtypes, key=lambda x: x[0] == "symbol"))
    return s.read.schema(schema).option("header", True).csv(path).select(*made.columns)


@query
def parallel_pipelines(s, d):
    """Three pipelines over one universe at once, and their tables joined."""
    b = bars(s, d)
    made = {"momentum": pipelines.MOMENTUM, "average": pipelines.MOVING_AVERAGE, "volume": pipelines.VOLUME}
    tables = {name: _table(s, name) for name in made}
    pipelines.run_all(s, {name: lambda p=p, name=name: pipelines.run(p, b, tables[name], "backfill", END) for name, p in made.items()})
    m, a, v = (tables[name].read() for name in made)
    return rounded(m.join(a, ["symbol", "time"]).join(v, ["symbol", "time"]).select("symbol", "time", "m_3", "sma_50", "volume_ratio"))


#: Rows that a part of a session may hold in the queries by parts, so that sessions of the given tables are narrowed.
PART_ROWS = 4


def _rank_by_parts(version: int, universe: str = "all"):
    return lambda s, d: rounded(ranking.rank(features(s, d), version, None, universe, scores=lambda df, columns, winsorise: crosssection.z_scores(df, columns, winsorise, PART_ROWS)))


for _v in (1, 2, 3):
    QUERIES[f"rank_v{_v}_by_parts"] = _rank_by_parts(_v)
QUERIES["rank_v2_possible_by_parts"] = _rank_by_parts(2, "possible_v2")


@query
def session_quantiles(s, d):
    """The edges that a ranking clips its factors to, session by session."""
    f = features(s, d)
    values = {"m1": F.col("sm_1") - F.col("vnim_1"), "trend": F.try_divide("close", "sma_50"), "atr": F.try_divide("atr_14_w", "close"), "vol": F.col("vol_20d_pct_126")}
    long = storage.stored(s, crosssection.long_form(f, ["time"], values), "factors")
    return rounded(crosssection.quantiles(long, ["time", "factor"], "x", (0.05, 0.95), PART_ROWS), keep=("p",))


@query
def trade_quantiles(s, d):
    """Quantiles of the traded prices and values behind the bars, by flag: few groups that hold all rows."""
    lines = s.read.parquet(f"{d}/lineitem.parquet")
    values = {"value": F.col("l_extendedprice"), "price": F.try_divide(F.col("l_extendedprice").cast("double"), F.col("l_quantity").cast("double"))}
    long = crosssection.long_form(lines.select(F.col("l_returnflag").alias("flag"), *values.values()).toDF("flag", *values), ["flag"], {c: F.col(c) for c in values})
    return rounded(crosssection.quantiles(long, ["flag", "factor"], "x", (0.01, 0.25, 0.5, 0.75, 0.99), 1000), keep=("p",))


@query
def vol_percentile_by_blocks(s, d):
    v = indicators.stock_volatility(bars(s, d))
    return rounded(slidingrank.percentile_ranks(v, ["symbol"], F.round("vol_20d", indicators.TIE_DIGITS), {"vol_20d_pct_126": 126, "vol_20d_pct_252": 252}, BLOCK_ROWS))
