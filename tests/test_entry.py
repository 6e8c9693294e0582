"""The registered queries: the entry point, registry and oracles agree on names; a few run against DuckDB."""

import sys

import duckdb
import pytest

import __spark_entry__ as entry
from barloom.plans.oracles import ORACLES
from barloom.plans.registry import QUERIES
from barloom.sources import fixtures, ingest
from tests.conftest import SF

TABLES = ["lineitem", "part", "documents", "benchmark", "labels"]


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0


def normal(frame):
    import pandas as pd

    frame = frame[sorted(frame.columns)]
    return sorted(tuple("NULL" if pd.isna(v) else repr(round(float(v), 6)) if isinstance(v, float) else str(v) for v in r) for r in frame.astype(object).itertuples(index=False))


@pytest.mark.parametrize("name", ["ohlcv_view", "index_view", "stock_rsi", "stock_volatility", "regime", "structural_v2", "rank_v1", "ic_daily", "ic_summary", "ic_newey_west", "factor_decay", "spread_daily", "trades_pvd_v1", "trades_bsr_v2", "structural_step_v2", "incremental_rank_v1", "ranking_order", "prices_between", "vendor_bars", "incremental_volatility", "upsert_prices", "parse_index_csv", "date_sequence", "agent_table", "universe_industry_exchange", "regime_by_blocks", "stock_rsi_by_blocks", "newey_west_by_blocks", "spread_equity_by_blocks", "rsi_pipeline", "decision_pipeline", "missing_symbols_pipeline", "committed_scope", "bars_source_whole", "bars_source_filtered", "bars_source_stream", "feature_join_stored", "ic_daily_possible", "quintile_returns", "agent_json", "agent_prompt", "trades_csv", "parallel_pipelines", "rolling_stream", "asof_month_close", "rsi_step", "rank_v3_by_parts", "rank_v2_possible_by_parts", "session_quantiles", "trade_quantiles"])
def test_against_duckdb(spark, name):
    db = duckdb.connect()
    for t in TABLES:
        db.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    assert normal(QUERIES[name](spark, SF).toPandas()) == normal(db.execute(ORACLES[name]).fetch_df())


def test_raw_index_file(spark, tmp_path):
    rows = ingest.parse_index_csv(fixtures.raw_index_csv(spark)).orderBy("time").collect()
    assert [r["volume"] for r in rows] == [700500000, 1250000000, 950000, None]
    path = tmp_path / "index.csv"
    path.write_text('time,open,high,low,close,volume,change_percentage\n02/01/2024," 1,130.12","1,141.00","1,125.50","1,131.72",700.5M,0.16%\n')
    one = ingest.parse_index_csv(ingest.read_index_csv(spark, str(path))).first()
    assert (one["open"], one["volume"], one["change_percentage"], one["time"].hour) == (1130.12, 700500000, 0.16, 7)


def test_tables_are_replaced_whole(spark, tmp_path):
    from barloom.operators import state

    path = str(tmp_path / "prices")
    first = fixtures.ohlcv_prices(spark, SF).limit(50)
    ingest.replace_table(first, path)
    stored = ingest.read_table(spark, path)
    new = stored.limit(3).withColumn("close", stored["close"] + 1)
    ingest.replace_table(state.upsert(stored, new, ["symbol", "time"]), path)  # reads the table that it replaces
    assert ingest.read_table(spark, path).count() == 50 == stored.count()
    (tmp_path / "prices" / "version=000000002").mkdir()  # a writer that was lost
    assert ingest.read_table(spark, path).count() == 50


def test_request_path_and_csv_sink(spark, tmp_path):
    import json

    from barloom.operators import serving
    from barloom.plans import registry

    f = serving.agent_features(registry.features(spark, SF), "1998-01-01", registry.SYMBOL)
    rows = [json.loads(r["json"]) for r in serving.as_json(f).collect()]
    assert len(rows) == f.count() > 0 and all(r["symbol"] == registry.SYMBOL and r["time"].endswith("T07:00:00") for r in rows)
    lines = [r["line"] for r in serving.render_table(f).orderBy("line_no").collect()]
    prompt = serving.build_prompt("Judge these rows.\n", "\n".join(lines))
    assert prompt.startswith("Judge these rows.\ntime") and prompt.count("\n") == len(rows) + 2
    ingest.write_csv_by_symbol(f.select("symbol", "time", "close"), str(tmp_path / "out"))
    assert spark.read.option("header", True).csv(str(tmp_path / "out")).count() == len(rows)


def test_core_does_not_import_the_corpus_package():
    import subprocess

    code = "import sys; import barloom.plans.oracles; assert not [m for m in sys.modules if m.startswith('barloom.llm')]"
    assert subprocess.run([sys.executable, "-c", code], cwd=entry.__file__.rpartition("/")[0]).returncode == 0
