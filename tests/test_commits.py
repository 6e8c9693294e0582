"""Commits that notice each other, and pipelines that go on from what is stored."""

import threading

import pytest
from pyspark.sql import functions as F

from barloom.operators import decisions, indicators, pipelines, state
from barloom.sources import fixtures, storage
from barloom.sources.commits import CommitConflict, CommittedTable
from tests.conftest import SF
from tests.test_entry import normal


@pytest.fixture(scope="module")
def bars(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("bars") / "b")
    fixtures.ohlcv_prices(spark, SF).filter("symbol IN ('Brand#11', 'Brand#12', 'Brand#22')").write.parquet(path)
    return spark.read.parquet(path)


def table(spark, path):
    return CommittedTable(spark, f"file://{path}")


def alike(a, b):
    assert normal(a.toPandas()) == normal(b.select(*a.columns).toPandas())


def rows(spark, *found):
    return spark.createDataFrame([(s, t, c) for s, t, c in found], "symbol string, time string, close double").withColumn("time", F.col("time").cast("timestamp_ntz"))


def test_two_writers_of_one_part(spark, tmp_path):
    t = table(spark, tmp_path)
    first = t.replace(rows(spark, ("a", "2024-01-02 07:00:00", 1.0), ("a", "2024-02-02 07:00:00", 2.0)))
    mine = theirs = t.version()
    t.commit(rows(spark, ("a", "2024-01-02 07:00:00", 5.0)), {"2024-01"}, theirs)
    with pytest.raises(CommitConflict):
        t.commit(rows(spark, ("a", "2024-01-02 07:00:00", 9.0)), {"2024-01"}, mine)
    t.commit(rows(spark, ("a", "2024-02-02 07:00:00", 7.0)), {"2024-02"}, mine)  # another part: goes on top
    assert sorted(r["close"] for r in t.read().collect()) == [5.0, 7.0]
    assert sorted(r["close"] for r in t.read(t.version(first.number)).collect()) == [1.0, 2.0]
    with pytest.raises(CommitConflict):
        t.commit(rows(spark, ("a", "2024-03-02 07:00:00", 9.0)), None, first)  # the whole table
    with pytest.raises(ValueError):
        t.commit(rows(spark, ("a", "2024-05-02 07:00:00", 9.0)), {"2024-01"}, t.version())
    assert t.expire(1) == 1 and sorted(r["close"] for r in t.read().collect()) == [5.0, 7.0]


def test_a_loser_computes_anew(spark, tmp_path):
    t = table(spark, tmp_path)
    t.replace(rows(spark, ("a", "2024-01-02 07:00:00", 1.0)))
    calls = []

    def change(old):
        if not calls:  # another writer is first
            t.upsert(rows(spark, ("b", "2024-01-03 07:00:00", 10.0)), ["symbol", "time"])
        calls.append(1)
        return old.withColumn("close", F.col("close") + 1)

    t.update(change, {"2024-01"})
    assert len(calls) == 2 and sorted(r["close"] for r in t.read().collect()) == [2.0, 11.0]
    with pytest.raises(CommitConflict):
        t.update(lambda old: (t.upsert(rows(spark, ("c", "2024-01-04 07:00:00", 1.0)), ["symbol", "time"]), old)[1], {"2024-01"}, tries=2)


def test_one_of_many_claims_wins(spark, tmp_path):
    won = []
    for k in range(3):
        gate, got = threading.Barrier(8), []

        def race(n, k=k, gate=gate, got=got):
            gate.wait()
            got.append((storage.claim(spark, f"file://{tmp_path}/c/{k}.json", f"{n}"), n))

        threads = [threading.Thread(target=race, args=(n,)) for n in range(8)]
        [x.start() for x in threads]
        [x.join() for x in threads]
        won.append([n for ok, n in got if ok])
        assert len(won[-1]) == 1 and storage.read_text(spark, f"file://{tmp_path}/c/{k}.json") == str(won[-1][0])
    assert storage.names(spark, f"file://{tmp_path}/c/*") == ["0.json", "1.json", "2.json"]


def test_upsert_scope_and_empty(spark, tmp_path, bars):
    t = table(spark, tmp_path)
    with pytest.raises(ValueError):
        t.read()
    t.upsert(bars, ["symbol", "time"])
    scope = (F.col("symbol") == "Brand#11") & (F.year("time") == 1995)
    new = bars.filter(scope).withColumn("close", F.col("close") * 2)
    before = t.version()
    after = t.replace_scope(new, scope)
    alike(state.scoped_replace(bars, new, scope), t.read())
    assert all(before.parts[p] == after.parts[p] for p in before.parts if not p.startswith("1995"))
    with pytest.raises(Exception, match="duplicate key"):
        t.upsert(new.unionByName(new), ["symbol", "time"])
    t.replace(bars.limit(0))
    assert t.read().count() == 0


@pytest.mark.parametrize("name,pipeline,full", [
    ("momentum", pipelines.MOMENTUM, indicators.stock_momentum),
    ("volume", pipelines.VOLUME, indicators.stock_volume),
    ("rsi", pipelines.RSI, indicators.stock_rsi),
    ("atr", pipelines.ATR, pipelines.ATR.backfill),
])
def test_steps_equal_a_backfill(spark, tmp_path, bars, name, pipeline, full):
    """Several sessions a step, a symbol with too few rows for averages, one that comes late."""
    t = table(spark, tmp_path)
    young = bars.filter("symbol = 'Brand#12'").orderBy("time").limit(30).withColumn("symbol", F.lit("young"))
    young = spark.createDataFrame(young.toPandas(), bars.schema)
    every = bars.unionByName(young)
    early = young.toPandas()["time"].sort_values()
    pipelines.run(pipeline, every.filter("symbol != 'Brand#22'"), t, "backfill", str(early.iloc[8].date()))
    for date in (str(early.iloc[11].date()), str(early.iloc[20].date()), "1996-05-17", "1996-05-17", None):
        pipelines.run(pipeline, every, t, "incremental", date)
    alike(full(every), t.read())
    with pytest.raises(ValueError):
        pipelines.run(pipeline, every, t, "all")


def test_runs_go_on_across_steps(spark, tmp_path, bars):
    f = indicators.features(bars)
    for version in (1, 3):
        t = table(spark, tmp_path / str(version))
        pipelines.run(pipelines.structural(version), f, t, "backfill", "1994-03-01")
        for date in ("1995-03-01", "1995-03-20", None):
            pipelines.run(pipelines.structural(version), f, t, "incremental", date)
        alike(decisions.structural(f, version), t.read())


def test_missing_symbols_and_universe(spark, tmp_path, bars):
    t = table(spark, tmp_path)
    t.replace(bars.filter("symbol = 'Brand#11'"))
    universe = spark.createDataFrame([("Brand#11",), ("Brand#22",), ("Brand#99",)], "symbol string")
    for _ in range(2):
        pipelines.ingest_missing(universe, bars, t)
        alike(bars.filter("symbol IN ('Brand#11', 'Brand#22')"), t.read())
    m = table(spark, tmp_path / "m")
    pipelines.run(pipelines.MOMENTUM, bars, m, "backfill", universe=universe)
    assert {r[0] for r in m.read().select("symbol").distinct().collect()} == {"Brand#11", "Brand#22"}


def test_a_cluster_needs_a_shared_folder(spark):
    class Conf:
        def get(self, key, default=None):
            return {"spark.master": "spark://host:7077"}.get(key, default)

    class Session:
        conf = Conf()

    with pytest.raises(ValueError, match="checkpoint"):
        storage.shared_dir(Session())
    assert storage.shared_dir(spark)


def test_one_failure_cancels_the_rest(spark):
    import time

    begun = time.time()

    def slow():
        spark.range(0, 10**13, 1, 4).filter("id % 1000000007 = 3 AND id % 11 = 5").count()  # minutes

    def fails():
        time.sleep(2)
        raise RuntimeError("no such universe")

    ran = []
    with pytest.raises(RuntimeError, match="no such universe"):
        pipelines.run_all(spark, {"slow": slow, "fails": fails, "later": lambda: ran.append(1)}, at_once=2)
    assert time.time() - begun < 40
    found = pipelines.run_all(spark, {str(k): lambda k=k: spark.range(k).count() for k in range(4)})
    assert found == {"0": 0, "1": 1, "2": 2, "3": 3}
