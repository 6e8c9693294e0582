"""Cross-sections by parts: equal to windows and to `percentile`, for groups of any size, and no group in one task."""

import math

import pytest
from pyspark.sql import functions as F

from barloom.operators import crosssection, ranking
from barloom.plans import registry
from barloom.sources.storage import stored
from tests.conftest import SF
from tests.test_entry import normal

P = (0.0, 0.05, 0.5, 0.95, 1.0)


def plain(df):
    """(group, p) -> (n, quantile) by Spark's own `percentile`."""
    q = df.filter("g IS NOT NULL AND x IS NOT NULL").groupBy("g").agg(F.count("x").alias("n"), F.percentile("x", F.array(*[F.lit(p) for p in P])).alias("q")).collect()
    return {(r["g"], p): (r["n"], v) for r in q for p, v in zip(P, r["q"], strict=True)}


def by_parts(df, limit):
    return {(r["g"], r["p"]): (r["n"], r["quantile"]) for r in crosssection.quantiles(df, ["g"], "x", P, limit).collect()}


@pytest.mark.parametrize("limit", [1, 50, 100_000])
def test_quantiles_of_uneven_groups(spark, limit):
    """A hot group, ties, huge values, one row, two rows, no values, rows without a group."""
    rows = spark.range(30_000).select(
        F.when(F.col("id") % 3 > 0, "hot").when(F.col("id") % 5 > 0, "ties").otherwise("wide").alias("g"),
        F.when(F.col("id") % 3 > 0, F.hash("id").cast("double")).when(F.col("id") % 5 > 0, (F.col("id") % 4).cast("double")).otherwise(F.exp(F.hash("id").cast("double") / 4e6)).alias("x"),
    )
    few = spark.createDataFrame([("one", 2.5), ("two", 1.0), ("two", 4.0), ("none", None), (None, 7.0), ("same", 3.0), ("same", 3.0), ("same", 3.0), ("hot", None)], "g string, x double")
    df = stored(spark, rows.unionByName(few), "uneven")
    want = plain(df)
    assert by_parts(df, limit) == want
    assert {g for g, _ in want} == {"hot", "ties", "wide", "one", "two", "same"}


def test_a_session_of_a_million_rows(spark, monkeypatch):
    """No task sorts more than `limit` rows of it, and what is sorted was read from the candidates alone."""
    df = stored(spark, spark.range(1_000_000).select(F.lit("day").alias("g"), (F.hash("id") / 1e5).alias("x")), "million")
    sorted_rows, inner = [], crosssection._sorted

    def watched(rows, targets, by, name):
        sorted_rows.append(rows.join(targets, by).groupBy(*name).count().agg(F.max("count")).first()[0] or 0)
        return inner(rows, targets, by, name)

    monkeypatch.setattr(crosssection, "_sorted", watched)
    assert by_parts(df, 20_000) == plain(df)
    assert sorted_rows[0] == 0 < max(sorted_rows) <= 20_000


def test_infinite_values_and_nan(spark):
    values = [math.inf, -math.inf, math.nan, 1.0, 2.0, -0.5, math.nan]
    df = spark.createDataFrame([("a", v) for v in values], "g string, x double")
    got = {p: q for (_, p), (_, q) in by_parts(df, 1).items()}
    assert got[0.0] == -math.inf and got[0.5] == 2.0 and math.isnan(got[1.0])


def test_edges(spark):
    nothing = spark.createDataFrame([], "g string, x double")
    assert by_parts(nothing, 1) == {}
    for p, limit in (((), 1), ((1.5,), 1), ((0.5,), 0)):
        with pytest.raises(ValueError):
            crosssection.quantiles(nothing, ["g"], "x", p, limit)


def test_scores_equal_those_of_windows(spark):
    f = stored(spark, registry.features(spark, SF), "features")
    columns = {"a": F.col("close"), "b": F.col("sm_1") - F.col("vnim_1")}
    for winsorise in (True, False):
        scored = crosssection.z_scores(f, columns, winsorise, 5).select("symbol", "time", "a", "b")
        assert normal(registry.rounded(scored).toPandas()) == normal(registry.rounded(ranking.z_scores(f, columns, winsorise).select("symbol", "time", "a", "b")).toPandas())


def test_no_rows_are_exchanged_where_sessions_are_few(spark):
    """Scores are two broadcasts of one row a session: no window and no shuffle of rows by session."""
    f = stored(spark, registry.features(spark, SF), "features")
    plan = crosssection.z_scores(f, {"a": F.col("close")}, True, 5)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Exchange hashpartitioning" not in plan and plan.count("BroadcastHashJoin") == 2


def test_rows_without_a_time_have_no_score(spark):
    df = spark.createDataFrame([(1, 1.0), (1, 2.0), (1, 3.0), (None, 5.0), (None, 6.0)], "time int, x double")
    got = sorted(crosssection.z_scores(df, {"z": F.col("x")}, True, 1).select("x", "z").collect())
    assert [r["z"] is None for r in got] == [False, False, False, True, True]
