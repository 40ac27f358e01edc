"""Skew-proof joins: same rows as a plain join, hot keys spread out."""

import pytest
from builders import rows
from pyspark.sql import functions as F

from changeloom.operators import joins
from changeloom.operators.ordered import neighbours
from changeloom.operators.replay import merge_timeline, replay_schedule
from changeloom.operators.winners import flag_group_minimum

NO_BROADCAST = -1


@pytest.fixture(scope="module")
def facts(spark):
    """A third of the rows share one key, some have none."""
    return spark.range(9000).selectExpr(
        "id",
        "CASE WHEN id % 3 = 0 THEN 7 WHEN id % 50 = 1 THEN NULL ELSE 1000 + id END AS k",
        "id % 100 AS seq",
    )


@pytest.fixture(scope="module")
def lookup(spark):
    return spark.range(5000).selectExpr("id AS k", "id * 2 AS v")


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_spread_join_equals_plain_join(facts, lookup, how):
    columns = ["id", "k"] + (["v"] if how in ("left", "inner") else [])
    spread = joins.lookup_join(facts, lookup, ["k"], how, limit=NO_BROADCAST)
    assert rows(spread, *columns) == rows(facts.join(lookup, ["k"], how), *columns)


def test_hot_keys_are_few_and_found(facts):
    assert rows(joins.hot_keys(facts, ["k"], share=10), "k") == [(7,)]


@pytest.fixture
def fixed_partitions(spark):
    """Keep the planned number of partitions, so that rows per task can be read."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.enabled", "true")


def largest_share(df) -> float:
    """Share of the rows that ended up in the fullest partition."""
    sizes = df.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()
    return max(r["n"] for r in sizes) / sum(r["n"] for r in sizes)


def test_hot_key_is_spread_over_partitions(fixed_partitions, facts, lookup):
    plain = facts.join(lookup.hint("merge"), ["k"], "left")
    assert largest_share(plain) > 1 / 3
    assert largest_share(joins.lookup_join(facts, lookup, ["k"], limit=NO_BROADCAST)) < 2 / 8


def test_crowded_session_is_spread_over_partitions(spark, fixed_partitions):
    """A third of all rows in one session, half of those at one moment."""
    session = ["season", "round", "session_type"]
    df = spark.range(12000).selectExpr(
        "id AS event_id",
        "2024 AS season",
        "CASE WHEN id % 3 = 0 THEN 1 ELSE CAST(id % 24 AS INT) END AS round",
        "'R' AS session_type",
        "CASE WHEN id % 6 = 0 THEN 0 ELSE id * 100 END AS session_time_ms",
    )
    timeline = merge_timeline(df, df.where("false"), session)
    schedule = replay_schedule(timeline, session, 20.0, chunk=10_000)
    assert schedule.count() == 12000
    assert largest_share(schedule) < 2 / 8
    flagged = flag_group_minimum(df, session, "session_time_ms", "first", NO_BROADCAST)
    assert largest_share(flagged) < 2 / 8


def test_small_lookup_is_broadcast_by_size(spark, facts):
    small = spark.range(10).selectExpr("id AS k", "id AS v")
    assert joins.fits_broadcast(small)
    assert not joins.fits_broadcast(small, 1)
    plan = joins.lookup_join(facts, small, ["k"])._jdf.queryExecution().toString()
    assert "_salt" not in plan


@pytest.mark.parametrize("limit", [joins.BROADCAST_BYTES, NO_BROADCAST])
@pytest.mark.parametrize("chunk", [1, 7, 1000])
def test_point_in_time_equals_range_join(spark, facts, limit, chunk):
    dim = spark.createDataFrame(
        [(7, 0, 9, "a"), (7, 10, 49, "b"), (7, 60, 999999, "c"), (1001, 0, 999999, "d")],
        "k long, f int, t int, label string",
    )
    found = joins.point_in_time_join(facts, dim, ["k"], "seq", "f", "t", chunk, limit)
    plain = facts.join(
        dim.withColumnRenamed("k", "dk"), F.expr("k = dk AND seq BETWEEN f AND t"), "left"
    )
    assert rows(found, "id", "k", "label") == rows(plain, "id", "k", "label")


def test_versions_per_slice_are_bounded(spark):
    """A key with many versions is compared slice by slice, not all with all."""
    facts = spark.range(2000).selectExpr("1 AS k", "CAST(id AS INT) AS seq")
    dim = spark.range(2000).selectExpr("1 AS k", "CAST(id AS INT) AS f", "CAST(id AS INT) AS t")
    found = joins.point_in_time_join(facts, dim, ["k"], "seq", "f", "t", 16)
    assert found.where("seq = f").count() == 2000


@pytest.mark.parametrize("chunk", [1, 5, 64])
def test_sliced_neighbours_equal_one_window(spark, chunk):
    df = spark.range(300).selectExpr("id % 4 AS k", "CAST(id * id AS LONG) AS seq", "id AS v")
    columns = ("k", "seq", "_prev", "_next")
    assert rows(neighbours(df, ["k"], "seq", ["v"], chunk), *columns) == rows(
        neighbours(df, ["k"], "seq", ["v"]), *columns
    )


@pytest.mark.parametrize("limit", [joins.BROADCAST_BYTES, NO_BROADCAST])
def test_group_minimum_flag(spark, limit):
    df = spark.createDataFrame(
        [(1, 5), (1, 5), (1, None), (1, 6), (2, None)], "g int, m int"
    )
    got = rows(flag_group_minimum(df, ["g"], "m", "best", limit), "g", "m", "best")
    assert got == [(1, 5, True), (1, 5, True), (1, 6, False), (1, None, None), (2, None, None)]
