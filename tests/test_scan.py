"""Two-level scans, as-of joins and rotation: the same as one pass in order, hot keys spread out."""

import pytest
from builders import rows
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from changeloom.operators import joins, replay, scan, scope
from changeloom.operators.replay import due_times
from changeloom.sources import rotation


@pytest.fixture
def fixed_partitions(spark):
    """Keep the planned number of partitions, so that rows per task can be read."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.enabled", "true")


def largest_share(df) -> float:
    sizes = df.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()
    return max(r["n"] for r in sizes) / sum(r["n"] for r in sizes)


@pytest.fixture(scope="module")
def walk(spark):
    """A third of the rows under one key, some without any."""
    return spark.range(9000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 7 WHEN id % 50 = 1 THEN NULL ELSE 1000 + id % 400 END AS k",
        "id * 37 % 9001 AS seq",
        "CASE WHEN id % 11 > 0 THEN id % 100 - 30 END AS v",
    )


@pytest.mark.parametrize("parts", [2, 64])
def test_running_sum_equals_one_window(walk, parts):
    plain = F.coalesce(F.sum("v").over(Window.partitionBy("k").orderBy("seq")), F.lit(0))
    found = scan.running_sum(walk, ["k"], "seq", "v", "total", parts)
    assert rows(found, "k", "seq", "total") == rows(walk.withColumn("total", plain), "k", "seq", "total")


def test_running_sum_spreads_a_hot_key(walk, fixed_partitions):
    assert largest_share(scan.running_sum(walk, ["k"], "seq", "v", "total")) < 2 / 8


def test_due_times_of_a_crowded_session(spark):
    session = ["s"]
    df = spark.range(6000).selectExpr(
        "id AS event_id",
        "CASE WHEN id % 3 = 0 THEN 0 ELSE id % 40 END AS s",
        "CASE WHEN id % 6 = 0 THEN 500 ELSE id * 170 END AS session_time_ms",
    )
    schedule = replay.replay_schedule(replay.merge_timeline(df, df.where("event_id % 5 = 0"), session), session, 20.0)
    along = Window.partitionBy("s").orderBy("at_ms").rangeBetween(Window.unboundedPreceding, 0)
    plain = schedule.withColumn("due_s", F.sum(F.round(F.col("gap_s") * 1e6).cast("long")).over(along) / 1e6)
    shown = ("s", "at_ms", "kind", "event_id", "due_s")
    assert rows(due_times(schedule, session), *shown) == rows(plain, *shown)


def years(spark):
    """20,000 open and closed versions over years, by the millisecond; facts of one key crowd in one moment."""
    versions = spark.range(20_000).selectExpr(
        "CASE WHEN id < 8000 THEN 7 ELSE id % 3000 END AS k",
        "(id * 7919 % 20000) * 9000001L AS f",
        "id AS label",
    ).dropDuplicates(["k", "f"])
    following = F.lead("f").over(Window.partitionBy("k").orderBy("f"))
    # Every fifth version ends before the next one starts.
    versions = versions.withColumn("t", following - 1 - F.when(F.col("label") % 5 == 0, 4_000_000).otherwise(0))
    facts = spark.range(30_000).selectExpr(
        "id",
        "CASE WHEN id % 3 = 0 THEN 7 WHEN id % 70 = 1 THEN NULL ELSE id % 3500 END AS k",
        "CASE WHEN id % 6 = 0 THEN 90000010007L WHEN id % 90 = 2 THEN NULL ELSE id * 6000007L END AS seq",
    )
    return facts, versions


@pytest.mark.parametrize("parts", [3, 64])
def test_asof_join_equals_range_join(spark, parts):
    facts, versions = years(spark)
    found = scan.asof_join(facts, versions, ["k"], "seq", "f", "t", parts=parts)
    plain = facts.join(versions.withColumnRenamed("k", "dk"), F.expr("k = dk AND seq >= f AND (t IS NULL OR seq <= t)"), "left")
    assert rows(found, "id", "k", "seq", "label") == rows(plain, "id", "k", "seq", "label")
    assert found.where("label IS NOT NULL").count() > 10_000


def test_asof_join_copies_nothing_and_spreads_facts(spark, fixed_partitions):
    facts, versions = years(spark)
    found = scan.asof_join(facts, versions, ["k"], "seq", "f", "t")
    assert largest_share(found) < 2 / 8
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan


def test_lookup_without_broadcast_is_the_asof_join(spark):
    facts, versions = years(spark)
    wide = joins.point_in_time_join(facts, versions, ["k"], "seq", "f", "t", limit=-1)
    assert rows(wide, "id", "label") == rows(scan.asof_join(facts, versions, ["k"], "seq", "f", "t"), "id", "label")


@pytest.mark.parametrize(("records", "block", "together"), [(5, 5, 3), (7, 40, 2), (40, 41, 1024), (1000, 65536, 1024)])
def test_rotation_equals_a_walk(spark, monkeypatch, records, block, together):
    monkeypatch.setattr(rotation, "SUPER", together)
    df = spark.range(1500).selectExpr(
        "id", "CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 40 = 1 THEN NULL ELSE concat('k', id % 5) END AS topic",
        "id * 13 % 1501 * (CASE WHEN id % 7 = 0 THEN 900 ELSE 20 END) AS at_ms",
    )
    found = rotation.file_numbers(df, ["topic"], "at_ms", ["id"], records=records, span_ms=9000, block=block).collect()
    files, at = {}, {}
    for r in sorted(df.collect(), key=lambda r: (r.topic or "", r.at_ms, r.id)):
        number, first, held = at.get(r.topic, (-1, 0, records))
        if held == records or r.at_ms - first >= 9000:
            number, first, held = number + 1, r.at_ms, 0
        at[r.topic] = (number, first, held + 1)
        files[r.id] = number
    assert {r.id: r.file for r in found} == files and len(found) == 1500


@pytest.mark.parametrize("how", ["left_semi", "left_anti"])
@pytest.mark.parametrize("limit", [joins.BROADCAST_BYTES, -1])
def test_both_forms_of_scoping_agree(spark, how, limit):
    df = spark.range(900).selectExpr("id", "CASE WHEN id % 7 > 0 THEN id % 5 END AS g", "CASE WHEN id % 11 > 0 THEN id % 3 END AS h")
    affected = spark.createDataFrame([(1, 1), (None, 2), (3, None), (None, None), (9, 9), (1, 1)], "g long, h long")
    stored, computed = ([r.id for r in scope.match_groups(df, affected, ["g", "h"], how, limit, stored=s).collect()] for s in (True, False))
    wanted = {tuple(r) for r in affected.collect()}
    assert sorted(stored) == sorted(computed) == [r.id for r in df.collect() if ((r.g, r.h) in wanted) == (how == "left_semi")]
