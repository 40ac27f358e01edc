"""Ids of their own for laps that share one, at any number of orders."""

from builders import change, log, rows
from pyspark.sql import functions as F

from changeloom.plans import silver
from changeloom.workloads import queries

KEYS = silver.MODELS["laps"].keys


def test_batch_of_large_ids_is_refused_and_the_state_stays(spark, folder):
    """Order keys of a table of six GB, and an id of two laps of different drivers."""
    spark.range(600).selectExpr(
        "54000000L + id DIV 4 AS l_orderkey", "id * 7 % 500 AS l_partkey", "id % 20 AS l_suppkey", "CAST(id % 7 + 1 AS INT) AS l_linenumber",
        "CAST(id % 50 + 1 AS DOUBLE) AS l_quantity", "CAST(id * 37 % 90000 + 1000 AS DOUBLE) AS l_extendedprice",
        "0.05D AS l_discount", "0.02D AS l_tax", "element_at(array('R', 'A', 'N'), CAST(id % 3 AS INT) + 1) AS l_returnflag",
        "'O' AS l_linestatus", "date_add(DATE'2000-01-01', CAST(id * 7 % 700 AS INT)) AS l_shipdate",
    ).withColumn("l_suppkey", F.explode(F.expr("IF(l_orderkey % 5 = 0, array(l_suppkey, l_suppkey + 1), array(l_suppkey))"))).write.parquet(f"{folder}/lineitem.parquet")
    kept = queries.merge_duplicate_elsewhere(spark, folder)
    laps = queries.silver_laps(spark, folder).groupBy("season", "round", "session_type").agg(
        F.count(F.lit(1)).alias("laps"), F.sum("lap_time_ms").alias("total_ms")
    )
    columns = sorted(kept.columns)
    assert kept.count() > 0 and rows(kept, *columns) == rows(laps, *columns)


def test_shared_ids_come_apart_in_order(spark):
    ids = [4_000_000_000_000_000_000, 4_000_000_000_000_000_000, 3, 3, 3, 2, None, None]
    drivers = ["1", "2", "1", None, "2", "1", "1", "2"]
    laps = log(spark, "laps", [change(n, "u", event_id=i, driver_number=d, lap_number=7) for n, (i, d) in enumerate(zip(ids, drivers))])
    # Two keys at most share an id here, but for the id 3 with three.
    apart = queries._with_own_ids(laps.where("event_id > 3 OR event_id IS NULL OR driver_number IS NULL"), KEYS)
    large = [r.event_id for r in apart.where("event_id > 100").collect()]
    assert len(set(large)) == 2 and apart.columns == laps.columns and apart.where("event_id IS NULL").count() == 2
    small = queries._with_own_ids(laps.where("event_id < 4"), KEYS)
    found = {(r["__source_lsn"]): r.event_id for r in small.collect()}
    assert len(set(found.values())) == 4 and found[5] < min(found[2], found[3], found[4])
    again = queries._with_own_ids(laps.where("event_id = 2").unionByName(laps.where("event_id = 2")), KEYS)
    assert [r.event_id for r in again.collect()] == [2, 2]
