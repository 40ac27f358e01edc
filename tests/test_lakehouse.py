"""Landing to gold: repeatable after a failure, growing schemas, refused versions."""

import pytest
from builders import change, log, rows
from pyspark.sql import functions as F

from changeloom.plans import gold, silver
from changeloom.schemas import SOURCE_TABLES
from changeloom.sources import files, landing
from changeloom.streaming import bronze, lakehouse

TOPICS = {dataset: f"db.{source}" for source, dataset in SOURCE_TABLES.items()}


def land(df, folder, dataset):
    target = f"{folder}/landing/{TOPICS[dataset]}"
    df.coalesce(1).write.mode("append").format(landing.file_format(df.sparkSession, "avro")).save(target)


def run(spark, folder):
    return lakehouse.run_once(spark, f"{folder}/landing", f"{folder}/lake", bronze.topic_specs("db."))


def lap(lsn, op, event, **values):
    return change(lsn, op, event_id=event, driver_code="A", team="T", lap_number=event, **values)


def test_sessions_stay_pending_until_gold_is_published(spark, folder, monkeypatch):
    first = [lap(1, "c", 1, lap_time_ms=90000), lap(2, "c", 2, lap_time_ms=91000)]
    second = [lap(3, "u", 1, lap_time_ms=80000), lap(4, "d", 2, lap_time_ms=91000)]
    land(log(spark, "laps", first), folder, "laps")
    run(spark, folder)

    land(log(spark, "laps", second), folder, "laps")
    def broken(*_):
        raise RuntimeError("lost")
    with monkeypatch.context() as patch:
        patch.setattr(lakehouse, "refresh_gold", broken)
        with pytest.raises(RuntimeError, match="lost"):
            run(spark, folder)
    # Nothing new has landed: the sessions of the failed run are refreshed all the same.
    tables = run(spark, folder)
    whole = {"laps": silver.build("laps", log(spark, "laps", first + second))}
    shown = ("season", "round", "driver_code", "race_laps", "best_lap_s")
    expected = gold.MODELS["fact_race_pace_comparison"].build(whole)
    assert rows(tables["fact_race_pace_comparison"], *shown) == rows(expected, *shown) == [(2024, 1, "A", 1, 80.0)]
    marks = f"{folder}/lake/checkpoints/refreshed"
    assert len(files.numbers(spark, marks)) == 2


def test_topics_may_land_late(spark, folder):
    land(log(spark, "laps", [lap(1, "c", 1, lap_time_ms=90000)]), folder, "laps")
    assert run(spark, folder)["race_weekend_summary"].count() == 0
    land(log(spark, "results", [change(1, "c", driver_code="A", position=1.0)]), folder, "results")
    found = run(spark, folder)["race_weekend_summary"]
    assert rows(found, "winner_code", "total_race_laps") == [("A", 1)]


def test_drain_loads_a_column_that_is_not_declared(spark, folder):
    spec = {"t": bronze.TopicSpec("t", spark.range(0).schema, ())}
    args = (f"{folder}/landing", f"{folder}/bronze", f"{folder}/checkpoints", spec, "json")
    spark.range(1).write.json(f"{folder}/landing/t")
    bronze.drain(spark, *args, schemas=f"{folder}/schemas")
    spark.range(1, 2).selectExpr("id", "'x' AS extra").write.mode("append").json(f"{folder}/landing/t")
    bronze.drain(spark, *args, schemas=f"{folder}/schemas")
    loaded = spark.read.option("mergeSchema", "true").parquet(f"{folder}/bronze/t")
    assert rows(loaded, "id", "extra") == [(0, None), (1, "x")]


def test_a_pinned_column_keeps_its_type(spark, folder):
    spark.range(1).write.parquet(f"{folder}/old")
    landing.pinned_schema(spark, f"{folder}/old", "parquet", f"{folder}/pins")
    spark.range(1).select(F.col("id").cast("string")).write.parquet(f"{folder}/new")
    with pytest.raises(TypeError, match="id changed to string"):
        landing.pinned_schema(spark, f"{folder}/new", "parquet", f"{folder}/pins")
    assert files.numbers(spark, f"{folder}/pins") == [0]
