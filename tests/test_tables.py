"""Publishing, partition overwrite, schemas, normalisation, expectations."""

import dataclasses
import datetime
import re
from pathlib import Path

import pytest
from builders import change, log, rows
from pyspark.sql import functions as F

from changeloom.operators.quality import (
    Accepted,
    ExpectationFailed,
    Grain,
    NotNull,
    Unique,
    check,
    expect,
)
from changeloom.plans import merge, silver
from changeloom.plans.keyindex import KeyIndex
from changeloom.plans.merge import merge_changes, read_live
from changeloom.schemas import DATASETS, change_schema, source_schema
from changeloom.session import shared_dir
from changeloom.sources import landing, tables
from changeloom.sources.normalize import RAW_COLUMNS, for_driver, normalize
from changeloom.sources.tables import Tables, create_namespaces, replace_partitions


def test_readers_see_the_newest_checked_version(spark, folder):
    store = Tables(spark, folder)
    assert not store.exists("t")
    store.publish("t", spark.range(3))
    with pytest.raises(ExpectationFailed):
        store.publish("t", spark.range(3).selectExpr("id * 0 AS id"), rules=[Unique("id")])
    assert rows(store.read("t"), "id") == [(0,), (1,), (2,)]
    store.publish("t", store.read("t").where("id > 0"), rules=[Unique("id")])
    assert rows(store.read("t"), "id") == [(1,), (2,)]


def test_only_present_partitions_are_replaced(spark, folder):
    path = f"{folder}/t"
    spark.createDataFrame([(1, "a"), (2, "b")], "p int, v string").write.partitionBy("p").parquet(path)
    replace_partitions(spark.createDataFrame([(2, "c"), (3, "d")], "p int, v string"), path, ["p"])
    assert rows(spark.read.parquet(path), "p", "v") == [(1, "a"), (2, "c"), (3, "d")]


def test_namespaces(spark):
    assert create_namespaces(spark) == ["bronze", "silver", "gold"]
    create_namespaces(spark)
    assert {"bronze", "silver", "gold"} <= {r[0] for r in spark.sql("SHOW SCHEMAS").collect()}


def test_shared_dir_follows_the_session(spark):
    assert shared_dir(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    assert shared_dir(spark, "x") != shared_dir(spark, "x")


def test_schema_contracts():
    for dataset in DATASETS:
        assert set(source_schema(dataset).names) < set(change_schema(dataset).names)
    assert [f.name for f in source_schema("laps").fields if not f.nullable] == [
        "event_id", "season", "round", "session_type", "driver_number", "lap_number", "ingested_at"
    ]


def test_pinned_schema_only_grows(spark, folder):
    spark.range(2).write.json(f"{folder}/data")
    first = landing.pinned_schema(spark, f"{folder}/data", "json", f"{folder}/schema")
    spark.range(2).selectExpr("id", "'x' AS extra").write.mode("append").json(f"{folder}/data")
    second = landing.pinned_schema(spark, f"{folder}/data", "json", f"{folder}/schema")
    assert first.names == ["id"] and second.names == ["id", "extra"]


def test_avro_round_trip(spark, folder):
    fmt = landing.file_format(spark, "avro")
    df = spark.sql("SELECT 1L AS a, TIMESTAMP '2024-01-01 10:00:00' AS t, CAST(NULL AS FLOAT) AS f")
    df.write.format(fmt).save(folder + "/a")
    back = spark.read.format(fmt).load(folder + "/a")
    assert back.schema.simpleString() == df.schema.simpleString()
    assert back.collect() == df.collect()


def test_landing_rotates_by_record_count(spark, folder):
    clock = F.lit("2024-05-06 07:08:09").cast("timestamp")
    landing.write_landing(spark.range(25).coalesce(1), folder, "json", clock, records_per_file=10)
    hour = spark.read.json(f"{folder}/year=2024/month=05/day=06/hour=07")
    assert hour.count() == 25
    assert hour.select(F.input_file_name()).distinct().count() == 3


def test_normalize_handles_missing_values(spark):
    raw = spark.createDataFrame(
        [
            ("44", "HAM", float("nan"), datetime.timedelta(seconds=90, milliseconds=123), float("nan")),
            ("1", None, 3.0, None, 12.5),
        ],
        "DriverNumber string, Driver string, LapNumber double, LapTime interval day to second, "
        "TyreLife double",
    )
    df = normalize(raw, "laps", F.lit(2024), F.lit(1), F.lit("R"))
    assert df.columns[3:] == list(RAW_COLUMNS["laps"])
    assert rows(df, "driver_number", "driver_code", "lap_number", "lap_time_ms", "tyre_life", "team") == [
        ("1", None, 3, None, 12, None), ("44", "HAM", None, 90123, None, None)
    ]


def test_driver_filter_and_first_samples(spark):
    df = spark.createDataFrame(
        [("A", 3), ("A", 1), ("B", 0), ("A", 2)], "driver_code string, session_time_ms long"
    )
    assert rows(for_driver(df, "A", 2), "session_time_ms") == [(1,), (2,)]


def test_expectations_report_failures(spark):
    df = spark.createDataFrame(
        [(1, "a", None), (1, "b", 2), (None, "z", 2), (None, None, 3)], "id int, kind string, n int"
    )
    rules = [NotNull("id"), NotNull("n"), Unique("id"), Accepted("kind", ("a", "b")), Grain(("kind", "n"))]
    assert rows(check(df, rules), "rule", "column", "failures") == [
        ("accepted_values", "kind", 1),
        ("grain", "kind,n", 0),
        ("not_null", "id", 2),
        ("not_null", "n", 1),
        ("unique", "id", 1),
    ]
    with pytest.raises(ExpectationFailed, match=r"unique\(id\): 1"):
        expect(df, rules, "t")
    expect(df, [Grain(("kind", "n"))])


def files_of(folder, race):
    return sorted(p.name for p in Path(folder).rglob(f"round={race}/*.parquet"))


def races(spark, rows_):
    return spark.createDataFrame(rows_, "season int, round int, driver string, points int")


def test_replacing_groups_leaves_other_files_alone(spark, folder):
    store = Tables(spark, folder)
    store.publish("t", races(spark, [(1, r, d, r) for r in range(4) for d in "ab"] + [(1, None, "a", 9)]), ["season", "round"])
    before = {r: files_of(folder, r) for r in range(4)}
    affected = spark.createDataFrame([(1, 1), (1, 2), (1, 7), (1, None)], "season int, round int")
    fresh = races(spark, [(1, 1, "c", 5), (1, 7, "d", 6)])
    found = store.replace("t", fresh, affected, ["season", "round"], ["season", "round"], [Grain(("season", "round", "driver"))])
    kept = [(1, r, d, r) for r in (0, 3) for d in "ab"] + [(1, 1, "c", 5), (1, 7, "d", 6)]
    assert rows(found, "season", "round", "driver", "points") == sorted(kept)
    assert {r: files_of(f"{folder}/t/v=1", r) for r in (0, 3)} == {r: before[r] for r in (0, 3)}
    assert files_of(f"{folder}/t", 2) == [] and files_of(f"{folder}/t", 1) != before[1]


def test_refused_groups_change_nothing(spark, folder):
    store = Tables(spark, folder)
    store.publish("t", races(spark, [(1, 1, "a", 1), (1, 2, "b", 2)]), ["season", "round"])
    affected = spark.createDataFrame([(1, 1)], "season int, round int")
    both = ["season", "round"]
    with pytest.raises(ExpectationFailed, match="grain"):
        store.replace("t", races(spark, [(1, 1, "c", 5), (1, 1, "c", 6)]), affected, both, both, [Grain(("season", "round", "driver"))])
    # A key without the group is compared with the groups that stay.
    with pytest.raises(ExpectationFailed, match="grain"):
        store.replace("t", races(spark, [(1, 1, "b", 5)]), affected, both, both, [Grain(("driver",))])
    assert rows(store.read("t"), "round", "driver") == [(1, "a"), (2, "b")]
    with pytest.raises(ValueError):
        store.replace("t", races(spark, []), affected, ["driver"], both)


@pytest.mark.parametrize("after", ["write_text", "replace_partitions", "remove"])
def test_interrupted_replacement_is_finished(spark, folder, monkeypatch, after):
    store = Tables(spark, folder)
    both = ["season", "round"]
    store.publish("t", races(spark, [(1, r, "a", r) for r in range(4)]), both)
    affected = spark.createDataFrame([(1, 1), (1, 2)], "season int, round int")

    def broken(*args, **kwargs):
        result = real(*args, **kwargs)
        if after != "write_text" or args[1].endswith("_REPLACING"):
            raise OSError("lost")
        return result

    real = getattr(tables, after)
    with monkeypatch.context() as patch:
        patch.setattr(tables, after, broken)
        with pytest.raises(OSError, match="lost"):
            store.replace("t", races(spark, [(1, 1, "c", 5)]), affected, both, both)
    for _ in range(2):
        assert rows(Tables(spark, folder).read("t"), "round", "driver") == [(0, "a"), (1, "c"), (3, "a")]


def test_index_reads_the_buckets_of_its_keys(spark, folder):
    schema = "event_id long, season int"
    index = KeyIndex(spark, f"{folder}/keys", ("event_id",), ("season",))
    index.add(spark.createDataFrame([(i, i % 5 if i % 7 else None) for i in range(500)], schema))
    before = spark.read.parquet(f"{folder}/keys").count()
    index.add(spark.createDataFrame([(i, i % 5 if i % 7 else None) for i in range(300)] + [(3, 99)], schema))
    assert (before, spark.read.parquet(f"{folder}/keys").count()) == (500, 501)
    wanted = spark.createDataFrame([(3, 0), (7, 0), (900, 0)], schema)
    found = index.find(wanted)
    assert rows(found, "event_id", "season") == [(3, 3), (3, 99), (7, None)]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*_bucket[^\]]*IN", plan, re.I)


def test_merge_looks_keys_up_in_its_index(spark, folder, monkeypatch):
    """The key columns of the state are read once, for the first index, not by the merges after it."""
    def batch(ids, season):
        return log(spark, "results", [change(10 + season, "u", event_id=i, season=season, driver_code="A") for i in ids])

    model, path = silver.MODELS["results"], f"{folder}/state"
    merge_changes(spark, model, batch(range(50), 2020), path)
    read = []
    real = merge.scope_to
    monkeypatch.setattr(merge, "scope_to", lambda df, affected, *a, **k: read.append(affected.collect()) or real(df, affected, *a, **k))
    merge_changes(spark, model, batch([7], 2021), path)
    assert sorted(r.season for r in read[0]) == [2020, 2021]
    merge_changes(spark, model, batch([900], 2022), path)
    assert [r.season for r in read[1]] == [2022]
    state = read_live(spark, path, model)
    assert rows(state.where("event_id IN (7, 8, 900)"), "event_id", "season") == [(7, 2021), (8, 2020), (900, 2022)]


def test_values_are_unique_in_sessions_left_alone_too(spark, folder):
    model = dataclasses.replace(silver.MODELS["laps"], rules=(Unique("event_id"),))

    def batch(lsn, *laps):
        return log(spark, "laps", [change(lsn, op, event_id=i, season=s, lap_number=n, driver_code="A") for i, s, n, op in laps])

    path = f"{folder}/state"
    merge_changes(spark, model, batch(1, (1, 2020, 1, "c"), (2, 2021, 1, "c"), (3, 2021, 2, "c")), path)
    with pytest.raises(ExpectationFailed, match="other sessions"):
        merge_changes(spark, model, batch(2, (2, 2022, 1, "c")), path)
    # A lap that was deleted has given its id free.
    merge_changes(spark, model, batch(3, (3, 2021, 2, "d")), path)
    merge_changes(spark, model, batch(4, (3, 2022, 5, "c")), path)
    assert rows(read_live(spark, path, model), "event_id", "season") == [(1, 2020), (2, 2021), (3, 2022)]


def test_interrupted_merge_is_finished_from_its_staged_rows(spark, folder, monkeypatch):
    model, path = silver.MODELS["results"], f"{folder}/state"

    def batch(lsn, *events):
        return log(spark, "results", [change(lsn, "u", event_id=i, season=s, driver_code="A", points=float(lsn)) for i, s in events])

    merge_changes(spark, model, batch(1, (1, 2020), (2, 2020), (3, 2021)), path)

    def broken(staged, target, columns):
        # As when a partition is gone and the new one not in its place yet.
        tables.remove(spark, f"{target}/season=2020")
        raise OSError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(tables, "replace_partitions", broken)
        with pytest.raises(OSError, match="lost"):
            merge_changes(spark, model, batch(2, (1, 2020)), path)
    merge_changes(spark, model, batch(3, (3, 2021)), path)
    assert rows(read_live(spark, path, model), "event_id", "points") == [(1, 2.0), (2, 1.0), (3, 3.0)]
