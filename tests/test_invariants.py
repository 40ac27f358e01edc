"""Batches in any split and order give the state and gold of one full run."""

import random

import pytest
from builders import change, log, rows
from pyspark.sql import functions as F

from changeloom.operators.quality import ExpectationFailed
from changeloom.plans import gold, silver
from changeloom.plans.merge import merge_changes, read_live
from changeloom.plans.refresh import refresh_all

SHOWN = [c for c in ("event_id", "season", "round", "session_type", "driver_code", "points")]


def result_changes(seed, n=60):
    """Creates, updates that move between rounds, and deletes of a few events."""
    rng = random.Random(seed)
    out = []
    for lsn in range(1, n + 1):
        event = rng.randint(1, 8)
        out.append(
            change(
                lsn,
                rng.choice(["c", "u", "u", "d", None]),
                event_id=event,
                round=rng.randint(1, 3),
                session_type=rng.choice(["R", "Q"]),
                driver_code=f"D{event % 4}",
                team=f"T{rng.randint(1, 2)}",
                team_color=rng.choice(["red", "blue"]),
                position=float(rng.randint(1, 3)),
                points=float(rng.randint(-2, 25)),
            )
        )
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_any_split_gives_the_same_state(spark, folder, seed):
    model = silver.MODELS["results"]
    all_rows = result_changes(seed)
    full = rows(silver.build("results", log(spark, "results", all_rows)), *SHOWN)

    shuffled = list(all_rows)
    random.Random(seed + 10).shuffle(shuffled)
    cuts = [shuffled[i::3] for i in range(3)]
    path = f"{folder}/state"
    for cut in (*cuts, cuts[0]):
        merge_changes(spark, model, log(spark, "results", cut), path, gate=False)
    assert rows(read_live(spark, path, model), *SHOWN) == full


def test_moved_row_leaves_its_old_session(spark, folder):
    model = silver.MODELS["results"]
    path = f"{folder}/state"
    first = log(spark, "results", [change(1, "c", event_id=1, round=1, driver_code="A")])
    moved = log(spark, "results", [change(2, "u", event_id=1, round=2, driver_code="A")])
    merge_changes(spark, model, first, path)
    merged = merge_changes(spark, model, moved, path)
    assert rows(read_live(spark, path, model), "event_id", "round") == [(1, 2)]
    assert rows(merged.touched, "round") == [(1,), (2,)]


def test_delete_only_batch_empties_the_session(spark, folder):
    model = silver.MODELS["laps"]
    path = f"{folder}/state"
    lap = {"event_id": 1, "lap_number": 1, "lap_time_ms": 80000, "driver_code": "A"}
    slower = {"event_id": 2, "lap_number": 2, "lap_time_ms": 90000, "driver_code": "A"}
    merge_changes(spark, model, log(spark, "laps", [change(1, "c", **lap), change(2, "c", **slower)]), path)
    assert rows(read_live(spark, path, model), "lap_number", "is_fastest_lap") == [(1, True), (2, False)]
    merged = merge_changes(spark, model, log(spark, "laps", [change(3, "d", **lap)]), path)
    assert rows(read_live(spark, path, model), "lap_number", "is_fastest_lap") == [(2, True)]
    assert merged.touched.count() == 1


def test_failed_expectation_keeps_the_old_state(spark, folder):
    model = silver.MODELS["results"]
    path = f"{folder}/state"
    merge_changes(spark, model, log(spark, "results", [change(1, "c", driver_code="A")]), path)
    bad = log(spark, "results", [change(2, "u", driver_code=None)])
    with pytest.raises(ExpectationFailed, match="driver_code"):
        merge_changes(spark, model, bad, path)
    assert rows(read_live(spark, path, model), "driver_code") == [("A",)]


def test_state_written_before_a_column_was_added(spark, folder):
    model = silver.MODELS["results"]
    new, old = f"{folder}/new", f"{folder}/old"
    merge_changes(spark, model, log(spark, "results", [change(1, "c", event_id=1, driver_code="A")]), new)
    spark.read.parquet(new).drop("points").write.partitionBy(
        "season", "round", "session_type"
    ).parquet(old)
    later = log(spark, "results", [change(2, "c", event_id=2, driver_code="B", points=4.0)])
    merge_changes(spark, model, later, old)
    assert rows(read_live(spark, old, model), "driver_code", "points") == [("A", None), ("B", 4.0)]


def lap_changes(seed, n=80):
    rng = random.Random(seed)
    out = []
    for lsn in range(1, n + 1):
        driver = rng.randint(1, 3)
        out.append(
            change(
                lsn,
                rng.choice(["c", "u", "d"]),
                event_id=lsn,
                season=rng.choice([2023, 2024]),
                round=rng.randint(1, 2),
                session_type=rng.choice(["R", "Q"]),
                driver_number=str(driver),
                driver_code=f"D{driver}",
                team=f"T{rng.randint(1, 2)}",
                lap_number=rng.randint(1, 4),
                lap_time_ms=rng.choice([None, 70000, 80000, 90000, 4000000]),
                sector1_ms=rng.choice([None, 20000, 21000]),
                sector2_ms=rng.choice([30000, 31000]),
                sector3_ms=rng.choice([25000, 26000]),
                compound=rng.choice(["soft", "HARD", None]),
            )
        )
    return out


def test_refresh_in_batches_equals_full_rebuild(spark, folder):
    laps, results = lap_changes(5), result_changes(6)
    weather = [
        change(n, "c", event_id=n, session_type="R", round=n % 3 + 1, air_temp_c=20.0 + n, rainfall=n == 2)
        for n in range(1, 6)
    ]
    sets = {"laps": laps, "results": results, "weather": weather, "race_control": []}
    rng = random.Random(3)
    batches = [{n: [] for n in sets} for _ in range(3)]
    for name, changes in sets.items():
        for row in changes:
            rng.choice(batches)[name].append(row)
    for batch in batches:
        given = {n: log(spark, n, r) for n, r in batch.items() if r or n == "race_control"}
        tables = refresh_all(spark, f"{folder}/lake", given, gate=False)

    full = {n: silver.build(n, log(spark, n, r)) for n, r in sets.items()}
    for name, model in gold.MODELS.items():
        full[name] = model.build(full)
        columns = [c for c in full[name].columns if c != "_gold_loaded_at"]
        doubles = {f.name for f in full[name].schema.fields if f.dataType.simpleString() == "double"}
        shown = [F.round(c, 9).alias(c) if c in doubles else F.col(c) for c in columns]
        assert rows(tables[name], *shown) == rows(full[name], *shown), name


def test_versions_are_disjoint_and_cover_what_was_seen(spark):
    results = silver.build("results", log(spark, "results", result_changes(9, 120)))
    dim = gold.dim_driver_scd2({"results": results})
    seen = results.select("driver_code", (F.col("season") * 100 + F.col("round")).alias("seq")).distinct()
    hits = seen.join(dim, "driver_code").where("seq BETWEEN _valid_from_seq AND _valid_to_seq_excl")
    assert hits.groupBy("driver_code", "seq").count().where("count <> 1").count() == 0
    assert hits.count() == seen.count()
    current = dim.where("is_current").groupBy("driver_code").count()
    assert current.where("count <> 1").count() == 0
    assert current.count() == dim.select("driver_code").distinct().count()


def test_groups_with_a_null_are_scoped_and_replaced(spark):
    from changeloom.operators.scope import replace_groups, scope_to

    old = spark.createDataFrame([(1, 1, "a"), (1, None, "b"), (None, None, "c"), (2, 1, "d")], "g int, k int, v string")
    affected = spark.createDataFrame([(1, None), (2, 1)], "g int, k int")
    assert {r.v for r in scope_to(old, affected, ["g", "k"]).collect()} == {"b", "d"}
    fresh = spark.createDataFrame([(1, None, "new")], "g int, k int, v string")
    assert {r.v for r in replace_groups(old, affected, fresh, ["g", "k"]).collect()} == {"a", "c", "new"}


def test_close_values_keep_their_deviation(spark):
    from pyspark.sql import functions as F

    from changeloom.functions.aggregates import squared, stddev_seconds

    rows = spark.createDataFrame([("a", 3_500_000), ("a", 3_500_000), ("b", 3_500_001), ("b", 3_500_001)], "team string, ms int")
    parts = rows.groupBy("team").agg(F.count("*").alias("n"), F.sum("ms").alias("s"), F.sum(squared("ms")).alias("q"))
    found = parts.agg(stddev_seconds("n", "s", "q").alias("d")).first().d
    assert abs(found - (1 / 3) ** 0.5 * 0.001) < 1e-12
    same = parts.where("team = 'a'").agg(stddev_seconds("n", "s", "q").alias("d")).first().d
    assert same == 0.0


def test_open_versions_beyond_any_bound(spark):
    from changeloom.operators.joins import point_in_time_join
    from changeloom.operators.scd2 import scd2_islands

    seen = spark.createDataFrame([("a", 10, "x"), ("a", 1_500_010, "y")], "k string, s long, v string")
    versions = scd2_islands(seen, "k", "s", ["v"], chunk=1024)
    facts = spark.createDataFrame([("a", 1_500_020), ("a", 11), ("a", 9)], "k string, at long")
    joined = point_in_time_join(facts, versions.drop("_valid_to_seq_observed", "is_current"), ["k"], "at", "_valid_from_seq", "_valid_to_seq_excl")
    assert {(r["at"], r.v) for r in joined.collect()} == {(1_500_020, "y"), (11, "x"), (9, None)}


def test_a_published_table_without_rows_can_be_read(spark, folder):
    from changeloom.sources.tables import Tables

    store = Tables(spark, folder)
    store.publish("none", spark.createDataFrame([], "a int, p int"), ["p"])
    assert store.read("none").columns == ["a", "p"] and store.read("none").count() == 0


def test_all_batches_are_counted(spark, folder):
    from changeloom.streaming.bronze import append_stream, finish

    spark.range(0, 2600).repartition(130).write.parquet(f"{folder}/in")
    stream = spark.readStream.schema("id long").option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
    done = finish(append_stream(stream, f"{folder}/out", f"{folder}/checkpoint", []))
    assert done["rows"] == spark.read.parquet(f"{folder}/out").count() == 2600
    assert done["batches"] > 100
