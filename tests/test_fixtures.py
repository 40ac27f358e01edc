"""Hand-computed cases for the cleaning, change-log and model rules."""

from builders import change, log, rows
from pyspark.sql import functions as F

from changeloom.functions.clean import elapsed_seconds
from changeloom.operators import cdc, replay
from changeloom.operators.joins import point_in_time_join
from changeloom.operators.scd2 import OPEN_END, one_row_per_seq, scd2_islands
from changeloom.operators.winners import group_winner
from changeloom.plans import gold, panel, silver


def keyed(spark, *triples):
    schema = "k int, __source_lsn long, __ts_ms long, __op string, v string"
    return spark.createDataFrame([(1, lsn, lsn, op, v) for lsn, op, v in triples], schema)


def apply_all(spark, batches, key=("k",)):
    state = batches[0].where("false")
    out = []
    for batch in batches:
        state = cdc.apply_changes(state, batch, key)
        flagged = state.withColumn("_is_deleted", cdc.is_tombstone())
        out.append(rows(cdc.live_rows(flagged), "v"))
    return out


def test_newest_position_wins_whatever_the_arrival(spark):
    df = keyed(spark, (10, "c", "a"), (30, "u", "c"), (20, "u", "b"))
    assert rows(cdc.latest_by_key(df, ["k"]), "v") == [("c",)]


def test_late_update_does_not_revive_a_deleted_key(spark):
    batches = [
        keyed(spark, (10, "c", "a")),
        keyed(spark, (20, "d", "a")),
        keyed(spark, (15, "u", "b")),
    ]
    assert apply_all(spark, batches) == [[("a",)], [], []]


def test_replayed_batch_changes_nothing(spark):
    batch = keyed(spark, (10, "c", "a"), (20, "u", "b"))
    assert apply_all(spark, [batch, batch]) == [[("b",)], [("b",)]]


def test_null_position_loses(spark):
    df = keyed(spark, (None, "u", "x"), (1, "u", "y"))
    assert rows(cdc.latest_by_key(df, ["k"]), "v") == [("y",)]


def test_delete_flag_column_also_marks_a_tombstone(spark):
    df = spark.createDataFrame(
        [("d", None), (None, None), ("u", "true"), ("u", "false")], "__op string, __deleted string"
    )
    flags = [r[0] for r in df.select(cdc.is_tombstone(deleted="__deleted")).collect()]
    assert flags == [True, False, True, False]


def test_lap_time_bounds_are_inclusive(spark):
    df = log(spark, "laps", [{"lap_time_ms": v} for v in (59999, 60000, 3600000, 3600001)])
    assert rows(silver.build("laps", df), "lap_number", "lap_time_ms") == [
        (1, None), (2, 60000), (3, 3600000), (4, None)
    ]


def test_compound_names(spark):
    df = log(spark, "laps", [{"compound": v} for v in ("soft", "Foo", None)])
    assert rows(silver.build("laps", df), "lap_number", "compound") == [
        (1, "SOFT"), (2, "UNKNOWN"), (3, "UNKNOWN")
    ]


def test_track_status_labels(spark):
    df = log(spark, "track_status", [{"status_code": v} for v in ("2", "3", "8", None)])
    assert rows(silver.build("track_status", df), "event_id", "status_label") == [
        (1, "YELLOW"), (2, "YELLOW"), (3, "UNKNOWN"), (4, "UNKNOWN")
    ]


def test_retirement_flag(spark):
    df = log(spark, "results", [{"classified_position": v} for v in ("1", "R", None)])
    assert rows(silver.build("results", df), "event_id", "is_dnf") == [
        (1, False), (2, True), (3, False)
    ]


def test_drs_flag_keeps_null(spark):
    df = log(spark, "telemetry", [{"drs": v} for v in (8, 1, None)])
    assert rows(silver.build("telemetry", df), "event_id", "drs_active") == [
        (1, True), (2, False), (3, None)
    ]


def test_fastest_lap_ignores_deleted_laps(spark):
    df = log(
        spark,
        "laps",
        [
            {"lap_time_ms": 90000, "__op": "d"},
            {"lap_time_ms": 91000},
            {"lap_time_ms": 91000},
            {"lap_time_ms": None},
        ],
    )
    assert rows(silver.build("laps", df), "lap_number", "is_fastest_lap") == [
        (2, True), (3, True), (4, None)
    ]


def team_history(spark, pairs):
    return spark.createDataFrame([("D", seq, team) for seq, team in pairs], "key string, seq int, team string")


def versions(spark, pairs, chunk=None):
    return scd2_islands(team_history(spark, pairs), "key", "seq", ["team"], open_end=OPEN_END, chunk=chunk)


X12 = [
    *[(s, "A") for s in range(202401, 202406)],
    *[(s, "B") for s in range(202406, 202411)],
    (202411, "A"),
]


def test_versions_return_to_an_earlier_value(spark):
    expected = [
        ("A", 202401, 202405, 202405, False),
        ("A", 202411, 202411, 999999, True),
        ("B", 202406, 202410, 202410, False),
    ]
    columns = ("team", "_valid_from_seq", "_valid_to_seq_observed", "_valid_to_seq_excl", "is_current")
    for chunk in (None, 2, 7):
        assert rows(versions(spark, X12, chunk), *columns) == expected


def lookup(spark, pairs, seq):
    fact = spark.createDataFrame([("D", seq)], "key string, seq int")
    dim = versions(spark, pairs).select("key", "team", "_valid_from_seq", "_valid_to_seq_excl")
    found = point_in_time_join(fact, dim, ["key"], "seq", "_valid_from_seq", "_valid_to_seq_excl", 4)
    return rows(found, "team")


def test_point_in_time_inside_and_in_a_gap(spark):
    assert lookup(spark, X12, 202408) == [("B",)]
    assert lookup(spark, [(202401, "A"), (202403, "A"), (202406, "B")], 202405) == [("A",)]
    assert lookup(spark, X12, 202301) == [(None,)]


def test_all_null_attributes_form_one_version(spark):
    got = rows(versions(spark, [(1, None), (2, None), (3, "A")]), "team", "_valid_from_seq")
    assert got == [("A", 3), (None, 1)]


def test_two_colours_in_one_round_take_the_race(spark):
    df = log(
        spark,
        "results",
        [
            {"team": "T", "team_color": "red", "session_type": "Q"},
            {"team": "T", "team_color": "blue", "session_type": "R"},
        ],
    )
    dim = gold.dim_team_scd2({"results": silver.build("results", df)})
    assert rows(dim, "team", "team_color", "valid_from_round") == [("T", "blue", 1)]


def test_one_row_per_seq_prefers_the_highest(spark):
    df = spark.createDataFrame(
        [("k", 1, 2, "a"), ("k", 1, 3, "b"), (None, 1, 9, "z")], "key string, seq int, p int, v string"
    )
    assert rows(one_row_per_seq(df, "key", "seq", ["v"], ["p"]), "key", "v") == [("k", "b")]


def test_sector_tie_and_missing_time(spark):
    df = spark.createDataFrame(
        [(1, "A", 30.1), (1, "B", 30.1), (1, "C", None)], "race int, driver string, avg double"
    )
    last = group_winner(df, ["race"], ["driver"], {"avg": "s1"})
    assert rows(last, "s1_driver", "s1_s") == [("B", 30.1)]
    first = group_winner(df, ["race"], ["driver"], {"avg": "s1"}, nulls="first")
    assert rows(first, "s1_driver", "s1_s") == [("C", None)]


def test_single_lap_has_no_deviation(spark):
    df = log(spark, "laps", [{"lap_time_ms": 90000, "driver_code": "VER"}])
    summary = gold.fact_driver_season_summary({"laps": silver.build("laps", df)})
    columns = ("total_laps", "avg_lap_s", "lap_consistency_stddev", "personal_bests")
    assert rows(summary, *columns) == [(1, 90.0, None, 1)]


def test_deviation_pools_over_teams(spark):
    times = [(90000, "X"), (92000, "X"), (97000, "Y")]
    df = log(
        spark, "laps", [{"lap_time_ms": t, "team": m, "driver_code": "VER"} for t, m in times]
    )
    summary = gold.fact_driver_season_summary({"laps": silver.build("laps", df)})
    got = rows(summary, "team", F.round("lap_consistency_stddev", 9))
    assert got == [("Y", 3.605551275)]


def test_race_without_weather_or_messages(spark):
    tables = {
        "results": silver.build("results", log(spark, "results", [{"position": 1.0, "driver_code": "VER"}])),
        "laps": silver.build("laps", log(spark, "laps", [])),
        "weather": silver.build("weather", log(spark, "weather", [])),
        "race_control": silver.build("race_control", log(spark, "race_control", [])),
    }
    got = rows(
        gold.race_weekend_summary(tables),
        "winner_code", "was_wet_race", "safety_car_msgs", "yellow_flag_msgs", "red_flag_msgs",
        "avg_air_temp_c", "total_race_laps",
    )
    assert got == [("VER", False, 0, 0, 0, None, None)]


def test_job_duration_is_rounded(spark):
    df = spark.sql(
        "SELECT TIMESTAMP '2024-01-01 00:00:00' AS a, TIMESTAMP '2024-01-01 00:00:01.6' AS b"
    )
    assert df.select(elapsed_seconds("a", F.col("b"))).first()[0] == 2


def test_job_transitions(spark):
    df = spark.createDataFrame(
        [
            (1, 1, "cancelled"), (1, 2, "unknown"),
            (2, 1, "unknown"), (2, 2, "done"),
            (3, 1, "done"), (3, 2, "cancelled"), (3, 3, "failed"),
            (4, 1, "running"),
        ],
        "id int, seq int, status string",
    )
    assert rows(panel.job_status(df), "id", "status") == [
        (1, "cancelled"), (2, "done"), (3, "failed"), (4, "running")
    ]


def test_unplaced_drivers_come_last(spark):
    df = log(spark, "results", [{"position": 2.0}, {"position": None}, {"position": 1.0}])
    ordered = panel.classification(df, 2024, 1, "R")
    assert [r["position"] for r in ordered.collect()] == [1.0, 2.0, None]


def test_replay_gaps_are_scaled_and_capped(spark):
    samples = log(
        spark, "telemetry", [{"session_time_ms": t} for t in (0, 500, 200000)]
    )
    laps = samples.where("false")
    session = ["season", "round", "session_type"]
    schedule = replay.replay_schedule(replay.merge_timeline(samples, laps, session), session, 50.0)
    assert rows(schedule, "at_ms", "gap_s") == [(0, 0.0), (200000, 2.0), (500, 0.01)]


def test_timeline_puts_samples_before_laps_and_flags_missing_times(spark):
    session = ["season", "round", "session_type"]
    samples = log(spark, "telemetry", [{"session_time_ms": 100, "event_id": 9}])
    laps = log(
        spark,
        "telemetry",
        [{"session_time_ms": 100, "event_id": 1}, {"session_time_ms": None, "event_id": 2}],
    )
    timeline = replay.merge_timeline(samples, laps, session)
    schedule = replay.replay_schedule(timeline, session, 1.0)
    assert rows(schedule, "kind", "event_id", "at_ms", "missing_time", "gap_s") == [
        ("lap", 1, 100, False, 0.0), ("lap", 2, 0, True, 0.0), ("tel", 9, 100, False, 0.1)
    ]


def test_added_column_reads_as_null(spark):
    old = spark.createDataFrame([(1,)], "a int")
    new = spark.createDataFrame([(2, "x")], "a int, b string")
    assert rows(cdc.union_evolving(old, new), "a", "b") == [(1, None), (2, "x")]


def test_snapshot_diff_kinds(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y"), (3, None)], "k int, v string")
    b = spark.createDataFrame([(2, "z"), (3, None), (4, "n")], "k int, v string")
    assert rows(cdc.snapshot_diff(a, b, ["k"]), "k", "v", "__op") == [
        (1, "x", "d"), (2, "z", "u"), (4, "n", "c")
    ]


def test_change_helper_orders_by_position(spark):
    df = log(spark, "results", [change(5, "c", event_id=1), change(9, "d", event_id=1)])
    assert silver.build("results", df).count() == 0
