"""What a merge leaves unshuffled, unwritten and removed."""

from dataclasses import replace
from pathlib import Path

import pytest
from builders import change, log, rows
from pyspark.sql import functions as F

from changeloom.operators.quality import ExpectationFailed, Unique
from changeloom.plans import merge, silver
from changeloom.plans.merge import merge_changes, read_live
from changeloom.session import FREES_SHUFFLES, freed_shuffles

SHOWN = ("season", "event_id", "driver_code", "_is_deleted", "_lsn")


def results(spark, *changes_):
    return log(spark, "results", [change(lsn, op, event_id=i, season=s, driver_code=d) for lsn, op, i, s, d in changes_])


BATCHES = [
    [(10, "c", 1, 2020, "A"), (11, "c", 2, 2020, "B"), (12, "c", 3, 2021, "C"), (13, "c", None, 2020, "N"), (14, "d", 4, 2021, "D")],
    # Moves, an older change, a delete of a moved key, null keys of two sessions.
    [(20, "u", 1, 2021, "A2"), (5, "u", 2, 2022, "old"), (21, "u", None, 2021, "N2"), (22, "u", 4, 2020, "D2")],
    [(30, "d", 1, 2021, "A2"), (9, "u", None, 2020, "N0"), (31, "u", 5, 2020, "E"), (20, "u", 1, 2021, "A2")],
]


def stored_state(spark, folder, few, monkeypatch):
    monkeypatch.setattr(merge, "FEW_KEYS", few)
    path, model = f"{folder}/{few}", silver.MODELS["results"]
    for batch in BATCHES:
        merge_changes(spark, model, results(spark, *batch), path, gate=False)
    return rows(spark.read.schema(merge.stored_schema(spark, model)).parquet(path), *SHOWN)


def test_only_rows_of_the_batch_are_collapsed_again(spark, folder, monkeypatch):
    """With few keys the other rows pass; the state is that of collapsing everything."""
    whole = stored_state(spark, folder, -1, monkeypatch)
    seen = []
    real = merge.newest_copy
    monkeypatch.setattr(merge, "newest_copy", lambda df, keys: seen.append(df.count()) or real(df, keys))
    assert stored_state(spark, folder, 500_000, monkeypatch) == whole
    # Second batch: its 4 rows and the stored ones of the events 1, 2 and 4 and of no event.
    assert seen[0] == 8 and len(seen) == 2


def test_a_batch_that_meets_no_row_is_not_collapsed_again(spark, folder, monkeypatch):
    model, path = silver.MODELS["results"], f"{folder}/state"
    merge_changes(spark, model, results(spark, (1, "c", 1, 2020, "A")), path)
    monkeypatch.setattr(merge, "newest_copy", None)
    merge_changes(spark, model, results(spark, (2, "c", 2, 2021, "B")), path)
    assert rows(read_live(spark, path, model), "event_id", "season") == [(1, 2020), (2, 2021)]


def test_a_refused_batch_is_not_staged_nor_in_the_index(spark, folder, monkeypatch):
    model = replace(silver.MODELS["laps"], rules=(*silver.MODELS["laps"].rules, Unique("event_id")))
    path = f"{folder}/state"

    def lap(season):
        return log(spark, "laps", [change(1, "c", event_id=7, season=season, driver_code="A", lap_time_ms=70_000)])

    merge_changes(spark, model, lap(2020), path)
    with monkeypatch.context() as patch:
        patch.setattr(merge, "balanced", None)
        with pytest.raises(ExpectationFailed, match="in other sessions"):
            merge_changes(spark, model, lap(2021), path)
    index = spark.read.parquet(f"{path}-keys/event_id")
    assert rows(index, "event_id", "season") == [(7, 2020)]
    assert rows(read_live(spark, path, model), "season") == [(2020,)]


def test_working_folders_of_a_merge_are_removed(spark, folder, monkeypatch):
    model = silver.MODELS["laps"]
    monkeypatch.setattr(merge, "shared_dir", lambda session, purpose: f"{folder}/{purpose}")
    laps = log(spark, "laps", [change(n, "c", driver_code="A", lap_time_ms=70_000 + n) for n in range(5)])
    merged = merge_changes(spark, model, laps, f"{folder}/state")
    assert [p.name for p in Path(f"{folder}/merge-laps").iterdir()] == ["touched"]
    assert merged.touched.count() == 1


def test_files_of_a_shuffle_go_only_where_asked(spark, folder):
    df = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
    with freed_shuffles(spark), freed_shuffles(spark):
        assert spark.conf.get(FREES_SHUFFLES) == "true"
        df.write.parquet(f"{folder}/a")
    assert spark.conf.get(FREES_SHUFFLES) == "false"
    assert spark.read.parquet(f"{folder}/a").count() == 7
