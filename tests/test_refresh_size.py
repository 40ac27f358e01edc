"""What refreshes and merges leave unread, unshuffled and unwritten."""

import pytest
from builders import change, log, rows
from pyspark.sql import functions as F

from changeloom.operators.joins import estimated_bytes
from changeloom.plans import merge, silver
from changeloom.plans.merge import merge_changes, read_live
from changeloom.sources import tables
from changeloom.workloads import queries


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    """Orders and line items of two years; a third of the orders moves to another month under its event id."""
    at = str(tmp_path_factory.mktemp("tables"))
    day = "date_add(DATE'2000-01-01', CAST(id * 7 % 700 AS INT))"
    spark.range(900).selectExpr(
        "id AS o_orderkey", "id % 150 AS o_custkey",
        "CASE id % 3 WHEN 0 THEN 'F' WHEN 1 THEN 'O' ELSE 'P' END AS o_orderstatus",
        "CAST(id * 31 % 977 AS DOUBLE) AS o_totalprice", f"{day} AS o_orderdate",
        "element_at(array('1-URGENT', '2-HIGH', '3-MEDIUM', '5-LOW'), CAST(id % 4 AS INT) + 1) AS o_orderpriority",
    ).coalesce(1).write.parquet(f"{at}/orders.parquet")
    spark.range(4000).selectExpr(
        "id DIV 4 AS l_orderkey", "id * 7 % 500 AS l_partkey", "id % 20 AS l_suppkey", "id % 7 + 1 AS l_linenumber",
        "CAST(id % 50 + 1 AS DOUBLE) AS l_quantity", "CAST(id * 37 % 90000 + 1000 AS DOUBLE) AS l_extendedprice",
        "0.05D AS l_discount", "0.02D AS l_tax", "element_at(array('R', 'A', 'N'), CAST(id % 3 AS INT) + 1) AS l_returnflag",
        "'O' AS l_linestatus", f"{day} AS l_shipdate",
    ).coalesce(1).write.parquet(f"{at}/lineitem.parquet")
    return at


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_refreshed_mart_reads_stored_states_only(spark, sf_dir):
    """No change log is collapsed again by one of the joins of the mart."""
    df = queries.refresh_driver_race_mart(spark, sf_dir)
    assert "__source_lsn" not in plan_of(df) and "_source_lsn" not in plan_of(df)
    whole = queries.gold_mart_driver_race_result(spark, sf_dir)
    columns = sorted(df.columns)
    assert df.count() > 0 and rows(df, *columns) == rows(whole, *columns)


def test_touched_sessions_have_their_true_size(spark, sf_dir):
    for name in ("laps", "results"):
        touched = queries._touched(spark, sf_dir, name)
        assert 0 < touched.count() and estimated_bytes(touched) < 100_000


@pytest.mark.parametrize("name", ["driver_season_summary", "race_pace_comparison", "sector_dominance", "race_weekend_summary"])
def test_refreshed_facts_equal_a_full_build(spark, sf_dir, name):
    df = queries.QUERIES[f"refresh_{name}"](spark, sf_dir)
    whole = queries.QUERIES[f"gold_{name}"](spark, sf_dir)
    columns = sorted(df.columns)
    assert df.count() > 0 and rows(df, *columns) == rows(whole, *columns)


def laps_batch(spark, lsn, *laps):
    return log(spark, "laps", [change(lsn, "u", event_id=i, season=s, lap_number=n, driver_code="A", lap_time_ms=70_000 + i) for i, s, n in laps])


def test_first_merge_collapses_its_rows_once(spark, folder, monkeypatch):
    called = []
    real = merge.newest_copy
    monkeypatch.setattr(merge, "newest_copy", lambda rows_, keys: called.append(keys) or real(rows_, keys))
    model, path = silver.MODELS["laps"], f"{folder}/state"
    merge_changes(spark, model, laps_batch(spark, 1, (1, 2020, 1), (2, 2020, 2), (3, 2021, 1)), path)
    assert called == []
    merge_changes(spark, model, laps_batch(spark, 2, (4, 2020, 1)), path)
    assert len(called) == 1
    state = read_live(spark, path, model)
    assert rows(state, "season", "event_id", "is_fastest_lap") == [(2020, 2, True), (2020, 4, False), (2021, 3, True)]


def test_replaced_partitions_are_moved_not_written_again(spark, folder, monkeypatch):
    def refused(df, by):
        raise AssertionError("rows of a staged table are shuffled again")

    model, path = silver.MODELS["laps"], f"{folder}/state"
    monkeypatch.setattr(tables, "balanced", refused)
    merge_changes(spark, model, laps_batch(spark, 1, (1, 2020, 1), (3, 2021, 1)), path)
    merge_changes(spark, model, laps_batch(spark, 2, (4, 2020, 1), (5, None, 1)), path)
    state = read_live(spark, path, model)
    assert rows(state, "season", "event_id") == [(2020, 4), (2021, 3), (None, 5)]


def test_streamed_results_are_landed_in_files_of_any_number(spark, sf_dir, monkeypatch):
    """Three batches, whatever the number of files: a file does not grow with the table."""
    seen = {}
    real = queries.bronze_stream.finish
    monkeypatch.setattr(queries.bronze_stream, "finish", lambda running: seen.update(real(running)))
    wanted = rows(queries.silver_results(spark, sf_dir), "event_id", "points")
    kept = spark.conf.get("spark.sql.shuffle.partitions")
    written = []
    reader = queries.bronze_stream.read_new_files
    monkeypatch.setattr(queries.bronze_stream, "read_new_files", lambda s, path, *a, **k: written.append(len(s.read.parquet(path).inputFiles())) or reader(s, path, *a, **k))
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    try:
        found = rows(queries.stream_silver_results(spark, sf_dir), "event_id", "points")
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", kept)
    assert found == wanted and written == [7] and seen["batches"] == 3
