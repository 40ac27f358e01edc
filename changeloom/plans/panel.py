"""Audit and coverage queries of the operators' panel."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeloom.functions.clean import elapsed_seconds, instant_text
from changeloom.operators.cdc import latest_by_key
from changeloom.schemas import SESSION
from changeloom.streaming.bronze import table_counts as count_tables

# Label of "all drivers", statuses of an ingestion job.
ALL_DRIVERS = "todos"
RUNNING = "running"
FINAL = ("done", "failed")
GUARDED = ("cancelled", "unknown")


def current_jobs(changes: DataFrame) -> DataFrame:
    """Newest state per audit job."""
    return latest_by_key(changes, ["id"])


def job_status(requests: DataFrame) -> DataFrame:
    """Status of each job after its requested transitions (id, seq, status).

    A job starts running. Done and failed always apply; cancelled and unknown
    only to a job that still runs, so only the first of them can count.
    """
    final = F.col("status").isin(*FINAL)
    guarded = F.col("status").isin(*GUARDED)
    return requests.groupBy("id").agg(
        F.coalesce(
            F.max(F.when(final, F.struct("seq", "status")))["status"],
            F.min(F.when(guarded, F.struct("seq", "status")))["status"],
            F.lit(RUNNING),
        ).alias("status")
    )


def job_history(jobs: DataFrame, limit: int = 100, now: Column | None = None) -> DataFrame:
    """Newest jobs with their duration in seconds; a running one counts to now."""
    end = F.coalesce(F.col("finished_at"), F.current_timestamp() if now is None else now)
    newest = jobs.orderBy(F.col("created_at").desc(), F.col("id").desc()).limit(limit)
    return newest.select(
        "id", "season", "gp", "session_type",
        F.coalesce("driver", F.lit(ALL_DRIVERS)).alias("driver"),
        "mode", "status", "log_path", "error_message",
        instant_text("created_at").alias("created_at"),
        instant_text("finished_at").alias("finished_at"),
        elapsed_seconds("created_at", end).alias("duration_s"),
    )


def coverage(telemetry: DataFrame, laps: DataFrame) -> DataFrame:
    """Drivers, telemetry rows and lap rows per session, newest first."""
    samples = telemetry.groupBy(*SESSION).agg(
        F.count_distinct("driver_code").alias("pilotos"),
        F.count(F.lit(1)).alias("linhas_telemetria"),
    )
    lap_rows = laps.groupBy(*SESSION).agg(F.count(F.lit(1)).alias("_laps"))
    return (
        samples.join(lap_rows, list(SESSION), "left")
        .withColumn("linhas_laps", F.coalesce("_laps", F.lit(0).cast("long")))
        .drop("_laps")
        .orderBy(F.desc("season"), F.desc("round"), F.asc("session_type"))
    )


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per captured table, by table name."""
    return count_tables(tables).orderBy("tabela")


def _session(df: DataFrame, season: int, round_: int, session_type: str) -> DataFrame:
    return df.where(
        (F.col("season") == season)
        & (F.col("round") == round_)
        & (F.col("session_type") == session_type)
    )


def classification(
    results: DataFrame, season: int, round_: int, session_type: str
) -> DataFrame:
    """Results of one session by position, unplaced drivers last."""
    return (
        _session(results, season, round_, session_type)
        .select("position", "driver_code", "full_name", "team", "points", "status")
        .orderBy(F.col("position").asc_nulls_last())
    )


def drivers_present(
    telemetry: DataFrame, season: int, round_: int, session_type: str
) -> DataFrame:
    """Drivers of one session with their telemetry rows."""
    return (
        _session(telemetry, season, round_, session_type)
        .groupBy("driver_code", "team")
        .agg(F.count(F.lit(1)).alias("linhas"))
        .orderBy(F.col("driver_code").asc_nulls_last())
    )


def fastest_drivers(summary: DataFrame, n: int = 10) -> DataFrame:
    """The n lowest fastest laps of a season summary."""
    return summary.orderBy(F.col("fastest_lap_s").asc_nulls_last(), "season", "driver_code").limit(n)


def selector_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Sorted distinct choices of a selector."""
    return df.select(*columns).distinct().orderBy(*columns)


