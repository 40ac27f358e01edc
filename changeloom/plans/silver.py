"""Current, cleaned state of the seven session datasets.

`state` turns change rows into one row per key, tombstones and log position
included, so that it can absorb later batches. `complete` adds the derived
columns, and `live` is what readers see.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeloom.functions.clean import (
    code_label,
    enum_or_unknown,
    in_range,
    normal_text,
    not_numeric,
    seconds,
)
from changeloom.operators.cdc import DELETED, LSN, OP, TS_MS, is_tombstone, latest_by_key
from changeloom.operators.quality import Accepted, NotNull, Rule, Unique
from changeloom.operators.winners import flag_group_minimum
from changeloom.schemas import SESSION

STATE_ORDER = ("_lsn", "_ts_ms")
STATE_TIEBREAK = ("event_id",)

# Tyre compounds, track status codes, active DRS readings.
COMPOUNDS = (
    "SOFT", "MEDIUM", "HARD", "INTERMEDIATE", "WET",
    "SUPERSOFT", "ULTRASOFT", "HYPERSOFT", "SUPERHARD",
)
TRACK_STATUS = {
    "1": "ALL_CLEAR",
    "2": "YELLOW",
    "3": "YELLOW",
    "4": "SAFETY_CAR",
    "5": "RED_FLAG",
    "6": "VIRTUAL_SAFETY_CAR",
    "7": "VSC_ENDING",
}
DRS_ACTIVE = (8, 10, 12, 14)


def _laps_columns() -> list:
    return [
        "driver_number", "driver_code", "team", "lap_number",
        in_range("lap_time_ms", 60_000, 3_600_000).alias("lap_time_ms"),
        "sector1_ms", "sector2_ms", "sector3_ms",
        enum_or_unknown("compound", COMPOUNDS).alias("compound"),
        "tyre_life", "is_personal_best", "pit_in_time_ms", "pit_out_time_ms", "track_status",
    ]


def _telemetry_columns() -> list:
    return [
        "driver_number", "driver_code", "team", "lap_number", "session_time_ms",
        in_range("speed_kph", 0, 400).alias("speed_kph"),
        in_range("throttle_pct", 0, 100).alias("throttle_pct"),
        "brake",
        in_range("gear", 0, 8).alias("gear"),
        in_range("rpm", 0, 20_000).alias("rpm"),
        F.col("drs").isin(*DRS_ACTIVE).alias("drs_active"),
        "x_pos", "y_pos", "z_pos",
    ]


def _weather_columns() -> list:
    return [
        "session_time_ms",
        in_range("air_temp_c", -10, 60).alias("air_temp_c"),
        in_range("track_temp_c", -10, 90).alias("track_temp_c"),
        in_range("humidity_pct", 0, 100).alias("humidity_pct"),
        in_range("pressure_mbar", 800, 1100).alias("pressure_mbar"),
        in_range("wind_speed_ms", 0).alias("wind_speed_ms"),
        "wind_direction",
        F.coalesce("rainfall", F.lit(False)).alias("rainfall"),
    ]


def _race_control_columns() -> list:
    message = normal_text("message")
    return [
        F.col("msg_time").cast("timestamp").alias("msg_time"),
        normal_text("category").alias("category"),
        "message",
        normal_text("status").alias("status"),
        normal_text("flag").alias("flag"),
        normal_text("scope").alias("scope"),
        "sector", "racing_number", "lap_number",
        normal_text("flag").isin("YELLOW", "DOUBLE YELLOW").alias("is_yellow_flag"),
        (normal_text("category") == "SAFETYCAR").alias("is_safety_car"),
        message.contains("DRS ENABLED").alias("is_drs_enabled_msg"),
        message.contains("DRS DISABLED").alias("is_drs_disabled_msg"),
    ]


def _track_status_columns() -> list:
    return [
        "session_time_ms",
        seconds("session_time_ms").alias("session_time_s"),
        "status_code",
        code_label("status_code", TRACK_STATUS).alias("status_label"),
        "message",
    ]


def _session_status_columns() -> list:
    return [
        "session_time_ms",
        seconds("session_time_ms").alias("session_time_s"),
        normal_text("status").alias("status"),
    ]


def _results_columns() -> list:
    return [
        "driver_number", "driver_code", "full_name", "team", "team_color",
        in_range("points", 0).alias("points"),
        "position", "classified_position", "grid_position",
        "q1_ms", "q2_ms", "q3_ms", "race_time_ms",
        normal_text("status").alias("status"),
        not_numeric("classified_position").alias("is_dnf"),
    ]


Derive = Callable[[DataFrame, str | None], DataFrame]


def _with_seconds(**columns: str) -> Derive:
    return lambda df, _work: df.withColumns({new: seconds(old) for new, old in columns.items()})


def _derive_laps(df: DataFrame, work: str | None) -> DataFrame:
    timed = _with_seconds(
        lap_time_s="lap_time_ms",
        sector1_s="sector1_ms",
        sector2_s="sector2_ms",
        sector3_s="sector3_ms",
    )(df, work)
    # A deleted lap cannot be the fastest of its session.
    counted = timed.withColumn("_counted", F.when(~F.col("_is_deleted"), F.col("lap_time_ms")))
    flagged = flag_group_minimum(counted, SESSION, "_counted", "is_fastest_lap", work=work)
    return flagged.drop("_counted")


@dataclass(frozen=True)
class SilverModel:
    name: str
    keys: tuple[str, ...]
    columns: Callable[[], list[Column | str]]
    derive: Derive = lambda df, _work: df
    rules: tuple[Rule, ...] = field(default_factory=tuple)
    # Whether `derive` reads its input more than once.
    reads_twice: bool = False


_EVENT = ("event_id",)
_EVENT_RULES = (NotNull("event_id"), Unique("event_id"))

MODELS = {
    m.name: m
    for m in (
        SilverModel(
            "telemetry",
            (*SESSION, "driver_number", "session_time_ms"),
            _telemetry_columns,
            rules=(NotNull("driver_code"), NotNull("session_time_ms")),
        ),
        SilverModel(
            "laps",
            (*SESSION, "driver_number", "lap_number"),
            _laps_columns,
            _derive_laps,
            (
                NotNull("driver_code"),
                NotNull("lap_number"),
                Accepted("compound", (*COMPOUNDS, "UNKNOWN")),
            ),
            reads_twice=True,
        ),
        SilverModel(
            "weather",
            _EVENT,
            _weather_columns,
            _with_seconds(session_time_s="session_time_ms"),
            (*_EVENT_RULES, NotNull("session_time_ms")),
        ),
        SilverModel(
            "race_control",
            _EVENT,
            _race_control_columns,
            rules=(*_EVENT_RULES, NotNull("message")),
        ),
        SilverModel(
            "track_status",
            _EVENT,
            _track_status_columns,
            rules=(
                *_EVENT_RULES,
                Accepted("status_label", tuple(dict.fromkeys((*TRACK_STATUS.values(), "UNKNOWN")))),
            ),
        ),
        SilverModel("session_status", _EVENT, _session_status_columns, rules=_EVENT_RULES),
        SilverModel(
            "results",
            _EVENT,
            _results_columns,
            _with_seconds(
                q1_s="q1_ms", q2_s="q2_ms", q3_s="q3_ms", race_time_s="race_time_ms"
            ),
            (*_EVENT_RULES, NotNull("driver_code")),
        ),
    )
}


def state(model: SilverModel, changes: DataFrame) -> DataFrame:
    """Newest cleaned row per key, with `_is_deleted` and the log position."""
    newest = latest_by_key(changes, model.keys, tiebreak=STATE_TIEBREAK)
    deleted = DELETED if DELETED in changes.columns else None
    return newest.select(
        "event_id",
        *SESSION,
        *model.columns(),
        is_tombstone(OP, deleted).alias("_is_deleted"),
        F.col(LSN).alias("_lsn"),
        F.col(TS_MS).alias("_ts_ms"),
        F.current_timestamp().alias("_silver_loaded_at"),
    )


def complete(model: SilverModel, current: DataFrame, work: str | None = None) -> DataFrame:
    """A state with its derived columns, tombstones still in place.

    `work` is a shared folder for what the derivation wants to write first.
    """
    return model.derive(current, work)


def live(table: DataFrame) -> DataFrame:
    """Readers' view of a completed state: tombstones and log position gone."""
    return table.where(~F.col("_is_deleted")).drop("_lsn", "_ts_ms")


def build(
    name: str,
    changes: DataFrame,
    work: str | None = None,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Live table straight from a whole change log.

    With `work`, a shared folder, the collapsed state (or the `columns` of it that
    later steps need) is written there once, and every use reads that instead of
    collapsing the log again.
    """
    model = MODELS[name]
    current = state(model, changes)
    if work is None:
        return live(complete(model, current))
    if columns is not None:
        current = current.select(*columns, "_is_deleted", "_lsn", "_ts_ms")
    current.write.parquet(f"{work}/state")
    stored = changes.sparkSession.read.schema(current.schema).parquet(f"{work}/state")
    return live(complete(model, stored, f"{work}/derived"))
