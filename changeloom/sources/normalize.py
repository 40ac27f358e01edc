"""Raw timing frames to typed source rows, one projection per dataset.

Raw frames hold intervals, doubles with NaN for "missing", and text. Missing
values become real nulls; a missing key is left to the not-null expectations.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changeloom.functions.convert import (
    as_bool,
    as_float,
    as_instant,
    as_int,
    as_millis,
    as_text,
)

Convert = Callable[[Column, T.DataType], Column]

# Raw frame column behind each source column.
RAW_COLUMNS: dict[str, dict[str, tuple[str, Convert]]] = {
    "telemetry": {
        "driver_number": ("DriverNumber", as_text),
        "driver_code": ("Driver", as_text),
        "team": ("Team", as_text),
        "lap_number": ("LapNumber", as_int),
        "session_time_ms": ("SessionTime", as_millis),
        "speed_kph": ("Speed", as_float),
        "throttle_pct": ("Throttle", as_float),
        "brake": ("Brake", as_bool),
        "gear": ("nGear", as_int),
        "rpm": ("RPM", as_float),
        "drs": ("DRS", as_int),
        "x_pos": ("X", as_float),
        "y_pos": ("Y", as_float),
        "z_pos": ("Z", as_float),
    },
    "laps": {
        "driver_number": ("DriverNumber", as_text),
        "driver_code": ("Driver", as_text),
        "team": ("Team", as_text),
        "lap_number": ("LapNumber", as_int),
        "lap_time_ms": ("LapTime", as_millis),
        "sector1_ms": ("Sector1Time", as_millis),
        "sector2_ms": ("Sector2Time", as_millis),
        "sector3_ms": ("Sector3Time", as_millis),
        "compound": ("Compound", as_text),
        "tyre_life": ("TyreLife", as_int),
        "is_personal_best": ("IsPersonalBest", as_bool),
        "pit_in_time_ms": ("PitInTime", as_millis),
        "pit_out_time_ms": ("PitOutTime", as_millis),
        "track_status": ("TrackStatus", as_text),
    },
    "weather": {
        "session_time_ms": ("Time", as_millis),
        "air_temp_c": ("AirTemp", as_float),
        "humidity_pct": ("Humidity", as_float),
        "pressure_mbar": ("Pressure", as_float),
        "rainfall": ("Rainfall", as_bool),
        "track_temp_c": ("TrackTemp", as_float),
        "wind_direction": ("WindDirection", as_int),
        "wind_speed_ms": ("WindSpeed", as_float),
    },
    "race_control": {
        "msg_time": ("Time", as_instant),
        "category": ("Category", as_text),
        "message": ("Message", as_text),
        "status": ("Status", as_text),
        "flag": ("Flag", as_text),
        "scope": ("Scope", as_text),
        "sector": ("Sector", as_int),
        "racing_number": ("RacingNumber", as_text),
        "lap_number": ("Lap", as_int),
    },
    "track_status": {
        "session_time_ms": ("Time", as_millis),
        "status_code": ("Status", as_text),
        "message": ("Message", as_text),
    },
    "session_status": {
        "session_time_ms": ("Time", as_millis),
        "status": ("Status", as_text),
    },
    "results": {
        "driver_number": ("DriverNumber", as_text),
        "driver_code": ("Abbreviation", as_text),
        "full_name": ("FullName", as_text),
        "team": ("TeamName", as_text),
        "team_color": ("TeamColor", as_text),
        "position": ("Position", as_float),
        "classified_position": ("ClassifiedPosition", as_text),
        "grid_position": ("GridPosition", as_float),
        "q1_ms": ("Q1", as_millis),
        "q2_ms": ("Q2", as_millis),
        "q3_ms": ("Q3", as_millis),
        "race_time_ms": ("Time", as_millis),
        "status": ("Status", as_text),
        "points": ("Points", as_float),
    },
}


def normalize(
    raw: DataFrame, dataset: str, season: Column, round_: Column, session_type: Column
) -> DataFrame:
    """Source rows of one dataset; a raw column that is absent reads as null."""
    kinds = {f.name: f.dataType for f in raw.schema.fields}
    columns = []
    for name, (raw_name, convert) in RAW_COLUMNS[dataset].items():
        kind = kinds.get(raw_name, T.NullType())
        value = F.col(raw_name) if raw_name in kinds else F.lit(None)
        columns.append(convert(value, kind).alias(name))
    return raw.select(
        season.cast("int").alias("season"),
        round_.cast("int").alias("round"),
        session_type.cast("string").alias("session_type"),
        *columns,
    )


def for_driver(
    df: DataFrame, driver: str | None = None, limit: int | None = None
) -> DataFrame:
    """Optional driver filter, then the first `limit` samples by session time."""
    if driver is not None:
        df = df.where(F.col("driver_code") == driver)
    if limit is not None:
        df = df.orderBy(F.col("session_time_ms").asc_nulls_first()).limit(limit)
    return df
