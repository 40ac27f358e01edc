"""Column contracts of the source datasets and their change rows."""

from __future__ import annotations

from pyspark.sql import types as T

SESSION = ("season", "round", "session_type")
RACE = ("season", "round")

# Names and types of the source columns, as Spark DDL.
SOURCE_COLUMNS = {
    "telemetry": """
        event_id BIGINT NOT NULL,
        season INT NOT NULL,
        round INT NOT NULL,
        session_type STRING NOT NULL,
        driver_number STRING NOT NULL,
        driver_code STRING,
        team STRING,
        lap_number INT,
        session_time_ms BIGINT NOT NULL,
        speed_kph FLOAT,
        throttle_pct FLOAT,
        brake BOOLEAN,
        gear INT,
        rpm FLOAT,
        drs INT,
        x_pos FLOAT,
        y_pos FLOAT,
        z_pos FLOAT,
        ingested_at TIMESTAMP NOT NULL
    """,
    "laps": """
        event_id BIGINT NOT NULL,
        season INT NOT NULL,
        round INT NOT NULL,
        session_type STRING NOT NULL,
        driver_number STRING NOT NULL,
        driver_code STRING,
        team STRING,
        lap_number INT NOT NULL,
        lap_time_ms BIGINT,
        sector1_ms BIGINT,
        sector2_ms BIGINT,
        sector3_ms BIGINT,
        compound STRING,
        tyre_life INT,
        is_personal_best BOOLEAN,
        pit_in_time_ms BIGINT,
        pit_out_time_ms BIGINT,
        track_status STRING,
        ingested_at TIMESTAMP NOT NULL
    """,
    "weather": """
        event_id BIGINT NOT NULL,
        season INT NOT NULL,
        round INT NOT NULL,
        session_type STRING NOT NULL,
        session_time_ms BIGINT,
        air_temp_c FLOAT,
        humidity_pct FLOAT,
        pressure_mbar FLOAT,
        rainfall BOOLEAN,
        track_temp_c FLOAT,
        wind_direction INT,
        wind_speed_ms FLOAT,
        ingested_at TIMESTAMP NOT NULL
    """,
    "race_control": """
        event_id BIGINT NOT NULL,
        season INT NOT NULL,
        round INT NOT NULL,
        session_type STRING NOT NULL,
        msg_time TIMESTAMP,
        category STRING,
        message STRING,
        status STRING,
        flag STRING,
        scope STRING,
        sector INT,
        racing_number STRING,
        lap_number INT,
        ingested_at TIMESTAMP NOT NULL
    """,
    "track_status": """
        event_id BIGINT NOT NULL,
        season INT NOT NULL,
        round INT NOT NULL,
        session_type STRING NOT NULL,
        session_time_ms BIGINT,
        status_code STRING,
        message STRING,
        ingested_at TIMESTAMP NOT NULL
    """,
    "session_status": """
        event_id BIGINT NOT NULL,
        season INT NOT NULL,
        round INT NOT NULL,
        session_type STRING NOT NULL,
        session_time_ms BIGINT,
        status STRING,
        ingested_at TIMESTAMP NOT NULL
    """,
    "results": """
        event_id BIGINT NOT NULL,
        season INT NOT NULL,
        round INT NOT NULL,
        session_type STRING NOT NULL,
        driver_number STRING NOT NULL,
        driver_code STRING,
        full_name STRING,
        team STRING,
        team_color STRING,
        position FLOAT,
        classified_position STRING,
        grid_position FLOAT,
        q1_ms BIGINT,
        q2_ms BIGINT,
        q3_ms BIGINT,
        race_time_ms BIGINT,
        status STRING,
        points FLOAT,
        ingested_at TIMESTAMP NOT NULL
    """,
    "ingestion_jobs": """
        id BIGINT NOT NULL,
        season INT NOT NULL,
        gp STRING NOT NULL,
        session_type STRING NOT NULL,
        driver STRING,
        mode STRING NOT NULL,
        speed FLOAT,
        telemetry_limit INT,
        status STRING NOT NULL,
        pid INT,
        log_path STRING,
        error_message STRING,
        created_at TIMESTAMP NOT NULL,
        finished_at TIMESTAMP
    """,
}
# Columns that the log reader adds.
CHANGE_COLUMNS = """
    __op STRING,
    __ts_ms BIGINT,
    __source_lsn BIGINT,
    __source_snapshot STRING,
    __source_table STRING,
    __source_schema STRING,
    __deleted STRING
"""

# Source table of each dataset.
SOURCE_TABLES = {
    "telemetry_events": "telemetry",
    "lap_events": "laps",
    "weather_events": "weather",
    "race_control_messages": "race_control",
    "track_status_events": "track_status",
    "session_status_events": "session_status",
    "session_results": "results",
    "ingestion_jobs": "ingestion_jobs",
}
DATASETS = tuple(SOURCE_TABLES.values())


def source_schema(dataset: str) -> T.StructType:
    """Columns of a source table."""
    return T.StructType.fromDDL(SOURCE_COLUMNS[dataset])


def change_schema(dataset: str) -> T.StructType:
    """Columns of a flat change row; every column may be null on the wire."""
    fields = source_schema(dataset).fields + T.StructType.fromDDL(CHANGE_COLUMNS).fields
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in fields])


def partition_columns(dataset: str) -> tuple[str, ...]:
    """Bronze partitioning; the audit table has no round or session."""
    return ("season",) if dataset == "ingestion_jobs" else SESSION
