"""Change logs in the session datasets' shape, derived from the test tables.

`lineitem` plays the laps, `events` telemetry and status changes, `orders`
weather, messages, results and audit jobs. Every row of a table takes part.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_ORDER_SESSION = "CASE o_orderstatus WHEN 'F' THEN 'R' WHEN 'O' THEN 'Q' ELSE 'S' END"
_ORDER_OP = (
    "CASE WHEN o_custkey % 11 = 0 THEN 'd' WHEN o_orderpriority = '1-URGENT' THEN 'c' "
    "WHEN o_orderpriority = '2-HIGH' THEN 'u' WHEN o_orderpriority <> '5-LOW' THEN 'r' END"
)
_ORDER_KEYS = [
    "CAST(year(o_orderdate) AS INT) AS season",
    "CAST(month(o_orderdate) AS INT) AS round",
    f"{_ORDER_SESSION} AS session_type",
]
_ORDER_META = [
    f"{_ORDER_OP} AS __op",
    "unix_date(CAST(o_orderdate AS DATE)) * 86400000L AS __ts_ms",
    "o_orderkey AS __source_lsn",
]
_EVENT_OP = (
    "CASE event_type WHEN 'signup' THEN 'c' WHEN 'purchase' THEN 'u' "
    "WHEN 'error' THEN 'd' WHEN 'click' THEN 'r' END"
)
_EVENT_KEYS = [
    "CAST(year(ts) AS INT) AS season",
    "CAST(day(ts) AS INT) AS round",
    "CASE WHEN hour(ts) < 8 THEN 'FP1' WHEN hour(ts) < 16 THEN 'Q' ELSE 'R' END AS session_type",
]
_EVENT_META = [
    f"{_EVENT_OP} AS __op",
    "unix_micros(CAST(ts AS TIMESTAMP)) DIV 1000 AS __ts_ms",
    "event_id AS __source_lsn",
]


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(
        "*", "CAST(floor(o_totalprice * 100 + 0.5) AS BIGINT) AS cents"
    )


def laps_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "lineitem")
        .selectExpr("*", "CAST(floor(l_extendedprice * 100 + 0.5) AS BIGINT) AS cents")
        .selectExpr(
            "l_orderkey * 1000000000 + l_partkey * 10 + l_linenumber AS event_id",
            "CAST(year(l_shipdate) AS INT) AS season",
            "CAST(month(l_shipdate) AS INT) AS round",
            "CASE l_returnflag WHEN 'R' THEN 'R' WHEN 'A' THEN 'Q' ELSE 'FP1' END AS session_type",
            "CAST(l_suppkey AS STRING) AS driver_number",
            "concat('D', l_suppkey) AS driver_code",
            "CASE WHEN l_partkey % 50 > 0 THEN concat('T', l_suppkey % 10) END AS team",
            "l_linenumber AS lap_number",
            "cents DIV 2 AS lap_time_ms",
            "CASE WHEN l_quantity > 5 THEN CAST(l_quantity AS BIGINT) * 1000 END AS sector1_ms",
            "CAST(floor(l_discount * 100 + 0.5) AS BIGINT) * 500 + 20000 AS sector2_ms",
            "CAST(floor(l_tax * 100 + 0.5) AS BIGINT) * 700 + 15000 AS sector3_ms",
            "CASE l_partkey % 7 WHEN 0 THEN 'soft' WHEN 1 THEN 'MEDIUM' WHEN 2 THEN 'Hard' "
            "WHEN 3 THEN 'wet' WHEN 4 THEN 'Foo' WHEN 5 THEN 'SOFT' END AS compound",
            "CAST(l_partkey % 40 AS INT) AS tyre_life",
            "l_partkey % 5 = 0 AS is_personal_best",
            "CASE WHEN l_linenumber >= 6 THEN cents END AS pit_in_time_ms",
            "CASE WHEN l_linenumber = 1 THEN cents END AS pit_out_time_ms",
            "l_linestatus AS track_status",
            "CASE WHEN l_quantity <= 3 THEN 'd' WHEN l_quantity <= 20 THEN 'u' "
            "WHEN l_quantity <= 30 THEN 'c' WHEN l_quantity <= 48 THEN 'r' END AS __op",
            "unix_date(CAST(l_shipdate AS DATE)) * 86400000L AS __ts_ms",
            "CASE WHEN l_partkey % 10 > 0 THEN l_partkey END AS __source_lsn",
        )
    )


def telemetry_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(
        "event_id",
        *_EVENT_KEYS,
        "CAST(user_id AS STRING) AS driver_number",
        "concat('U', user_id) AS driver_code",
        "concat('T', user_id % 10) AS team",
        "CAST(minute(ts) AS INT) AS lap_number",
        "CAST(hour(ts) AS BIGINT) * 3600000 + (minute(ts) DIV 10) * 600000 AS session_time_ms",
        "CAST(value AS FLOAT) AS speed_kph",
        "CAST(value / 3 AS FLOAT) AS throttle_pct",
        "event_type = 'error' AS brake",
        "CAST(event_id % 10 AS INT) AS gear",
        "CAST(value * 60 AS FLOAT) AS rpm",
        "CASE WHEN event_id % 17 > 0 THEN CAST(event_id % 16 AS INT) END AS drs",
        "CAST(value AS FLOAT) AS x_pos",
        "CAST(user_id AS FLOAT) AS y_pos",
        "CAST(NULL AS FLOAT) AS z_pos",
        *_EVENT_META,
    )


def weather_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _orders(spark, sf_dir).selectExpr(
        "o_orderkey DIV 3 AS event_id",
        *_ORDER_KEYS,
        "cents % 7200000 AS session_time_ms",
        "CAST(cents % 80 - 15 AS FLOAT) AS air_temp_c",
        "CAST(cents % 110 AS FLOAT) AS humidity_pct",
        "CAST(cents % 500 + 700 AS FLOAT) AS pressure_mbar",
        "CASE WHEN cents % 3 > 0 THEN cents % 40 = 1 END AS rainfall",
        "CAST(cents % 120 - 20 AS FLOAT) AS track_temp_c",
        "CAST(cents % 360 AS INT) AS wind_direction",
        "CAST(cents % 30 - 5 AS FLOAT) AS wind_speed_ms",
        *_ORDER_META,
    )


def race_control_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _orders(spark, sf_dir).selectExpr(
        "o_orderkey DIV 2 AS event_id",
        *_ORDER_KEYS,
        "CAST(o_orderdate AS TIMESTAMP) AS msg_time",
        "CASE o_custkey % 4 WHEN 0 THEN ' SafetyCar' WHEN 1 THEN 'Flag ' WHEN 2 THEN 'Drs' END "
        "AS category",
        "CASE o_custkey % 3 WHEN 0 THEN ' drs enabled' "
        "WHEN 1 THEN concat('DRS Disabled in zone ', o_orderpriority) "
        "ELSE concat('note ', o_orderpriority) END AS message",
        "concat(' ', lower(o_orderpriority)) AS status",
        "CASE o_orderkey % 5 WHEN 0 THEN 'yellow ' WHEN 1 THEN 'Double Yellow' "
        "WHEN 2 THEN 'red' WHEN 3 THEN 'GREEN' END AS flag",
        "' track ' AS scope",
        "CAST(o_orderkey % 3 AS INT) AS sector",
        "CAST(o_custkey % 99 AS STRING) AS racing_number",
        "CAST(cents % 70 AS INT) AS lap_number",
        *_ORDER_META,
    )


def track_status_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(
        "event_id DIV 2 AS event_id",
        *_EVENT_KEYS,
        "CAST(hour(ts) AS BIGINT) * 3600000 + minute(ts) * 60000 AS session_time_ms",
        "CASE WHEN event_id % 9 > 0 THEN CAST(event_id % 9 AS STRING) END AS status_code",
        "event_type AS message",
        *_EVENT_META,
    )


def session_status_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(
        "event_id DIV 2 AS event_id",
        *_EVENT_KEYS,
        "CASE WHEN event_id % 13 > 0 THEN CAST(hour(ts) AS BIGINT) * 3600000 END "
        "AS session_time_ms",
        "concat(' ', event_type) AS status",
        *_EVENT_META,
    )


def results_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _orders(spark, sf_dir).selectExpr(
        "o_orderkey DIV 2 AS event_id",
        *_ORDER_KEYS,
        "CAST(o_custkey DIV 15 AS STRING) AS driver_number",
        "concat('D', o_custkey DIV 15) AS driver_code",
        "concat('Driver ', o_custkey DIV 15, "
        "CASE WHEN year(o_orderdate) >= 1998 THEN ' Jr' ELSE '' END) AS full_name",
        "CASE WHEN cents % 50 > 0 THEN concat('T', (o_custkey DIV 15) % 10) END AS team",
        "concat('#', ((o_custkey DIV 15) % 10 + year(o_orderdate) DIV 2) % 4, cents % 2) "
        "AS team_color",
        "CASE WHEN cents % 23 > 0 THEN CAST(cents % 20 + 1 AS FLOAT) END AS position",
        "CASE WHEN cents % 6 = 0 THEN 'R' WHEN cents % 11 > 0 "
        "THEN CAST(cents % 20 + 1 AS STRING) END AS classified_position",
        "CAST((cents DIV 20) % 20 + 1 AS FLOAT) AS grid_position",
        "70000 + cents % 20000 AS q1_ms",
        "CASE WHEN cents % 3 > 0 THEN 69000 + cents % 19000 END AS q2_ms",
        "CASE WHEN cents % 2 > 0 THEN 68000 + cents % 18000 END AS q3_ms",
        "CASE WHEN cents % 6 > 0 THEN 5400000 + cents % 90000 END AS race_time_ms",
        "CASE WHEN cents % 6 = 0 THEN ' Retired' ELSE 'Finished ' END AS status",
        "CAST(cents % 30 - 3 AS FLOAT) AS points",
        *_ORDER_META,
    )


def jobs_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _orders(spark, sf_dir).selectExpr(
        "o_orderkey DIV 4 AS id",
        "CAST(year(o_orderdate) AS INT) AS season",
        "concat('GP', o_custkey % 24) AS gp",
        f"{_ORDER_SESSION} AS session_type",
        "CASE WHEN o_custkey % 3 > 0 THEN concat('D', o_custkey DIV 15) END AS driver",
        "CASE WHEN cents % 2 = 0 THEN 'batch' ELSE 'replay' END AS mode",
        "CAST(cents % 50 AS FLOAT) AS speed",
        "CAST(NULL AS INT) AS telemetry_limit",
        "CASE o_orderstatus WHEN 'O' THEN 'running' WHEN 'F' THEN 'done' ELSE 'failed' END "
        "AS status",
        "CAST(o_custkey AS INT) AS pid",
        "concat('job-', o_orderkey DIV 4, '.log') AS log_path",
        "CASE WHEN o_orderstatus = 'P' THEN o_orderpriority END AS error_message",
        "CAST(o_orderdate AS TIMESTAMP) AS created_at",
        "CASE WHEN o_orderstatus <> 'O' THEN "
        "timestamp_micros(unix_micros(CAST(o_orderdate AS TIMESTAMP)) + cents * 100) END "
        "AS finished_at",
        *_ORDER_META,
    )


CHANGES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "telemetry": telemetry_changes,
    "laps": laps_changes,
    "weather": weather_changes,
    "race_control": race_control_changes,
    "track_status": track_status_changes,
    "session_status": session_status_changes,
    "results": results_changes,
    "ingestion_jobs": jobs_changes,
}
