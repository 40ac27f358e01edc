"""Small change logs for the fixtures."""

from __future__ import annotations

from changeloom.schemas import change_schema

SESSION = {"season": 2024, "round": 1, "session_type": "R"}


def log(spark, dataset, rows):
    """Change rows with the given columns; the session and nulls are filled in."""
    schema = change_schema(dataset)
    filled = []
    for n, row in enumerate(rows):
        base = {"event_id": n + 1, **SESSION, "driver_number": "1"}
        if dataset == "laps":
            base["lap_number"] = n + 1
        if dataset == "telemetry":
            base["session_time_ms"] = n
        merged = {**base, **row}
        filled.append(tuple(merged.get(name) for name in schema.names))
    return spark.createDataFrame(filled, schema)


def change(lsn, op, ts=None, **payload):
    return {"__source_lsn": lsn, "__op": op, "__ts_ms": lsn if ts is None else ts, **payload}


def rows(df, *columns):
    """Sorted tuples of the columns."""
    got = [tuple(r) for r in df.select(*columns).collect()]
    return sorted(got, key=lambda t: tuple((v is None, str(v)) for v in t))
