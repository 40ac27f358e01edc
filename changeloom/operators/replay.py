"""Timeline of two event kinds and the paced gaps between its events."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changeloom.operators.joins import lookup_join
from changeloom.operators.ordered import neighbours
from changeloom.operators.scan import running_sum

# Event kinds of the merged timeline, earlier first on equal times.
SAMPLE = "tel"
LAP = "lap"
# Fixed value: longest gap between two replayed events, in seconds.
GAP_CAP_S = 2.0


def merge_timeline(
    samples: DataFrame,
    laps: DataFrame,
    session: Sequence[str],
    time: str = "session_time_ms",
    event: str = "event_id",
) -> DataFrame:
    """One tagged timeline; an event without a time goes to 0 and is flagged."""

    def tagged(df: DataFrame, kind: str) -> DataFrame:
        return df.select(
            *session,
            F.coalesce(F.col(time), F.lit(0).cast("long")).alias("at_ms"),
            F.lit(kind).alias("kind"),
            F.col(event).alias("event_id"),
            F.col(time).isNull().alias("missing_time"),
        )

    return tagged(samples, SAMPLE).unionByName(tagged(laps, LAP))


def replay_schedule(
    timeline: DataFrame,
    session: Sequence[str],
    speed: float,
    cap: float = GAP_CAP_S,
    chunk: int = 60_000,
) -> DataFrame:
    """Add `gap_s`, the wait before each event at `speed` times real time.

    Only the first event of a moment waits. Moments are aggregated first (one row
    per session and millisecond) and linked slice by slice, then joined back on
    the identity of that first event, so a crowded moment or session is never
    gathered in one task.
    """
    session = list(session)
    first_sample = F.min(F.when(F.col("kind") == SAMPLE, F.col("event_id")))
    moments = timeline.groupBy(*session, "at_ms").agg(
        first_sample.alias("_sample"), F.min("event_id").alias("_any")
    )
    moments = moments.select(
        *session,
        "at_ms",
        F.when(F.col("_sample").isNotNull(), SAMPLE).otherwise(LAP).alias("kind"),
        F.coalesce("_sample", "_any").alias("event_id"),
    )
    elapsed = (F.col("at_ms") - F.col("_prev")["at_ms"]).cast("double") / 1000.0 / speed
    gaps = neighbours(moments, session, "at_ms", (), chunk).select(
        *session,
        "at_ms",
        "kind",
        "event_id",
        F.least(F.greatest(elapsed, F.lit(0.0)), F.lit(float(cap))).alias("_gap"),
    )
    identity = [*session, "at_ms", "kind", "event_id"]
    joined = timeline.join(gaps, identity, "left")
    gap = F.coalesce("_gap", F.lit(0.0)).alias("gap_s")
    return joined.select(*timeline.columns, gap)


def due_times(schedule: DataFrame, session: Sequence[str]) -> DataFrame:
    """Add `due_s`: when each event is due, counted from the start of its session's replay.

    The waits of all moments up to the event's own, added as whole microseconds. Moments are
    aggregated first, summed in two levels however long the session is, and joined back.
    """
    session = list(session)
    waits = F.sum(F.round(F.col("gap_s") * 1e6).cast("long")).alias("_wait")
    moments = schedule.groupBy(*session, "at_ms").agg(waits)
    due = running_sum(moments, session, "at_ms", "_wait", "_due").drop("_wait")
    joined = lookup_join(schedule, due, [*session, "at_ms"])
    return joined.select(*schedule.columns, (F.col("_due") / 1e6).alias("due_s"))


def replay_summary(schedule: DataFrame, session: Sequence[str]) -> DataFrame:
    """Events per session and kind, with the total paced waiting time.

    Waits are summed as whole microseconds, so the total does not depend on order.
    """
    return schedule.groupBy(*session, "kind").agg(
        F.count(F.lit(1)).alias("events"),
        F.count_if("missing_time").alias("missing_times"),
        F.max("at_ms").alias("last_ms"),
        (F.sum(F.round(F.col("gap_s") * 1e6).cast("long")) / 1e6).alias("wait_s"),
    )
