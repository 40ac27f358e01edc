"""Facts, slowly changing dimensions and marts over the live silver tables."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeloom.functions.aggregates import mean_seconds, squared, stddev_seconds
from changeloom.functions.clean import race_seq, seq_round, seq_season
from changeloom.operators.joins import lookup_join, point_in_time_join
from changeloom.operators.quality import Grain, NotNull, Rule
from changeloom.operators.scd2 import OPEN_END, one_row_per_seq, scd2_islands
from changeloom.operators.scope import affected_groups, replace_groups, scope_to
from changeloom.operators.winners import group_winner, pick_max
from changeloom.schemas import RACE

Tables = Mapping[str, DataFrame]

# Session codes, most telling session of a round first.
RACE_SESSION = "R"
QUALIFYING = "Q"
SESSION_PREFERENCE = ("R", "S", "Q", "SQ", "FP3", "FP2", "FP1")


def _stamped(df: DataFrame) -> DataFrame:
    return df.withColumn("_gold_loaded_at", F.current_timestamp())


def _n() -> Column:
    return F.count(F.lit(1))


def fact_driver_season_summary(t: Tables) -> DataFrame:
    """Per (season, driver) over all sessions: pace, consistency, tyre use.

    Aggregated per team first: the wide pass then has fixed-width buffers only
    and stays a hash aggregate, and the text maximum sees a handful of rows.
    """
    timed = t["laps"].where(F.col("lap_time_ms").isNotNull())
    per_team = timed.groupBy("season", "driver_code", "team").agg(
        _n().alias("_n"),
        F.min("lap_time_ms").alias("_min"),
        F.sum("lap_time_ms").alias("_sum"),
        F.sum(squared("lap_time_ms")).alias("_squares"),
        F.count_if("is_fastest_lap").alias("_best"),
        F.count_if(F.col("compound") == "SOFT").alias("_soft"),
        F.count_if(F.col("compound") == "MEDIUM").alias("_medium"),
        F.count_if(F.col("compound") == "HARD").alias("_hard"),
    )
    summed = per_team.groupBy("season", "driver_code").agg(
        F.max("team").alias("team"),
        F.sum("_n").alias("total_laps"),
        (F.min("_min").cast("double") / 1000.0).alias("fastest_lap_s"),
        mean_seconds(F.sum("_sum"), F.sum("_n")).alias("avg_lap_s"),
        stddev_seconds("_n", "_sum", "_squares").alias("lap_consistency_stddev"),
        F.sum("_best").alias("personal_bests"),
        F.sum("_soft").alias("soft_laps"),
        F.sum("_medium").alias("medium_laps"),
        F.sum("_hard").alias("hard_laps"),
    )
    return _stamped(summed)


def _race_pace(laps: DataFrame) -> DataFrame:
    """Race laps per (season, round, driver): count, best and mean times."""
    timed = laps.where(
        F.col("lap_time_ms").isNotNull() & (F.col("session_type") == RACE_SESSION)
    )
    sectors = ("sector1_ms", "sector2_ms", "sector3_ms")
    per_team = timed.groupBy(*RACE, "driver_code", "team").agg(
        _n().alias("_n"),
        F.min("lap_time_ms").alias("_min"),
        F.sum("lap_time_ms").alias("_sum"),
        *[F.sum(s).alias(f"_sum_{s}") for s in sectors],
        *[F.count(s).alias(f"_n_{s}") for s in sectors],
    )
    return per_team.groupBy(*RACE, "driver_code").agg(
        F.max("team").alias("team"),
        F.sum("_n").alias("race_laps"),
        (F.min("_min").cast("double") / 1000.0).alias("best_lap_s"),
        mean_seconds(F.sum("_sum"), F.sum("_n")).alias("avg_lap_s"),
        *[
            mean_seconds(F.sum(f"_sum_{s}"), F.sum(f"_n_{s}")).alias(f"avg_s{i}")
            for i, s in enumerate(sectors, 1)
        ],
    )


def fact_race_pace_comparison(t: Tables) -> DataFrame:
    """Race pace per (season, round, driver)."""
    return _stamped(_race_pace(t["laps"]))


def sector_dominance(t: Tables, nulls: str = "last") -> DataFrame:
    """Per race, the driver with the best mean time in each sector."""
    winners = group_winner(
        _race_pace(t["laps"]).withColumnRenamed("driver_code", "driver"),
        RACE,
        ["driver", "team"],
        {"avg_s1": "fastest_s1", "avg_s2": "fastest_s2", "avg_s3": "fastest_s3"},
        nulls=nulls,
    )
    return _stamped(winners)


def race_weekend_summary(t: Tables) -> DataFrame:
    """Per race: winner, pole, retirements, lap pace, weather, flag messages."""

    def race_rows(name: str) -> DataFrame:
        return t[name].where(F.col("session_type") == RACE_SESSION)

    won = F.col("position") == 1
    results = race_rows("results").groupBy(*RACE).agg(
        pick_max(won, "driver_code").alias("winner_code"),
        pick_max(won, "full_name").alias("winner_name"),
        pick_max(won, "team").alias("winner_team"),
        pick_max(F.col("grid_position") == 1, "driver_code").alias("pole_code"),
        _n().alias("drivers_classified"),
        F.count_if("is_dnf").alias("dnf_count"),
    )
    laps = race_rows("laps").where(F.col("lap_time_ms").isNotNull()).groupBy(*RACE).agg(
        _n().alias("total_race_laps"),
        (F.min("lap_time_ms").cast("double") / 1000.0).alias("fastest_lap_s"),
        mean_seconds(F.sum("lap_time_ms"), _n()).alias("avg_lap_s"),
    )
    weather = race_rows("weather").groupBy(*RACE).agg(
        F.round(F.avg("air_temp_c"), 1).alias("avg_air_temp_c"),
        F.round(F.avg("track_temp_c"), 1).alias("avg_track_temp_c"),
        F.round(F.max("humidity_pct"), 1).alias("max_humidity_pct"),
        F.max("rainfall").alias("_wet"),
    )
    control = race_rows("race_control").groupBy(*RACE).agg(
        F.count_if("is_safety_car").alias("_safety_car"),
        F.count_if("is_yellow_flag").alias("_yellow"),
        F.count_if(F.col("flag") == "RED").alias("_red"),
    )
    # Each side has one row per race, hashed alike by its aggregation.
    joined = (
        results.join(laps, list(RACE), "left")
        .join(weather, list(RACE), "left")
        .join(control, list(RACE), "left")
    )
    return _stamped(
        joined.select(
            *RACE,
            "winner_code", "winner_name", "winner_team", "pole_code",
            "drivers_classified", "dnf_count",
            "total_race_laps", "fastest_lap_s", "avg_lap_s",
            "avg_air_temp_c", "avg_track_temp_c", "max_humidity_pct",
            F.coalesce("_wet", F.lit(False)).alias("was_wet_race"),
            F.coalesce("_safety_car", F.lit(0).cast("long")).alias("safety_car_msgs"),
            F.coalesce("_yellow", F.lit(0).cast("long")).alias("yellow_flag_msgs"),
            F.coalesce("_red", F.lit(0).cast("long")).alias("red_flag_msgs"),
        )
    )


def _dimension(results: DataFrame, key: str, attrs: list[str]) -> DataFrame:
    position = F.array_position(
        F.array(*[F.lit(s) for s in SESSION_PREFERENCE]), F.col("session_type")
    )
    # Listed sessions rank by position, any other below them.
    telling = F.when(position > 0, -position).otherwise(-len(SESSION_PREFERENCE) - 1)
    observed = one_row_per_seq(
        results.select(
            key,
            *attrs,
            race_seq().alias("race_seq"),
            telling.alias("_telling"),
            "event_id",
        ),
        key,
        "race_seq",
        attrs,
        ["_telling", "event_id"],
    )
    versions = scd2_islands(observed, key, "race_seq", attrs, open_end=OPEN_END)
    return _stamped(
        versions.select(
            key,
            *attrs,
            seq_season("_valid_from_seq").alias("valid_from_season"),
            seq_round("_valid_from_seq").alias("valid_from_round"),
            seq_season("_valid_to_seq_observed").alias("valid_to_season"),
            seq_round("_valid_to_seq_observed").alias("valid_to_round"),
            "is_current",
            "_valid_from_seq",
            "_valid_to_seq_excl",
        )
    )


def dim_driver_scd2(t: Tables) -> DataFrame:
    """Versions of (name, team, colour) per driver."""
    return _dimension(t["results"], "driver_code", ["full_name", "team", "team_color"])


def dim_team_scd2(t: Tables) -> DataFrame:
    """Versions of the colour per team."""
    return _dimension(t["results"], "team", ["team_color"])


def mart_driver_race_result(t: Tables) -> DataFrame:
    """One row per race result with its laps, qualifying, dimensions and facts."""
    driver_race = [*RACE, "driver_code"]
    races = t["results"].where(F.col("session_type") == RACE_SESSION).select(
        *driver_race,
        race_seq().alias("race_seq"),
        "team", "grid_position", "position", "classified_position", "points",
        "is_dnf", "race_time_s",
    )
    laps = t["laps"].where(F.col("session_type") == RACE_SESSION).groupBy(*driver_race).agg(
        (F.min("lap_time_ms").cast("double") / 1000.0).alias("fastest_lap_s"),
        F.count_if(F.col("pit_in_time_ms").isNotNull()).alias("pit_stops"),
    )
    quali = t["results"].where(F.col("session_type") == QUALIFYING).select(
        *driver_race, "q1_s", "q2_s", "q3_s"
    )
    drivers = t["dim_driver_scd2"].select(
        "driver_code",
        F.col("full_name").alias("driver_full_name"),
        F.col("_valid_from_seq").alias("_driver_from"),
        F.col("_valid_to_seq_excl").alias("_driver_to"),
    )
    teams = t["dim_team_scd2"].select(
        "team",
        "team_color",
        F.col("_valid_from_seq").alias("_team_from"),
        F.col("_valid_to_seq_excl").alias("_team_to"),
    )
    pace = t["fact_race_pace_comparison"].select(
        *driver_race,
        F.col("best_lap_s").alias("race_best_lap_s"),
        F.col("avg_lap_s").alias("race_avg_lap_s"),
        F.col("avg_s1").alias("race_avg_s1"),
        F.col("avg_s2").alias("race_avg_s2"),
        F.col("avg_s3").alias("race_avg_s3"),
    )
    season = t["fact_driver_season_summary"].select(
        "season",
        "driver_code",
        F.col("avg_lap_s").alias("season_avg_lap_s"),
        F.col("lap_consistency_stddev").alias("season_lap_consistency_stddev"),
        F.col("personal_bests").alias("season_personal_bests"),
    )
    # The lookups by validity come first: they read the races alone.
    out = point_in_time_join(
        races, drivers, ["driver_code"], "race_seq", "_driver_from", "_driver_to"
    )
    out = point_in_time_join(
        out, teams, ["team"], "race_seq", "_team_from", "_team_to", keys_from=races
    )
    # One shuffle of the races serves these three joins on the same key.
    for side in (laps, quali, pace):
        out = out.join(side, driver_race, "left")
    out = lookup_join(out, season, ["season", "driver_code"], keys_from=races)
    return _stamped(
        out.select(
            *driver_race,
            "driver_full_name", "team", "team_color",
            "grid_position", "position", "classified_position", "points", "is_dnf",
            "race_time_s", "fastest_lap_s", "pit_stops", "q1_s", "q2_s", "q3_s",
            "race_best_lap_s", "race_avg_lap_s", "race_avg_s1", "race_avg_s2", "race_avg_s3",
            "season_avg_lap_s", "season_lap_consistency_stddev", "season_personal_bests",
        )
    )


@dataclass(frozen=True)
class GoldModel:
    """A model, its inputs, and the groups a change to an input touches."""

    name: str
    build: object
    inputs: tuple[str, ...]
    group: tuple[str, ...]
    # Inputs whose changed rows decide the affected groups; empty: rebuilt whole.
    watched: tuple[str, ...]
    partitions: tuple[str, ...] = ()
    rules: tuple[Rule, ...] = ()


MODELS = {
    m.name: m
    for m in (
        GoldModel(
            "fact_driver_season_summary",
            fact_driver_season_summary,
            ("laps",),
            ("season",),
            ("laps",),
            ("season",),
            (NotNull("driver_code"), NotNull("fastest_lap_s")),
        ),
        GoldModel(
            "fact_race_pace_comparison",
            fact_race_pace_comparison,
            ("laps",),
            RACE,
            ("laps",),
            RACE,
            (NotNull("driver_code"), NotNull("round")),
        ),
        GoldModel(
            "sector_dominance",
            sector_dominance,
            ("laps",),
            RACE,
            ("laps",),
            RACE,
            (NotNull("round"), Grain(RACE)),
        ),
        GoldModel(
            "race_weekend_summary",
            race_weekend_summary,
            ("results", "laps", "weather", "race_control"),
            RACE,
            ("results", "laps", "weather", "race_control"),
            RACE,
            (NotNull("round"), Grain(RACE)),
        ),
        GoldModel(
            "dim_driver_scd2",
            dim_driver_scd2,
            ("results",),
            ("driver_code",),
            (),
            (),
            (
                NotNull("driver_code"),
                NotNull("is_current"),
                Grain(("driver_code", "valid_from_season", "valid_from_round")),
            ),
        ),
        GoldModel(
            "dim_team_scd2",
            dim_team_scd2,
            ("results",),
            ("team",),
            (),
            (),
            (
                NotNull("team"),
                NotNull("is_current"),
                Grain(("team", "valid_from_season", "valid_from_round")),
            ),
        ),
        # The season columns make a whole season depend on any of its laps.
        GoldModel(
            "mart_driver_race_result",
            mart_driver_race_result,
            (
                "results",
                "laps",
                "dim_driver_scd2",
                "dim_team_scd2",
                "fact_driver_season_summary",
                "fact_race_pace_comparison",
            ),
            ("season",),
            ("results", "laps"),
            RACE,
            (
                NotNull("driver_code"),
                NotNull("round"),
                Grain((*RACE, "driver_code")),
            ),
        ),
    )
}


def affected_by(model: GoldModel, changes: Tables) -> DataFrame | None:
    """Groups of a model that the changed rows touch; None where nothing it watches changed."""
    watched = [changes[name] for name in model.watched if name in changes]
    return affected_groups(watched, model.group) if watched else None


def rebuilt(model: GoldModel, affected: DataFrame, t: Tables, stored: bool = True) -> DataFrame:
    """The affected groups anew, from inputs cut to them; `stored` inputs lie in folders of their sessions."""
    scoped = {
        name: scope_to(df, affected, model.group, stored=stored)
        if set(model.group) <= set(df.columns)
        else df
        for name, df in t.items()
        if name in model.inputs
    }
    return model.build(scoped)


def refresh(
    model: GoldModel, old: DataFrame | None, changes: Tables, t: Tables, stored: bool = True
) -> DataFrame:
    """New content of a model after `changes` (changed rows per silver table).

    Every input is cut to the affected groups before it is read, and whole groups
    are replaced, so the result equals a full rebuild. `stored` inputs lie in folders of their sessions.
    """
    if old is None or not model.watched:
        return model.build(t)
    affected = affected_by(model, changes)
    if affected is None:
        return old
    return replace_groups(old, affected, rebuilt(model, affected, t, stored), model.group, stored=stored)
