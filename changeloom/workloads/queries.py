"""Registered queries: every operator and model over the test tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace
from functools import reduce, wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from changeloom.functions.clean import clamp, race_seq, seq_round, seq_season
from changeloom.operators import cdc, joins, quality, replay, scope, winners
from changeloom.operators.ordered import neighbours
from changeloom.operators.scan import asof_join
from changeloom.operators.scd2 import OPEN_END, one_row_per_seq, scd2_islands
from changeloom.plans import gold, panel, silver
from changeloom.plans.merge import keys_move, merge_changes, read_live
from changeloom.plans.refresh import refresh_all
from changeloom.schemas import DATASETS, RACE, SESSION, SOURCE_TABLES, change_schema, source_schema
from changeloom.session import shared_dir, with_defaults
from changeloom.sources.landing import enter_files, file_format, pinned_schema, with_hour_folders, write_landing
from changeloom.sources.rotation import file_numbers
from changeloom.sources.normalize import RAW_COLUMNS, for_driver, normalize
from changeloom.sources.tables import Tables, balanced, create_namespaces
from changeloom.streaming import bronze as bronze_stream
from changeloom.streaming.lakehouse import run_once
from changeloom.streaming.silver import merge_stream
from changeloom.functions import convert
from changeloom.workloads.views import CHANGES, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

STAMPS = ("_silver_loaded_at", "_gold_loaded_at", "_bronze_loaded_at")
# Bytes limit that rules out every broadcast, to run the shuffled form of a join.
NO_BROADCAST = -1
# Records after which the landing files of `landing_rotation` are closed.
ROTATED_RECORDS = 1000


def query(fn: Query) -> Query:
    """Register a query under its function name; load stamps are not compared."""

    @wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(with_defaults(spark), sf_dir).drop(*STAMPS)

    QUERIES[fn.__name__] = run
    return run


def changes(spark, sf_dir, name) -> DataFrame:
    return CHANGES[name](spark, sf_dir)


def silver_table(spark, sf_dir, name) -> DataFrame:
    return silver.build(name, changes(spark, sf_dir, name))


LAP_COLUMNS = (
    "event_id", *SESSION, "driver_code", "team", "lap_time_ms",
    "sector1_ms", "sector2_ms", "sector3_ms", "compound", "pit_in_time_ms",
)
# Gold models that read the fastest-lap flag.
READ_FASTEST = {"fact_driver_season_summary", "mart_driver_race_result"}
# Gold models that read the results for races, qualifying and both dimensions.
READ_RESULTS_OFTEN = {"mart_driver_race_result"}
DIMENSIONS = ("dim_driver_scd2", "dim_team_scd2")


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows of `df`, computed once into the shared folder."""
    folder = shared_dir(df.sparkSession, name)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


class Lazy(dict):
    """Silver and gold tables of the test data by name, built on first use.

    `cut` chooses the change rows of a dataset that take part, by default all.
    """

    def __init__(self, spark, sf_dir, model: str, cut: Callable[[str, DataFrame], DataFrame] = lambda name, log: log):
        super().__init__()
        self._source = (spark, sf_dir)
        self._cut = cut
        self._fastest = model in READ_FASTEST
        self._stores = model in READ_RESULTS_OFTEN

    def __missing__(self, name: str) -> DataFrame:
        if name in gold.MODELS:
            self[name] = gold.MODELS[name].build(self)
        else:
            log = self._cut(name, changes(*self._source, name))
            self[name] = self.laps(log) if name == "laps" else silver.build(name, log)
        # The mart reads the results and both dimensions several times.
        if self._stores and name in ("results", *DIMENSIONS):
            self[name] = stored(self[name], name)
        return self[name]

    def laps(self, log: DataFrame) -> DataFrame:
        """Laps with their flag, from a state written once; or without it."""
        if self._fastest:
            self._lap_folder = shared_dir(log.sparkSession, "laps")
            return silver.build("laps", log, self._lap_folder, LAP_COLUMNS)
        return silver.live(silver.state(silver.MODELS["laps"], log))

    def lap_state(self) -> DataFrame:
        """The stored state behind the flagged laps."""
        self["laps"]
        return self._source[0].read.parquet(f"{self._lap_folder}/state")


class After(Lazy):
    """Tables with the recent changes, on top of those without them in `before`."""

    def __init__(self, spark, sf_dir, model: str, before: Lazy, cut: Callable[[str, DataFrame], DataFrame]):
        super().__init__(spark, sf_dir, model, cut)
        self._before = before

    def laps(self, log: DataFrame) -> DataFrame:
        """The stored state goes on; only sessions that the recent changes name are collapsed anew."""
        if not self._fastest:
            return super().laps(log)
        spark, model = log.sparkSession, silver.MODELS["laps"]
        # Whatever the state before did not take, a change without a season included.
        late = log.where(F.coalesce(_is_recent(), F.lit(True)))
        named = stored(scope.affected_groups([late], SESSION), "named-laps")
        again = silver.state(model, scope.scope_to(log, named, SESSION, stored=False))
        earlier = self._before.lap_state()
        again = stored(again.select(*earlier.columns), "again-laps")
        kept = scope.replace_groups(earlier, named, again, SESSION, stored=False)
        return silver.live(silver.complete(model, kept, shared_dir(spark, "derived")))


def build_gold(spark, sf_dir, name: str) -> DataFrame:
    return gold.MODELS[name].build(Lazy(spark, sf_dir, name))


def event_table(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "events")


# ---- silver models -------------------------------------------------------


@query
def silver_telemetry(spark, sf_dir):
    return silver_table(spark, sf_dir, "telemetry")


@query
def silver_laps(spark, sf_dir):
    return silver.build("laps", changes(spark, sf_dir, "laps"), shared_dir(spark, "laps"))


@query
def silver_weather(spark, sf_dir):
    return silver_table(spark, sf_dir, "weather")


@query
def silver_race_control(spark, sf_dir):
    df = silver_table(spark, sf_dir, "race_control")
    return df.withColumn("msg_time", F.unix_micros("msg_time"))


@query
def silver_track_status(spark, sf_dir):
    return silver_table(spark, sf_dir, "track_status")


@query
def silver_session_status(spark, sf_dir):
    return silver_table(spark, sf_dir, "session_status")


@query
def silver_results(spark, sf_dir):
    return silver_table(spark, sf_dir, "results")


# ---- gold models ---------------------------------------------------------


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 9) for c in columns})


@query
def gold_driver_season_summary(spark, sf_dir):
    df = build_gold(spark, sf_dir, "fact_driver_season_summary")
    return rounded(df, "lap_consistency_stddev")


@query
def gold_race_pace_comparison(spark, sf_dir):
    return build_gold(spark, sf_dir, "fact_race_pace_comparison")


@query
def gold_sector_dominance(spark, sf_dir):
    return build_gold(spark, sf_dir, "sector_dominance")


@query
def gold_sector_dominance_nulls_first(spark, sf_dir):
    return gold.sector_dominance(Lazy(spark, sf_dir, "sector_dominance"), nulls="first")


@query
def gold_race_weekend_summary(spark, sf_dir):
    return build_gold(spark, sf_dir, "race_weekend_summary")


@query
def gold_dim_driver_scd2(spark, sf_dir):
    return build_gold(spark, sf_dir, "dim_driver_scd2")


@query
def gold_dim_team_scd2(spark, sf_dir):
    return build_gold(spark, sf_dir, "dim_team_scd2")


@query
def gold_mart_driver_race_result(spark, sf_dir):
    df = build_gold(spark, sf_dir, "mart_driver_race_result")
    return rounded(df, "season_lap_consistency_stddev")


# ---- change-log operators ------------------------------------------------

ROW = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("cents", T.LongType()),
    ]
)


def envelopes(spark, sf_dir) -> DataFrame:
    """Nested change envelopes of `events`; every seventh is an empty payload."""
    image = (
        "struct(event_id, user_id, event_type, CAST(round(value * 100) AS BIGINT) AS cents)"
    )
    return event_table(spark, sf_dir).selectExpr(
        f"CASE WHEN event_id % 7 > 0 AND event_type IN ('purchase', 'error') THEN {image} END "
        "AS before",
        f"CASE WHEN event_id % 7 > 0 AND event_type <> 'error' THEN {image} END AS after",
        "CASE event_type WHEN 'signup' THEN 'c' WHEN 'purchase' THEN 'u' WHEN 'error' THEN 'd' "
        "ELSE 'r' END AS op",
        "unix_micros(CAST(ts AS TIMESTAMP)) DIV 1000 AS ts_ms",
        "named_struct('lsn', event_id, 'snapshot', 'false', 'table', 'events', "
        "'schema', 'public') AS source",
    )


@query
def cdc_unwrap_envelope(spark, sf_dir):
    return cdc.unwrap_envelope(envelopes(spark, sf_dir))


@query
def cdc_unwrap_json(spark, sf_dir):
    wire = envelopes(spark, sf_dir).select(
        F.to_json(F.struct("before", "after", "op", "ts_ms", "source")).alias("value")
    )
    return cdc.unwrap_json(wire, "value", ROW)


@query
def cdc_unwrap_props(spark, sf_dir):
    kind = T.StructType([T.StructField("k", T.LongType())])
    return event_table(spark, sf_dir).select(
        "event_id", F.from_json("props", kind)["k"].alias("k")
    )


@query
def cdc_latest_by_natural_key(spark, sf_dir):
    keys = [*SESSION, "driver_number", "lap_number"]
    newest = cdc.latest_by_key(
        changes(spark, sf_dir, "laps"), keys, tiebreak=["event_id"]
    )
    return newest.select(*keys, "event_id", "__source_lsn", "__ts_ms", "__op")


@query
def cdc_latest_by_event(spark, sf_dir):
    return cdc.latest_by_key(changes(spark, sf_dir, "track_status"), ["event_id"])


@query
def cdc_tombstones(spark, sf_dir):
    log = changes(spark, sf_dir, "telemetry")
    return log.select("event_id", cdc.is_tombstone().alias("is_deleted"))


def _user_log(spark, sf_dir) -> DataFrame:
    return event_table(spark, sf_dir).selectExpr(
        "user_id",
        "event_id",
        "event_type",
        "CAST(round(value * 100) AS BIGINT) AS cents",
        "CASE event_type WHEN 'signup' THEN 'c' WHEN 'purchase' THEN 'u' "
        "WHEN 'error' THEN 'd' ELSE 'r' END AS __op",
        "unix_micros(CAST(ts AS TIMESTAMP)) DIV 1000 AS __ts_ms",
        "event_id AS __source_lsn",
        "ts",
    )


@query
def cdc_apply_batches(spark, sf_dir):
    """Two batches, the second with many older changes, then the live rows."""
    log = _user_log(spark, sf_dir).drop("ts")
    empty = log.where("false")
    state = cdc.apply_changes(empty, log.where("__source_lsn % 3 = 0"), ["user_id"])
    state = cdc.apply_changes(state, log.where("__source_lsn % 3 <> 0"), ["user_id"])
    flagged = state.withColumn("_is_deleted", cdc.is_tombstone())
    return cdc.live_rows(flagged).select("user_id", "event_id", "event_type", "cents")


@query
def cdc_snapshot_diff(spark, sf_dir):
    """Changes between the state per user and hour at mid-month and at the end."""
    keys = ["user_id", "hour"]

    def snapshot(log):
        newest = cdc.latest_by_key(log, keys)
        return newest.where(~cdc.is_tombstone()).select(*keys, "event_type", "cents")

    log = _user_log(spark, sf_dir).withColumn("hour", F.hour("ts"))
    before = snapshot(log.where("ts < TIMESTAMP_NTZ '2024-01-16 00:00:00'"))
    return cdc.snapshot_diff(before, snapshot(log), keys)


@query
def cdc_new_since_mark(spark, sf_dir):
    """Rows stamped after the newest row of a target loaded up to the 10th."""
    log = event_table(spark, sf_dir).withColumn("loaded", F.col("ts").cast("timestamp"))
    target = log.where("loaded < TIMESTAMP '2024-01-10 00:00:00'")
    return cdc.newer_than(log, "loaded", target, "loaded").select("event_id", "user_id")


@query
def cdc_global_mark(spark, sf_dir):
    log = event_table(spark, sf_dir).withColumn("loaded", F.col("ts").cast("timestamp"))
    marked = log.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
    nothing = log.where("event_id < 0")
    return marked.select(
        "event_type",
        "n",
        F.unix_micros(cdc.high_water_mark(log, "loaded")).alias("mark"),
        F.unix_micros(cdc.high_water_mark(nothing, "loaded")).alias("empty_mark"),
    )


@query
def audit_current_jobs(spark, sf_dir):
    newest = panel.current_jobs(changes(spark, sf_dir, "ingestion_jobs"))
    live = newest.where(~cdc.is_tombstone())
    return live.select(
        "id", "season", "gp", "session_type", "driver", "mode", "status", "error_message",
        F.unix_micros("created_at").alias("created_us"),
        F.unix_micros("finished_at").alias("finished_us"),
    )


@query
def audit_job_status(spark, sf_dir):
    requests = event_table(spark, sf_dir).selectExpr(
        "event_id DIV 3 AS id",
        "event_id AS seq",
        "CASE event_type WHEN 'purchase' THEN 'done' WHEN 'error' THEN 'failed' "
        "WHEN 'view' THEN 'cancelled' WHEN 'click' THEN 'unknown' ELSE 'running' END AS status",
    )
    return panel.job_status(requests)


# ---- change scoping and refresh ------------------------------------------


def _is_recent() -> Column:
    """Updates and deletes of two races, which arrive after everything else."""
    late_race = (F.col("season") == 2000) & F.col("round").isin(3, 9)
    return late_race & F.coalesce("__op", F.lit("r")).isin("u", "d")


def _recent(spark, sf_dir, name) -> DataFrame:
    return changes(spark, sf_dir, name).where(_is_recent())


@query
def scope_season(spark, sf_dir):
    affected = scope.affected_groups([_recent(spark, sf_dir, "laps")], ["season"])
    scoped = scope.scope_to(changes(spark, sf_dir, "laps"), affected, ["season"], stored=False)
    return scoped.select("event_id", "season", "lap_time_ms")


@query
def scope_race(spark, sf_dir):
    affected = scope.affected_groups([_recent(spark, sf_dir, "laps")], RACE)
    scoped = scope.scope_to(changes(spark, sf_dir, "laps"), affected, RACE, NO_BROADCAST, stored=False)
    return scoped.select("event_id", *RACE, "lap_time_ms")


@query
def scope_pruned(spark, sf_dir):
    """Scoping of a stored table by a broadcast list: other partitions are not read."""
    folder = shared_dir(spark, "laps")
    balanced(changes(spark, sf_dir, "laps"), RACE).write.partitionBy(*RACE).parquet(folder)
    affected = scope.affected_groups([_recent(spark, sf_dir, "laps")], RACE)
    scoped = scope.scope_to(spark.read.parquet(folder), affected, RACE)
    return scoped.select("event_id", *[F.col(c).cast("int").alias(c) for c in RACE], "lap_time_ms")


@query
def scope_many_sources(spark, sf_dir):
    names = ("results", "laps", "weather", "race_control")
    affected = scope.affected_groups([_recent(spark, sf_dir, n) for n in names], RACE)
    scoped = scope.scope_to(changes(spark, sf_dir, "results"), affected, RACE, stored=False)
    return scoped.select("event_id", *RACE, "driver_code")


def _touched(spark, sf_dir, name: str) -> DataFrame:
    """Sessions of the recent changes of a dataset and of the older copies they replace, written once.

    Stored, their list has its true size, so that what is cut to it need not be shuffled whole.
    """
    model, log = silver.MODELS[name], changes(spark, sf_dir, name)
    recent = log.where(_is_recent())
    changed = [recent]
    if keys_move(model):
        keys = stored(recent.select(*model.keys).distinct(), f"recent-{name}")
        # Only the changed keys are collapsed: the newest earlier row of a key is the same among its own rows.
        older = joins.lookup_join(log.where(~_is_recent()), keys, model.keys, "left_semi")
        changed.append(silver.state(model, older))
    return stored(scope.affected_groups(changed, SESSION), f"touched-{name}")


def _refreshed(spark, sf_dir, name) -> DataFrame:
    """Build without the recent changes, then refresh only what they touch.

    The changed groups also hold those of older copies the changes replace.
    """
    model = gold.MODELS[name]
    touched = {n: _touched(spark, sf_dir, n) for n in model.watched}
    affected = gold.affected_by(model, touched)

    def needed(n: str, log: DataFrame) -> DataFrame:
        # A lap keeps its session, so whole groups can be cut out before they are collapsed.
        return scope.scope_to(log, affected, model.group, stored=False) if n == "laps" else log

    before = Lazy(spark, sf_dir, name, lambda n, log: log.where(~_is_recent()))
    now = After(spark, sf_dir, name, before, needed if name not in READ_FASTEST else lambda n, log: log)
    return gold.refresh(model, model.build(before), touched, {n: now[n] for n in model.inputs}, stored=False)


@query
def refresh_driver_season_summary(spark, sf_dir):
    df = _refreshed(spark, sf_dir, "fact_driver_season_summary")
    return rounded(df, "lap_consistency_stddev")


@query
def refresh_race_pace_comparison(spark, sf_dir):
    return _refreshed(spark, sf_dir, "fact_race_pace_comparison")


@query
def refresh_sector_dominance(spark, sf_dir):
    return _refreshed(spark, sf_dir, "sector_dominance")


@query
def refresh_race_weekend_summary(spark, sf_dir):
    return _refreshed(spark, sf_dir, "race_weekend_summary")


@query
def refresh_driver_race_mart(spark, sf_dir):
    df = _refreshed(spark, sf_dir, "mart_driver_race_result")
    return rounded(df, "season_lap_consistency_stddev")


@query
def merge_stored_results(spark, sf_dir):
    """Stored state, merged in three batches that arrive newest first."""
    path = shared_dir(spark, "state")
    log = changes(spark, sf_dir, "results")
    for part in (2, 1, 0):
        batch = log.where(F.pmod(F.col("__source_lsn"), F.lit(3)) == part)
        merge_changes(spark, silver.MODELS["results"], batch, path, gate=False)
    return read_live(spark, path, silver.MODELS["results"])


def _merged_late(spark, sf_dir, percent: int) -> DataFrame:
    """Results merged without the changes of `percent` of the keys, which come in a second batch."""
    path = shared_dir(spark, "state")
    log = changes(spark, sf_dir, "results")
    late = F.pmod(F.xxhash64("event_id"), F.lit(100)) < percent
    for part in (~late, late):
        merge_changes(spark, silver.MODELS["results"], log.where(part), path, gate=False)
    return read_live(spark, path, silver.MODELS["results"])


@query
def merge_results_1_percent(spark, sf_dir):
    return _merged_late(spark, sf_dir, 1)


@query
def merge_results_half(spark, sf_dir):
    return _merged_late(spark, sf_dir, 50)


@query
def merge_stored_laps(spark, sf_dir):
    path = shared_dir(spark, "state")
    log = changes(spark, sf_dir, "laps")
    for part in (1, 0):
        batch = log.where(F.pmod(F.col("event_id"), F.lit(2)) == part)
        merge_changes(spark, silver.MODELS["laps"], batch, path)
    return read_live(spark, path, silver.MODELS["laps"])


@query
def merge_null_sessions(spark, sf_dir):
    """Stored state merged in three batches; every fifth event has no round."""
    path = shared_dir(spark, "state")
    known = F.when(F.col("event_id") % 5 != 0, F.col("round"))
    log = changes(spark, sf_dir, "results").withColumn("round", known)
    for part in (2, 1, 0):
        batch = log.where(F.pmod(F.col("__source_lsn"), F.lit(3)) == part)
        merge_changes(spark, silver.MODELS["results"], batch, path, gate=False)
    return read_live(spark, path, silver.MODELS["results"])


def _with_own_ids(log: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Change rows in which no two keys share an event id; the order of ids stays.

    The keys of a shared id are numbered, so every id is multiplied by no more than the most keys that share one.
    """
    counted = log.where(F.col("event_id").isNotNull()).groupBy("event_id").agg(F.count(F.lit(1)).alias("_n"))
    shared = stored(counted.where("_n > 1").select("event_id"), "shared-ids")
    # Compared as a struct, in which nulls are equal.
    keyed = log.withColumn("_key", F.struct(*keys))
    holders = joins.lookup_join(keyed.select("event_id", "_key"), shared, ["event_id"], "left_semi").distinct()
    nth = F.row_number().over(Window.partitionBy("event_id").orderBy("_key")) - 1
    numbered = stored(holders.withColumn("_nth", nth), "shared-keys")
    most = numbered.agg(F.coalesce(F.max("_nth") + 1, F.lit(1)).cast("long")).scalar()
    numbers = joins.lookup_join(keyed, numbered, ["event_id", "_key"])
    return numbers.withColumn("event_id", F.col("event_id") * most + F.coalesce("_nth", F.lit(0))).select(*log.columns)


@query
def merge_duplicate_elsewhere(spark, sf_dir):
    """A batch that repeats event ids of sessions it does not touch is refused; the state before it stays."""
    path = shared_dir(spark, "state")
    model = replace(silver.MODELS["laps"], rules=(*silver.MODELS["laps"].rules, quality.Unique("event_id")))
    log = _with_own_ids(changes(spark, sf_dir, "laps"), model.keys)
    merge_changes(spark, model, log, path)
    # The same laps in rounds that no season has, under the ids they have already.
    again = log.withColumn("round", F.col("round") + 100)
    try:
        merge_changes(spark, model, again, path)
    except quality.ExpectationFailed:
        kept = read_live(spark, path, model)
        return kept.groupBy(*SESSION).agg(F.count(F.lit(1)).alias("laps"), F.sum("lap_time_ms").alias("total_ms"))
    raise RuntimeError("a state with repeated event ids was merged")


def _refreshed_twice(spark, sf_dir) -> dict[str, DataFrame]:
    """All tables from stored changes in two rounds."""
    root = shared_dir(spark, "lakehouse")
    names = [n for n in DATASETS if n != "ingestion_jobs"]
    for late in (False, True):
        batch = {}
        for n in names:
            recent = _is_recent() if late else ~_is_recent()
            batch[n] = changes(spark, sf_dir, n).where(recent)
        # The derived results hold duplicate drivers per race: no grain gate here.
        tables = refresh_all(spark, root, batch, gate=False)
    return tables


@query
def refresh_all_models(spark, sf_dir):
    """All models from stored changes in two rounds; rows per table."""
    return bronze_stream.table_counts(_refreshed_twice(spark, sf_dir))


@query
def refresh_all_mart(spark, sf_dir):
    """The mart after both rounds, by content."""
    mart = _refreshed_twice(spark, sf_dir)["mart_driver_race_result"]
    return rounded(mart, "season_lap_consistency_stddev")


def _with_own_drivers(spark, sf_dir) -> DataFrame:
    """Results in which no driver has two in one race, as the mart's grain wants it."""
    log = changes(spark, sf_dir, "results")
    return log.withColumn("driver_code", F.concat_ws("-", "driver_code", "event_id"))


@query
def refresh_gated(spark, sf_dir):
    """Both rounds with every expectation tested, on inputs that meet them; the mart by content."""
    root = shared_dir(spark, "lakehouse")
    for late in (False, True):
        part = _is_recent() if late else ~_is_recent()
        batch = {"results": _with_own_drivers(spark, sf_dir).where(part), "laps": _timed_laps(spark, sf_dir).where(part)}
        tables = refresh_all(spark, root, batch)
    return rounded(tables["mart_driver_race_result"], "season_lap_consistency_stddev")


def _timed_laps(spark, sf_dir) -> DataFrame:
    """Laps with a time in the accepted range, so that every driver of a season has a fastest one."""
    return changes(spark, sf_dir, "laps").withColumn("lap_time_ms", 60_000 + F.pmod("event_id", F.lit(90_000)))


@query
def refresh_gate_stops(spark, sf_dir):
    """Results with two rows of a driver in a race: every table but the mart is published."""
    root = shared_dir(spark, "lakehouse")
    batch = {"results": changes(spark, sf_dir, "results"), "laps": _timed_laps(spark, sf_dir)}
    try:
        refresh_all(spark, root, batch)
    except quality.ExpectationFailed as stopped:
        store = Tables(spark, f"{root}/gold")
        rows = [(name, store.exists(name), str(stopped).startswith(f"{name}: ")) for name in gold.MODELS]
        return spark.createDataFrame(rows, "tabela string, published boolean, failed boolean")
    raise RuntimeError("a mart with a broken grain was published")


@query
def refresh_late_datasets(spark, sf_dir):
    """Laps arrive only after a first refresh that had none."""
    root = shared_dir(spark, "lakehouse")
    for names in (("results", "weather", "race_control"), ("laps",)):
        tables = refresh_all(spark, root, {n: changes(spark, sf_dir, n) for n in names}, gate=False)
    return tables["race_weekend_summary"]


@query
def pipeline_two_drains(spark, sf_dir):
    """Landing to gold in two runs; the second lands updates and deletes."""
    landing, root = shared_dir(spark, "landing"), shared_dir(spark, "lakehouse")
    for late in (False, True):
        for topic, spec in bronze_stream.topic_specs().items():
            if spec.table in ("results", "laps", "weather", "race_control"):
                rows = _as_change_rows(changes(spark, sf_dir, spec.table), spec.table)
                rows = rows.where(_is_recent() if late else ~_is_recent())
                rows.write.mode("append").format(file_format(spark, "avro")).save(f"{landing}/{topic}")
        tables = run_once(spark, landing, root, gate=False)
    return tables["race_weekend_summary"]


# ---- joins ---------------------------------------------------------------


@query
def join_lookup_spread(spark, sf_dir):
    """Left join without any broadcast: hot users are salted."""
    events = event_table(spark, sf_dir).select("event_id", "user_id", "event_type")
    per_user = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("user_id")).agg(
        F.count(F.lit(1)).alias("orders")
    )
    return joins.lookup_join(events, per_user, ["user_id"], limit=NO_BROADCAST)


@query
def join_aggregate_using(spark, sf_dir):
    laps = changes(spark, sf_dir, "laps")
    races = laps.groupBy(*RACE).agg(F.count(F.lit(1)).alias("laps"))
    finishes = changes(spark, sf_dir, "results").groupBy(*RACE).agg(
        F.count(F.lit(1)).alias("results")
    )
    return races.join(finishes, list(RACE), "left").select(
        *RACE, "laps", F.coalesce("results", F.lit(0).cast("long")).alias("results")
    )


@query
def join_season_onto_race(spark, sf_dir):
    """A season-level fact onto race-level rows."""
    results = changes(spark, sf_dir, "results").select("event_id", "season", "driver_code")
    season = changes(spark, sf_dir, "laps").groupBy("season", "driver_code").agg(
        F.count(F.lit(1)).alias("season_laps")
    )
    return joins.lookup_join(results, season, ["season", "driver_code"])


def _versions(spark, sf_dir) -> DataFrame:
    """Versions of each customer's order priority by day."""
    orders = _orders_by_day(spark, sf_dir)
    daily = one_row_per_seq(orders, "o_custkey", "day", ["o_orderpriority"], ["o_orderkey"])
    return scd2_islands(daily, "o_custkey", "day", ["o_orderpriority"], open_end=OPEN_END)


def _orders_by_day(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(
        "o_custkey",
        "o_orderkey",
        "o_orderpriority",
        "datediff(CAST(o_orderdate AS DATE), DATE '1990-01-01') AS day",
    )


@query
def scd2_versions(spark, sf_dir):
    return _versions(spark, sf_dir)


@query
def scd2_versions_sliced(spark, sf_dir):
    """The same versions with windows per slice of the sequence."""
    daily = one_row_per_seq(
        _orders_by_day(spark, sf_dir), "o_custkey", "day", ["o_orderpriority"], ["o_orderkey"]
    )
    return scd2_islands(daily, "o_custkey", "day", ["o_orderpriority"], open_end=OPEN_END, chunk=256)


@query
def point_in_time_lookup(spark, sf_dir):
    """The priority each customer had on the day of every event of that user."""
    return _point_in_time(spark, sf_dir, joins.BROADCAST_BYTES)


@query
def point_in_time_lookup_spread(spark, sf_dir):
    return _point_in_time(spark, sf_dir, NO_BROADCAST)


def _point_in_time(spark, sf_dir, limit) -> DataFrame:
    facts = event_table(spark, sf_dir).selectExpr(
        "event_id", "user_id AS o_custkey", "CAST(2000 + event_id % 2400 AS INT) AS day"
    )
    found = joins.point_in_time_join(
        facts,
        _versions(spark, sf_dir),
        ["o_custkey"],
        "day",
        "_valid_from_seq",
        "_valid_to_seq_excl",
        chunk=512,
        limit=limit,
    )
    return found.select("event_id", "o_custkey", "day", "o_orderpriority", "_valid_from_seq")


# Moves day numbers beyond the open end of the models.
WIDE_SHIFT = 2_000_000


DAY_MS = 86_400_000


@query
def asof_lookup_millis(spark, sf_dir):
    """The same lookup by milliseconds over years: no version is copied to a slice of the sequence."""
    versions = _versions(spark, sf_dir).select(
        "o_custkey",
        "o_orderpriority",
        (F.col("_valid_from_seq").cast("long") * DAY_MS).alias("from_ms"),
        F.when(~F.col("is_current"), (F.col("_valid_to_seq_excl").cast("long") + 1) * DAY_MS - 1).alias("to_ms"),
    )
    facts = event_table(spark, sf_dir).selectExpr(
        "event_id",
        "user_id AS o_custkey",
        f"(2000 + event_id % 2400) * {DAY_MS}L + event_id * 7919 % {DAY_MS}L AS at_ms",
    )
    found = asof_join(facts, versions, ["o_custkey"], "at_ms", "from_ms", "to_ms")
    return found.select("event_id", "o_custkey", "at_ms", "o_orderpriority", "from_ms")


def _wide_versions(spark, sf_dir) -> DataFrame:
    orders = _orders_by_day(spark, sf_dir).withColumn("day", F.col("day") + WIDE_SHIFT)
    daily = one_row_per_seq(orders, "o_custkey", "day", ["o_orderpriority"], ["o_orderkey"])
    return scd2_islands(daily, "o_custkey", "day", ["o_orderpriority"])


@query
def scd2_versions_wide(spark, sf_dir):
    """Versions over a sequence above 999999; the current one has no end."""
    return _wide_versions(spark, sf_dir)


@query
def point_in_time_lookup_wide(spark, sf_dir):
    """The lookup over versions whose last one is open."""
    facts = event_table(spark, sf_dir).selectExpr(
        "event_id", "user_id AS o_custkey", f"CAST({WIDE_SHIFT} + 2000 + event_id % 2400 AS INT) AS day"
    )
    bounds = ("day", "_valid_from_seq", "_valid_to_seq_excl")
    found = joins.point_in_time_join(facts, _wide_versions(spark, sf_dir), ["o_custkey"], *bounds, chunk=512)
    return found.select("event_id", "o_custkey", "day", "o_orderpriority", "_valid_from_seq")


# ---- aggregates, windows, winners ----------------------------------------


@query
def group_winner_rows(spark, sf_dir):
    """Cheapest supplier per month, all labels from one row."""
    df = changes(spark, sf_dir, "laps").groupBy(*RACE, "driver_code").agg(
        F.max("team").alias("team"), F.min("lap_time_ms").alias("best_ms")
    )
    out = winners.group_winner(
        df, RACE, ["driver_code", "team"], {"best_ms": "best"}, pick="row"
    )
    return out


@query
def flag_fastest_spread(spark, sf_dir):
    """Fastest-in-session flag with the shuffled, salted join."""
    laps = changes(spark, sf_dir, "laps").select("event_id", *SESSION, "sector1_ms")
    return winners.flag_group_minimum(laps, SESSION, "sector1_ms", "fastest", NO_BROADCAST)


@query
def previous_and_next(spark, sf_dir):
    """Neighbouring order days per customer, linked across slices."""
    days = _orders_by_day(spark, sf_dir).groupBy("o_custkey", "day").agg(
        F.max("o_orderkey").alias("last_key")
    )
    linked = neighbours(days, ["o_custkey"], "day", ["last_key"], chunk=128)
    return linked.select(
        "o_custkey",
        "day",
        F.col("_prev")["day"].alias("prev_day"),
        F.col("_prev")["last_key"].alias("prev_key"),
        F.col("_next")["day"].alias("next_day"),
    )


@query
def aggregate_functions(spark, sf_dir):
    """count, count_if, min, max, avg, stddev and exact distinct counts."""
    t = changes(spark, sf_dir, "telemetry")
    return t.groupBy("round", "session_type").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("drs").isin(*silver.DRS_ACTIVE)).alias("drs_rows"),
        F.count_distinct("driver_code").alias("drivers"),
        F.min("session_time_ms").alias("first_ms"),
        F.max("team").alias("team"),
        F.max("brake").alias("braked"),
        F.round(F.avg("session_time_ms"), 4).alias("avg_ms"),
        F.round(F.stddev("session_time_ms"), 2).alias("sd_ms"),
    )


@query
def scalar_functions(spark, sf_dir):
    """Sequence coding, clamping, text and null handling."""
    r = changes(spark, sf_dir, "results").withColumn("race_seq", race_seq())
    return r.select(
        "event_id",
        "__source_lsn",
        "race_seq",
        seq_season("race_seq").alias("season_back"),
        seq_round("race_seq").alias("round_back"),
        clamp((F.col("q1_ms") - 75_000).cast("double") / 1000.0, 0.0, 2.0).alias("clamped"),
        F.upper(F.trim("status")).alias("status"),
        F.coalesce("team", F.lit("-")).alias("team"),
        F.col("full_name").like("%Jr%").alias("junior"),
        F.col("classified_position").rlike("^[0-9]+$").alias("numeric"),
    )


# ---- timeline ------------------------------------------------------------


def _timeline(spark, sf_dir) -> DataFrame:
    samples = changes(spark, sf_dir, "telemetry").select(*SESSION, "event_id", "session_time_ms")
    laps = changes(spark, sf_dir, "session_status").selectExpr(
        *SESSION, "__source_lsn AS event_id", "session_time_ms"
    )
    return replay.merge_timeline(samples, laps, SESSION)


@query
def replay_timeline(spark, sf_dir):
    return _timeline(spark, sf_dir)


@query
def replay_gaps(spark, sf_dir):
    return replay.replay_schedule(_timeline(spark, sf_dir), SESSION, speed=900.0)


@query
def replay_due_times(spark, sf_dir):
    """When each event is due after the start of its session's replay."""
    schedule = replay.replay_schedule(_timeline(spark, sf_dir), SESSION, speed=900.0)
    return replay.due_times(schedule, SESSION).drop("gap_s")


@query
def replay_totals(spark, sf_dir):
    schedule = replay.replay_schedule(_timeline(spark, sf_dir), SESSION, speed=900.0)
    return replay.replay_summary(schedule, SESSION)


# ---- expectations --------------------------------------------------------


@query
def expect_not_null(spark, sf_dir):
    columns = ["driver_code", "team", "lap_time_ms", "sector1_ms", "compound"]
    return quality.null_counts(changes(spark, sf_dir, "laps"), columns)


@query
def expect_unique(spark, sf_dir):
    return quality.duplicate_keys(changes(spark, sf_dir, "weather"), ["event_id"])


@query
def expect_accepted_values(spark, sf_dir):
    accepted = [*silver.COMPOUNDS, "UNKNOWN"]
    return quality.unexpected_values(changes(spark, sf_dir, "laps"), "compound", accepted)


@query
def expect_grain(spark, sf_dir):
    keys = ["l_orderkey", "l_linenumber"]
    return quality.duplicate_keys(table(spark, sf_dir, "lineitem"), keys)


@query
def expect_silver_results(spark, sf_dir):
    """Every rule of a silver table with its number of failures."""
    rules = (*silver.MODELS["results"].rules, quality.Grain((*RACE, "driver_code")))
    return quality.check(silver_table(spark, sf_dir, "results"), rules)


@query
def expect_gold_mart(spark, sf_dir):
    model = gold.MODELS["mart_driver_race_result"]
    # Every rule reads the table, so it is built once.
    mart = stored(build_gold(spark, sf_dir, "mart_driver_race_result"), "mart")
    return quality.check(mart, model.rules)


# ---- panel ---------------------------------------------------------------


@query
def panel_job_history(spark, sf_dir):
    jobs = panel.current_jobs(changes(spark, sf_dir, "ingestion_jobs"))
    now = F.lit("2002-01-01 00:00:00").cast("timestamp")
    return panel.job_history(jobs, 100, now)


@query
def panel_coverage(spark, sf_dir):
    laps = changes(spark, sf_dir, "session_status")
    return panel.coverage(changes(spark, sf_dir, "telemetry"), laps)


@query
def panel_table_counts(spark, sf_dir):
    tables = {source: changes(spark, sf_dir, d) for source, d in SOURCE_TABLES.items()}
    return panel.table_counts(tables)


@query
def panel_classification(spark, sf_dir):
    return panel.classification(changes(spark, sf_dir, "results"), 1998, 7, "R")


@query
def panel_drivers_present(spark, sf_dir):
    return panel.drivers_present(changes(spark, sf_dir, "telemetry"), 2024, 12, "Q")


@query
def panel_fastest_drivers(spark, sf_dir):
    summary = build_gold(spark, sf_dir, "fact_driver_season_summary")
    return panel.fastest_drivers(summary).select("season", "driver_code", "fastest_lap_s")


@query
def panel_selector_values(spark, sf_dir):
    return panel.selector_values(changes(spark, sf_dir, "telemetry"), SESSION)


@query
def first_samples_of_driver(spark, sf_dir):
    """One driver's first samples by session time, as in a limited load."""
    log = changes(spark, sf_dir, "telemetry")
    return for_driver(log, "U7", 25).select("driver_code", "session_time_ms")


# ---- sources and sinks ---------------------------------------------------


@query
def stream_bronze_events(spark, sf_dir):
    """Drain the events file as a stream into a partitioned append-only table."""
    target = shared_dir(spark, "bronze")
    source = event_table(spark, sf_dir)
    stream = bronze_stream.read_new_files(
        spark, sf_dir, source.schema, "parquet", options={"pathGlobFilter": "events.parquet"}
    )
    bronze_stream.finish(
        bronze_stream.append_stream(
            stream, target, shared_dir(spark, "checkpoint"), ["event_type"]
        )
    )
    return (
        spark.read.parquet(target)
        .where(F.col("_bronze_loaded_at").isNotNull())
        .select("event_id", "user_id", "event_type", "value", "props")
    )


def _as_change_rows(df: DataFrame, dataset: str) -> DataFrame:
    """All columns of the change contract, missing ones null."""
    known = set(df.columns)
    return df.select(
        *[
            (F.col(f.name) if f.name in known else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in change_schema(dataset).fields
        ]
    )


@query
def stream_bronze_topics(spark, sf_dir):
    """Land all eight topics as Avro, drain them side by side, count rows."""
    landing = shared_dir(spark, "landing")
    root = shared_dir(spark, "bronze")
    specs = bronze_stream.topic_specs()
    for topic, spec in specs.items():
        rows = _as_change_rows(changes(spark, sf_dir, spec.table), spec.table)
        rows.write.format(file_format(spark, "avro")).save(f"{landing}/{topic}")
    bronze_stream.drain(spark, landing, root, shared_dir(spark, "checkpoint"), specs)
    tables = {spec.table: spark.read.parquet(f"{root}/{spec.table}") for spec in specs.values()}
    return bronze_stream.table_counts(tables)


@query
def stream_bronze_laps(spark, sf_dir):
    """One topic landed as Avro and drained, by content."""
    landing, root = shared_dir(spark, "landing"), shared_dir(spark, "bronze")
    specs = {t: s for t, s in bronze_stream.topic_specs().items() if s.table == "laps"}
    log = changes(spark, sf_dir, "laps")
    for topic in specs:
        _as_change_rows(log, "laps").write.format(file_format(spark, "avro")).save(f"{landing}/{topic}")
    bronze_stream.drain(spark, landing, root, shared_dir(spark, "checkpoint"), specs)
    loaded = spark.read.schema(change_schema("laps")).parquet(f"{root}/laps")
    return loaded.select("event_id", *SESSION, "driver_code", "lap_number", "lap_time_ms", "__op", "__source_lsn")


@query
def silver_load_stamps(spark, sf_dir):
    """Rows of every silver state, and how many carry a load stamp."""
    counted = []
    for name in silver.MODELS:
        rows = silver.state(silver.MODELS[name], changes(spark, sf_dir, name))
        counts = rows.agg(F.count(F.lit(1)).alias("linhas"), F.count("_silver_loaded_at").alias("stamped"))
        counted.append(counts.select(F.lit(name).alias("tabela"), "linhas", "stamped"))
    return reduce(lambda a, b: a.unionByName(b), counted)


@query
def stream_silver_results(spark, sf_dir):
    """Bronze files streamed in small batches into the silver state."""
    landing = shared_dir(spark, "bronze")
    log = _as_change_rows(changes(spark, sf_dir, "results"), "results")
    # As many files as the session's shuffles have partitions, so that none grows with the table, in three batches.
    files = max(3, int(spark.conf.get("spark.sql.shuffle.partitions")))
    log.repartition(files, "__source_lsn").write.parquet(landing)
    stream = bronze_stream.read_new_files(
        spark, landing, change_schema("results"), "parquet", files_per_trigger=-(-files // 3)
    )
    state = shared_dir(spark, "state")
    bronze_stream.finish(
        merge_stream(spark, stream, "results", state, shared_dir(spark, "checkpoint"), gate=False)
    )
    return read_live(spark, state, silver.MODELS["results"])


@query
def landing_hour_folders(spark, sf_dir):
    """Events written below hour folders; rows per folder, read back."""
    path = shared_dir(spark, "landing")
    events = event_table(spark, sf_dir).drop("props")
    write_landing(events.withColumn("ts", F.col("ts").cast("timestamp")), path, clock=F.col("ts"))
    folders = "year string, month string, day string, hour string"
    avro = spark.read.format(file_format(spark, "avro"))
    back = avro.schema(f"event_id long, user_id long, {folders}").load(path)
    return back.groupBy("year", "month", "day", "hour").agg(
        F.count(F.lit(1)).alias("n"), F.sum("event_id").alias("ids")
    )


@query
def landing_rotation(spark, sf_dir):
    """Landing files are closed after a thousand records, as in a bus sink."""
    path = shared_dir(spark, "landing")
    month = F.date_trunc("month", F.col("ts").cast("timestamp"))
    events = event_table(spark, sf_dir).select("event_id", month.alias("at"))
    write_landing(events, path, "parquet", F.col("at"), ROTATED_RECORDS)
    back = spark.read.schema("event_id long, year string, month string").parquet(path)
    files = back.groupBy("year", "month", F.col("_metadata.file_path").alias("file")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("event_id").alias("ids")
    )
    total = F.sum("n")
    return files.groupBy("year", "month").agg(
        total.alias("n"),
        F.sum("ids").alias("ids"),
        (F.max("n") <= ROTATED_RECORDS).alias("within_limit"),
        (F.count(F.lit(1)) * ROTATED_RECORDS >= total).alias("enough_files"),
    )


@query
def landing_rotation_timed(spark, sf_dir):
    """Files closed after fifty records or a minute, on a clock a thousand times faster."""
    events = event_table(spark, sf_dir).selectExpr(
        "event_id", "event_type", "unix_micros(CAST(ts AS TIMESTAMP)) DIV 1000000 AS at_ms"
    )
    return file_numbers(events, ["event_type"], "at_ms", ["event_id"], records=50)


@query
def landing_folder_names(spark, sf_dir):
    named = with_hour_folders(event_table(spark, sf_dir), F.col("ts"))
    return named.select("event_id", "year", "month", "day", "hour")


@query
def landing_pinned_schema(spark, sf_dir):
    """Infer the landed files' schema once, pin it and read with it."""
    path = shared_dir(spark, "landing")
    events = event_table(spark, sf_dir).select("event_id", "user_id", "event_type", "value")
    avro = file_format(spark, "avro")
    events.write.format(avro).save(path)
    schema = pinned_schema(spark, path, "avro", shared_dir(spark, "schema"))
    return spark.read.format(avro).schema(schema).load(path)


@query
def append_with_new_column(spark, sf_dir):
    """Files written before and after a column was added, read as one table."""
    store = Tables(spark, shared_dir(spark, "tables"))
    events = event_table(spark, sf_dir).select("event_id", "event_type", "props", "ts")
    early = F.col("ts") < F.lit("2024-01-16 00:00:00").cast("timestamp_ntz")
    store.append("events", events.where(early).drop("props", "ts"))
    store.append("events", events.where(~early).drop("ts"))
    return store.read_log("events").select("event_id", "event_type", "props")


@query
def union_with_new_column(spark, sf_dir):
    events = event_table(spark, sf_dir).select("event_id", "event_type", "props", "ts")
    early = F.col("ts") < F.lit("2024-01-16 00:00:00").cast("timestamp_ntz")
    return cdc.union_evolving(
        events.where(early).drop("props", "ts"), events.where(~early).drop("ts")
    )


@query
def partitioned_table(spark, sf_dir):
    """Publish laps by session, read the sessions back."""
    store = Tables(spark, shared_dir(spark, "tables"))
    store.publish("laps", changes(spark, sf_dir, "laps"), SESSION)
    return store.read("laps").groupBy(*SESSION).agg(
        F.count(F.lit(1)).alias("n"), F.sum("lap_time_ms").alias("total_ms")
    )


@query
def rebuilt_table(spark, sf_dir):
    """Publish a table twice; readers see the last complete version."""
    store = Tables(spark, shared_dir(spark, "tables"))
    teams = build_gold(spark, sf_dir, "dim_team_scd2")
    store.publish("dim_team_scd2", teams.where("is_current"))
    store.publish("dim_team_scd2", teams, rules=gold.MODELS["dim_team_scd2"].rules)
    return store.read("dim_team_scd2")


@query
def gate_keeps_old_version(spark, sf_dir):
    """A version that breaks its grain is refused; readers still see the one before."""
    store = Tables(spark, shared_dir(spark, "tables"))
    teams = build_gold(spark, sf_dir, "dim_team_scd2")
    rules = gold.MODELS["dim_team_scd2"].rules
    written = store.publish("dim_team_scd2", teams, rules=rules)
    try:
        store.publish("dim_team_scd2", written.unionByName(written), rules=rules)
    except quality.ExpectationFailed:
        return store.read("dim_team_scd2")
    raise RuntimeError("a broken version was published")


@query
def bronze_new_column(spark, sf_dir):
    """Two drains from one checkpoint; the second landing has a column more."""
    landing, root = shared_dir(spark, "landing"), shared_dir(spark, "bronze")
    checkpoints, schemas = shared_dir(spark, "checkpoint"), shared_dir(spark, "schemas")
    events = event_table(spark, sf_dir).select("event_id", "event_type", "props", "ts")
    early = F.col("ts") < F.lit("2024-01-16 00:00:00").cast("timestamp_ntz")
    declared = events.select("event_id", "event_type").schema
    specs = {"events": bronze_stream.TopicSpec("events", declared, ("event_type",))}
    for part in (events.where(early).drop("props", "ts"), events.where(~early).drop("ts")):
        part.write.mode("append").format(file_format(spark, "avro")).save(f"{landing}/events")
        bronze_stream.drain(spark, landing, root, checkpoints, specs, schemas=schemas)
    loaded = spark.read.option("mergeSchema", "true").parquet(f"{root}/events")
    return loaded.select("event_id", "event_type", "props")


@query
def bronze_wider_while_draining(spark, sf_dir):
    """A file with a column more lands between the look at the schema and the load: nothing of it is lost."""
    landing, root = shared_dir(spark, "landing"), shared_dir(spark, "bronze")
    checkpoints, schemas = shared_dir(spark, "checkpoint"), shared_dir(spark, "schemas")
    events = event_table(spark, sf_dir).select("event_id", "event_type", "props", "ts")
    early = F.col("ts") < F.lit("2024-01-16 00:00:00").cast("timestamp_ntz")
    spec = bronze_stream.TopicSpec("events", events.select("event_id", "event_type").schema, ("event_type",))
    avro, topic = file_format(spark, "avro"), f"{landing}/events"
    events.where(early).drop("props", "ts").write.format(avro).save(topic)
    ledger = bronze_stream.ledger_of(checkpoints, spec)
    schema = enter_files(spark, topic, "avro", ledger, f"{schemas}/events", spec.schema)
    events.where(~early).drop("ts").write.mode("append").format(avro).save(topic)
    bronze_stream.load_entered(spark, root, checkpoints, {"events": spec}, {"events": schema})
    bronze_stream.drain(spark, landing, root, checkpoints, {"events": spec}, schemas=schemas)
    loaded = spark.read.option("mergeSchema", "true").parquet(f"{root}/events")
    return loaded.select("event_id", "event_type", "props")


@query
def namespace_tables(spark, sf_dir):
    """One table in each of the three namespaces, the last one read by its qualified name."""
    bronze, silver_space, gold_space = create_namespaces(spark, location=shared_dir(spark, "catalog"))
    # Namespaces are shared by the session: a name of its own for every run.
    name = f"events_{uuid.uuid4().hex}"

    def save(df: DataFrame, space: str) -> DataFrame:
        df.write.option("path", shared_dir(spark, f"{space}-events")).saveAsTable(f"{space}.{name}")
        return spark.table(f"{space}.{name}")

    log = save(event_table(spark, sf_dir).select("event_id", "user_id", "event_type"), bronze)
    newest = save(log.groupBy("user_id").agg(F.max_by("event_type", "event_id").alias("event_type")), silver_space)
    counted = newest.groupBy("event_type").agg(F.count(F.lit(1)).alias("users"))
    return save(counted, gold_space)


@query
def bulk_append(spark, sf_dir):
    """Append a load of every session dataset to its source table; row counts."""
    store = Tables(spark, shared_dir(spark, "tables"))
    names = {s: d for s, d in SOURCE_TABLES.items() if d != "ingestion_jobs"}
    for source, dataset in names.items():
        known = set(source_schema(dataset).names)
        rows = changes(spark, sf_dir, dataset)
        store.append(source, rows.select(*[c for c in rows.columns if c in known]))
    return bronze_stream.table_counts({s: store.read_log(s) for s in names})


def raw_frame(spark, sf_dir, dataset: str) -> DataFrame:
    """A raw frame: intervals for durations, NaN for missing numbers."""
    df = changes(spark, sf_dir, dataset)
    columns = ["season", "round", "session_type", "event_id", "__source_lsn"]
    for name, (raw_name, kind) in RAW_COLUMNS[dataset].items():
        value = F.col(name)
        if kind is convert.as_millis:
            value = F.expr(f"timestamp_millis({name}) - TIMESTAMP '1970-01-01 00:00:00'")
        elif kind in (convert.as_int, convert.as_float):
            value = F.coalesce(value.cast("double"), F.lit(float("nan")))
        columns.append(value.alias(raw_name))
    return df.select(*columns)


def _normalized(spark, sf_dir, dataset: str) -> DataFrame:
    return normalize(
        raw_frame(spark, sf_dir, dataset),
        dataset,
        F.col("season"),
        F.col("round"),
        F.col("session_type"),
    )


@query
def normalize_telemetry(spark, sf_dir):
    return _normalized(spark, sf_dir, "telemetry")


@query
def normalize_laps(spark, sf_dir):
    return _normalized(spark, sf_dir, "laps")


@query
def normalize_weather(spark, sf_dir):
    return _normalized(spark, sf_dir, "weather")


@query
def normalize_race_control(spark, sf_dir):
    df = _normalized(spark, sf_dir, "race_control")
    return df.withColumn("msg_time", F.unix_micros("msg_time"))


@query
def normalize_track_status(spark, sf_dir):
    return _normalized(spark, sf_dir, "track_status")


@query
def normalize_session_status(spark, sf_dir):
    return _normalized(spark, sf_dir, "session_status")


@query
def normalize_results(spark, sf_dir):
    return _normalized(spark, sf_dir, "results")
