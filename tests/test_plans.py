"""The physical plans the operators are meant to get."""

import re

import pytest
from pyspark.java_gateway import ensure_callback_server_started

from changeloom.operators import cdc, scope
from changeloom.plans import gold, silver
from changeloom.workloads.queries import QUERIES
from changeloom.workloads.views import CHANGES

SF_DIR = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def details(df) -> str:
    jvm = df.sparkSession._jvm
    query = df._jdf.queryExecution()
    return jvm.org.apache.spark.sql.api.python.PythonSQLUtils.explainString(query, "formatted")


def operators(df) -> list[str]:
    """Operator names from the top of the plan down."""
    lines = plan(df).splitlines()
    return [m.group(1) for m in (re.match(r"[\s:+\-*()\d]*([A-Z]\w+)", line) for line in lines) if m]


def test_collapse_cuts_rows_before_the_shuffle(spark):
    df = cdc.latest_by_key(CHANGES["weather"](spark, SF_DIR), ["event_id"])
    names = operators(df)
    exchange = names.index("Exchange")
    assert "WindowGroupLimit" in names[:exchange]
    assert "WindowGroupLimit" in names[exchange:]


def test_pace_reads_only_its_columns(spark, folder):
    CHANGES["laps"](spark, SF_DIR).write.parquet(f"{folder}/laps")
    laps = silver.build("laps", spark.read.parquet(f"{folder}/laps"))
    text = details(gold.fact_race_pace_comparison({"laps": laps}))
    read = re.findall(r"ReadSchema: (struct<.*?>)", text)
    assert read and all("tyre_life" not in r and "pit_in_time_ms" not in r for r in read)


def test_season_summary_stays_a_hash_aggregate(spark, folder):
    silver.state(silver.MODELS["laps"], CHANGES["laps"](spark, SF_DIR)).write.parquet(f"{folder}/s")
    laps = silver.live(silver.complete(silver.MODELS["laps"], spark.read.parquet(f"{folder}/s")))
    names = operators(gold.fact_driver_season_summary({"laps": laps}))
    # The passes over laps hash; only the few rows per team are sorted.
    assert names.count("HashAggregate") >= 4
    deepest_sort = max(i for i, n in enumerate(names) if n == "SortAggregate")
    assert "HashAggregate" in names[deepest_sort:]


def test_scoping_is_a_semi_join(spark):
    log = CHANGES["laps"](spark, SF_DIR)
    affected = scope.affected_groups([log.where("season = 2000")], ["season", "round"])
    assert "LeftSemi" in plan(scope.scope_to(log, affected, ["season", "round"]))


def test_scoping_prunes_partitions(spark, folder):
    laps, races = CHANGES["laps"](spark, SF_DIR), ["season", "round"]
    laps.write.partitionBy(*races).parquet(f"{folder}/laps")
    laps.where("season = 2000").select(*races).distinct().write.parquet(f"{folder}/touched")
    stored, touched = spark.read.parquet(f"{folder}/laps"), spark.read.parquet(f"{folder}/touched")
    text = plan(scope.scope_to(stored, scope.affected_groups([touched], races), races))
    assert re.search(r"PartitionFilters: \[[^\]]*dynamicpruning", text)


def test_partition_filter_reaches_the_scan(spark, folder):
    CHANGES["results"](spark, SF_DIR).write.partitionBy("season", "round").parquet(f"{folder}/r")
    df = spark.read.parquet(f"{folder}/r").where("season = 1998 AND round = 7 AND driver_code = 'D1'")
    text = plan(df)
    assert re.search(r"PartitionFilters: \[[^\]]*season[^\]]*1998", text)
    assert re.search(r"PushedFilters: \[[^\]]*driver_code", text)


WRITING = ("stream_", "merge_", "refresh_all", "refresh_gate", "landing_", "append_", "bulk_", "rebuilt", "partitioned", "namespace_",
           "refresh_late", "pipeline_", "gate_", "bronze_", "scope_pruned")


@pytest.mark.parametrize(
    "name", sorted(n for n in QUERIES if not n.startswith(WRITING))
)
def test_no_cross_joins_and_no_python(spark, name):
    text = plan(QUERIES[name](spark, SF_DIR))
    for unwanted in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "MapInPandas"):
        assert unwanted not in text


class Plans:
    """Physical plans of everything that runs while it listens."""

    def __init__(self, spark):
        self.spark, self.seen = spark, []

    def onSuccess(self, name, execution, nanos):
        self.seen.append(execution.executedPlan().toString())

    def onFailure(self, name, execution, error):
        pass

    class Java:
        implements = ["org.apache.spark.sql.util.QueryExecutionListener"]

    def __enter__(self):
        ensure_callback_server_started(self.spark.sparkContext._gateway)
        self.spark._jsparkSession.listenerManager().register(self)
        return self

    def __exit__(self, *_):
        self.spark._jsc.sc().listenerBus().waitUntilEmpty()
        self.spark._jsparkSession.listenerManager().unregister(self)


@pytest.mark.parametrize("name", ["merge_stored_results", "merge_stored_laps", "merge_null_sessions", "refresh_gated", "bronze_wider_while_draining"])
def test_writes_run_no_cross_joins_and_no_python(spark, name):
    with Plans(spark) as plans:
        QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
    assert len(plans.seen) > 5
    for text in plans.seen:
        for unwanted in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "MapInPandas", "MapInArrow"):
            assert unwanted not in text
