"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from threading import Lock

from pyspark.sql import SparkSession

# Runtime SQL settings every job relies on, set where the cluster chose none.
RUNTIME_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Split a skewed join even where that costs one more shuffle downstream.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Working tables and landing files are written and read once or twice: a quarter less on disk.
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.avro.compression.codec": "zstandard",
}


def build_session(
    app: str = "changeloom",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """A session with the library's settings; `master` only for local runs."""
    builder = SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    return with_defaults(builder.getOrCreate())


def with_defaults(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings that the session's configuration leaves open."""
    configured = spark.sparkContext.getConf()
    for key, value in RUNTIME_DEFAULTS.items():
        if not configured.contains(key):
            spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder all executors can reach, below `spark.checkpoint.dir`.

    Only a local session without that setting gets a folder in /tmp; a cluster
    session must name a shared one.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        base = tempfile.mkdtemp(prefix="changeloom-")
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


# Spark's setting, and where a session keeps how many blocks of code want it.
FREES_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_WANTED = "changeloom.freed-shuffles"
_counting = Lock()


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Files of a shuffle go when its query ends, not when the driver collects its garbage.

    For code that runs no frame twice: its shuffles would be made again. A setting of the cluster stays.
    """
    if spark.sparkContext.getConf().contains(FREES_SHUFFLES):
        yield
        return

    def want(more: int) -> None:
        with _counting:
            wanted = int(spark.conf.get(_WANTED, "0")) + more
            spark.conf.set(_WANTED, str(wanted))
            spark.conf.set(FREES_SHUFFLES, "true" if wanted else "false")

    want(1)
    try:
        yield
    finally:
        want(-1)
