"""Published tables: complete versions side by side, readers take the newest."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changeloom.operators.joins import BROADCAST_BYTES, fits_broadcast
from changeloom.operators.quality import Grain, Rule, expect
from changeloom.operators.scope import match_groups, scope_to
from changeloom.sources.blocks import fits_blocks, packed, unpacked
from changeloom.sources.files import exists, locate, read_text, remove, write_text

# Medallion namespaces.
LAYERS = ("bronze", "silver", "gold")
_READY = "_PUBLISHED"
_PENDING = "_REPLACING"
# Estimated size from which rows are shuffled as blocks.
BLOCKS_FROM_BYTES = 16 * 1024 * 1024


def create_namespaces(spark: SparkSession, catalog: str | None = None, location: str | None = None) -> list[str]:
    """Create the three schemas, in `catalog` when the session knows one, below `location` if given."""
    prefix = f"{catalog}." if catalog else ""
    names = [f"{prefix}{layer}" for layer in LAYERS]
    for layer, name in zip(LAYERS, names, strict=True):
        at = f" LOCATION '{location}/{layer}'" if location else ""
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name}{at}")
    return names


class Tables:
    """Parquet tables below one root folder on any Hadoop file system.

    A publish writes a new version folder, checks it, and only then marks it
    ready. A failed or repeated run never touches the version being read.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def _numbers(self, name: str) -> list[int]:
        fs, folder = locate(self.spark, self.path(name))
        if not fs.exists(folder):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(folder)]
        return sorted(int(n[2:]) for n in names if n.startswith("v="))

    def version(self, name: str) -> int | None:
        """Newest ready version of a table."""
        for number in reversed(self._numbers(name)):
            if exists(self.spark, f"{self.path(name)}/v={number}/{_READY}"):
                return number
        return None

    def exists(self, name: str) -> bool:
        return self.version(name) is not None

    def read(self, name: str) -> DataFrame:
        number = self.version(name)
        if number is None:
            raise FileNotFoundError(self.path(name))
        target = f"{self.path(name)}/v={number}"
        finish_replacement(self.spark, target)
        return self.spark.read.schema(self._schema(target)).parquet(target)

    def _schema(self, target: str) -> T.StructType:
        """Schema stored in the ready marker: a version without rows has no file to tell it."""
        return T.StructType.fromJson(json.loads(read_text(self.spark, f"{target}/{_READY}")))

    def publish(
        self,
        name: str,
        df: DataFrame,
        partition_by: Sequence[str] = (),
        rules: Sequence[Rule] = (),
        view: Callable[[DataFrame], DataFrame] = lambda df: df,
    ) -> DataFrame:
        """Write a new version, test `view` of it, then let readers see it."""
        number = max(self._numbers(name), default=0) + 1
        target = f"{self.path(name)}/v={number}"
        writer = balanced(df, partition_by).write.mode("overwrite")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(target)
        written = self.spark.read.schema(df.schema).parquet(target)
        expect(view(written), rules, name)
        write_text(self.spark, f"{target}/{_READY}", df.schema.json())
        return written

    def replace(
        self,
        name: str,
        fresh: DataFrame,
        affected: DataFrame,
        group: Sequence[str],
        partition_by: Sequence[str],
        rules: Sequence[Rule] = (),
    ) -> DataFrame:
        """Put `fresh` in the place of the `affected` groups of the newest version.

        `group` must be among the partition columns, so groups are whole partitions; other
        partitions keep their files. The new rows are staged and tested first, keys that must be
        unique against the rows that stay as well. Partitions are replaced one after the other: what is
        to be done is noted before, and whoever reads or replaces next finishes what was interrupted.
        """
        if not set(group) <= set(partition_by):
            raise ValueError(f"{name}: groups must be whole partitions")
        old = self.read(name)
        staged_at = f"{self.path(name)}/_staged-{uuid.uuid4().hex}"
        balanced(fresh, partition_by).write.partitionBy(*partition_by).parquet(staged_at)
        staged = self.spark.read.schema(old.schema).parquet(staged_at)
        expect(staged, rules, name)
        for keys in (set(r.columns) for r in rules if isinstance(r, Grain)):
            # Keys that name their group can't meet a row of another group.
            if not set(group) <= keys:
                kept = match_groups(old, affected, group, "left_anti", BROADCAST_BYTES)
                expect(kept.unionByName(staged), [Grain(tuple(sorted(keys)))], name)
        written = folders(staged.select(F.col("_metadata.file_path").alias("file")), staged_at)
        placed = old.select(*group, F.col("_metadata.file_path").alias("file"))
        target = f"{self.path(name)}/v={self.version(name)}"
        emptied = folders(scope_to(placed, affected, group), target) - written
        replace_noted(self.spark, staged_at, target, partition_by, sorted(emptied))
        return self.read(name)

    def append(self, name: str, df: DataFrame, partition_by: Sequence[str] = ()) -> None:
        """Plain append to an unversioned table folder."""
        writer = balanced(df, partition_by).write.mode("append")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(self.path(name))

    def read_log(self, name: str) -> DataFrame:
        """An appended table; files of different ages may differ in columns."""
        return self.spark.read.option("mergeSchema", "true").parquet(self.path(name))


def folders(files: DataFrame, root: str) -> set[str]:
    """The partition folders, below `root`, of a column `file` with paths as Spark reports them."""
    folder = F.regexp_replace("file", "/[^/]*$", "")
    found = {r[0] for r in files.select(folder.alias("folder")).distinct().collect()}
    name = root.rstrip("/").rsplit("/", 1)[-1]
    # Reported paths are URIs: a folder's own escapes appear escaped once more.
    return {unquote(f.split(f"/{name}/", 1)[1]) for f in found if f"/{name}/" in f}


def balanced(df: DataFrame, partition_by: Sequence[str], in_blocks: bool = False) -> DataFrame:
    """Bring rows of a partition together before a partitioned write.

    Spark sizes the tasks by bytes, so a partition that outgrows a task is split. With `in_blocks`, rows that
    Spark does not estimate to be few are shuffled as blocks of columns.
    """
    if not partition_by:
        return df
    if not in_blocks or fits_broadcast(df, BLOCKS_FROM_BYTES) or not fits_blocks(df.schema):
        return df.hint("rebalance", *partition_by)
    return unpacked(packed(df, partition_by).hint("rebalance", *partition_by), df.schema)


@dataclass(frozen=True)
class Staged:
    """A folder that holds partitions as their table does, on the file system of the table."""

    spark: SparkSession
    path: str


def replace_partitions(staged: DataFrame | Staged, path: str, partition_by: Sequence[str]) -> None:
    """Overwrite just the partitions present in `staged`.

    `staged` must come from files outside `path`: a table cannot be read while
    it is overwritten. Partitions of a staged folder are moved, no row is read again.
    """
    if isinstance(staged, Staged):
        move_partitions(staged.spark, staged.path, path, len(partition_by))
        return
    (
        balanced(staged, partition_by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
        .parquet(path)
    )


def move_partitions(spark: SparkSession, staged: str, path: str, levels: int) -> None:
    """Put each partition folder below `staged`, `levels` deep, in the place of its namesake below `path`.

    As Spark's own commit of replaced partitions does. Folders moved by an interrupted call are gone from
    `staged`, so another call goes on with the rest.
    """
    fs, root = locate(spark, staged)
    found = [""]
    for _ in range(levels):
        names = [[s.getPath().getName() for s in fs.listStatus(locate(spark, f"{staged}{at}")[1]) if s.isDirectory()] for at in found]
        found = [f"{at}/{n}" for at, below in zip(found, names, strict=True) for n in below if "=" in n]
    for at in found:
        source, target = (spark._jvm.org.apache.hadoop.fs.Path(folder + at) for folder in (staged, path))
        fs.delete(target, True)
        fs.mkdirs(target.getParent())
        if not fs.rename(source, target):
            raise OSError(f"could not move {source.toString()}")


def replace_noted(
    spark: SparkSession,
    staged_at: str,
    path: str,
    partition_by: Sequence[str],
    emptied: Sequence[str] = (),
) -> None:
    """Put the partitions staged at `staged_at` in the place of those at `path`, and drop the `emptied` folders.

    Both folders have the same layout and file system. Partitions are replaced one after the other, and one may be gone for a moment. What is to be done
    is noted first, so that an interrupted replacement is finished from the staged folders.
    """
    pending = {"staged": staged_at, "partition_by": list(partition_by), "emptied": list(emptied)}
    write_text(spark, f"{path}/{_PENDING}", json.dumps(pending))
    finish_replacement(spark, path)


def finish_replacement(spark: SparkSession, path: str) -> None:
    """Carry out a replacement that was noted; doing so again changes nothing."""
    note = f"{path}/{_PENDING}"
    if not exists(spark, note):
        return
    pending = json.loads(read_text(spark, note))
    staged = Staged(spark, pending["staged"])
    if "schema" in pending:
        # Noted by an older release, which staged rows without the layout of the table.
        staged = spark.read.schema(T.StructType.fromJson(pending["schema"])).parquet(pending["staged"])
    replace_partitions(staged, path, pending["partition_by"])
    for folder in pending["emptied"]:
        remove(spark, f"{path}/{folder}")
    remove(spark, note)
    remove(spark, pending["staged"])
