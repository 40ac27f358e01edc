"""Merge a batch of changes into a stored silver state, touched sessions only."""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from changeloom.operators.cdc import latest_by_key
from changeloom.operators.joins import BROADCAST_BYTES
from changeloom.operators.quality import ExpectationFailed, Unique, expect
from changeloom.operators.scope import affected_groups, match_groups, scope_to
from changeloom.plans.keyindex import KeyIndex
from changeloom.plans.silver import (
    STATE_ORDER,
    STATE_TIEBREAK,
    SilverModel,
    complete,
    live,
    state,
)
from changeloom.schemas import SESSION, change_schema
from changeloom.sources.files import remove
from changeloom.sources.tables import balanced, finish_replacement, replace_noted
from changeloom.session import freed_shuffles, shared_dir


# Keys of a batch that are sent to every task that reads the touched sessions.
FEW_KEYS = 500_000


@dataclass(frozen=True)
class Merged:
    """What a merge did: the sessions whose content may have changed."""

    touched: DataFrame


def newest_copy(rows: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """One row per key and session; only the newest of a key's copies stays live.

    A change can move a key to another session. Its older copy is kept there as
    deleted, so that the session is rewritten even when nothing else is left.
    `rows` hold few of a key: one of a batch, and one of each session of the state.
    """
    per_session = tuple(dict.fromkeys((*keys, *SESSION)))
    if set(per_session) == set(keys):
        return latest_by_key(rows, per_session, STATE_ORDER, STATE_TIEBREAK)
    # Brought together by key once, for both windows.
    rows = latest_by_key(rows.repartition(*keys), per_session, STATE_ORDER, STATE_TIEBREAK)
    order = [F.col(c).desc_nulls_last() for c in (*STATE_ORDER, *STATE_TIEBREAK)]
    # The session columns decide between copies that tie on everything else.
    ranking = Window.partitionBy(*keys).orderBy(*order, *SESSION)
    outdated = F.row_number().over(ranking) > 1
    return rows.withColumn("_is_deleted", F.col("_is_deleted") | outdated)


def updated(there: DataFrame, batch: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """The rows of the touched sessions after the batch, which has one row per key.

    Where the batch names few keys, only their rows are collapsed again. No other key gains a copy, and
    which of its copies is live was settled before. Nulls, which equal nothing, are collapsed anyway.
    """
    if batch.count() > FEW_KEYS:
        return newest_copy(there.unionByName(batch), keys)
    named = batch.select(*keys).withColumn("_named", F.lit(True))
    without = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in keys])
    met = F.coalesce(F.col("_named"), without)
    marked = there.join(F.broadcast(named), list(keys), "left").withColumn("_named", met)
    again = marked.where("_named").drop("_named").select(*batch.columns).unionByName(batch)
    return marked.where("NOT _named").select(*batch.columns).unionByName(newest_copy(again, keys))


def merge_changes(
    spark: SparkSession, model: SilverModel, changes: DataFrame, path: str, gate: bool = True
) -> Merged:
    """Apply change rows to the state at `path`, partitioned by session.

    Only sessions named by the batch, or holding an older copy of one of its
    keys, are read and rewritten; an index tells which hold one. With `gate`, the new rows must
    pass the model's expectations before readers see them, and a value that must be unique may not be in
    a session that is left alone either. Applying a batch twice changes nothing, and a merge that was
    interrupted while it replaced partitions is finished first. Rows are staged beside the partitions
    they replace and laid out like them, so that replacing moves folders and shuffles nothing.
    What the merge wrote for itself is removed, but for the list of touched sessions.
    """
    with freed_shuffles(spark):
        finish_replacement(spark, path)
        work = shared_dir(spark, f"merge-{model.name}")
        try:
            return merge_in(spark, model, changes, path, gate, work)
        finally:
            for written in ("batch", "rows", "derived"):
                remove(spark, f"{work}/{written}")


def merge_in(
    spark: SparkSession, model: SilverModel, changes: DataFrame, path: str, gate: bool, work: str
) -> Merged:
    """`merge_changes`, with a folder to work in."""
    staged_at = f"{path}/_staged-{uuid.uuid4().hex}"
    state(model, changes).write.parquet(f"{work}/batch")
    batch = spark.read.parquet(f"{work}/batch")
    old = None
    # A batch has one row per key and is stored already.
    newest, is_stored = batch, True
    if has_state(spark, path):
        # The batch's schema: a column the stored files do not have yet is null.
        old = spark.read.schema(batch.schema).parquet(path)
        sources = [batch]
        if keys_move(model):
            sources.append(index_of(spark, path, model.keys, old).find(batch))
        affected_groups(sources, SESSION).write.parquet(f"{work}/touched")
        touched = spark.read.parquet(f"{work}/touched")
        there = scope_to(old, touched, SESSION)
        # A batch that meets no stored row is collapsed as it is.
        if not there.isEmpty():
            newest, is_stored = updated(there, batch, model.keys), model.reads_twice
            if is_stored:
                newest.write.parquet(f"{work}/rows")
                newest = spark.read.parquet(f"{work}/rows")
    else:
        affected_groups([batch], SESSION).write.parquet(f"{work}/touched")
        touched = spark.read.parquet(f"{work}/touched")
    indexes = {columns: index_of(spark, path, columns, old) for columns in indexed(model)}

    def add() -> None:
        # What the state holds is in them already.
        for index in indexes.values():
            index.add(batch)

    def expect_elsewhere(rows: DataFrame) -> None:
        for columns, index in indexes.items():
            if old is not None and columns != model.keys:
                expect_unique_elsewhere(index, live(rows), live(old), touched, model.name)

    with ThreadPoolExecutor(1) as pool:
        # What a gate can refuse is not added before it has passed.
        adding = None if gate else pool.submit(inheritable_thread_target(spark)(add))
        if gate and is_stored:
            # Refused before it is staged; the derived columns change nothing in it.
            expect_elsewhere(newest)
        table = complete(model, newest, f"{work}/derived")
        balanced(table, SESSION).write.partitionBy(*SESSION).parquet(staged_at)
        if gate:
            staged = spark.read.schema(table.schema).parquet(staged_at)
            try:
                expect(live(staged), model.rules, model.name)
                if not is_stored:
                    expect_elsewhere(staged)
            except ExpectationFailed:
                remove(spark, staged_at)
                raise
            add()
        else:
            adding.result()
    replace_noted(spark, staged_at, path, SESSION)
    return Merged(touched)


def keys_move(model: SilverModel) -> bool:
    """Whether a change can carry a key to another session."""
    return not set(SESSION) <= set(model.keys)


def indexed(model: SilverModel) -> list[tuple[str, ...]]:
    """Column sets whose sessions are kept: keys that can move, and columns that must be unique."""
    unique = [(r.column,) for r in model.rules if isinstance(r, Unique)]
    return list(dict.fromkeys([*([model.keys] if keys_move(model) else []), *unique]))


def index_of(spark: SparkSession, path: str, columns: tuple[str, ...], old: DataFrame | None) -> KeyIndex:
    """The index of a state; one that was stored without it is read once for it."""
    index = KeyIndex(spark, f"{path.rstrip('/')}-keys/{'-'.join(columns)}", columns, SESSION)
    if old is not None and not index.exists():
        index.add(old)
    return index


def expect_unique_elsewhere(
    index: KeyIndex, staged: DataFrame, old: DataFrame, touched: DataFrame, name: str
) -> None:
    """Raise when a live value of `staged` is also live in a session that the merge leaves alone.

    Only sessions that the index names are read.
    """
    column = index.keys[0]
    pairs = index.find(staged)
    elsewhere = match_groups(pairs, touched, SESSION, "left_anti", BROADCAST_BYTES, stored=False)
    # Sessions, of which there are few, so that what is read of the state is cut to them.
    found = elsewhere.select(*SESSION).distinct().collect()
    if not found:
        return
    sessions = old.sparkSession.createDataFrame(found, elsewhere.select(*SESSION).schema)
    there = scope_to(old, sessions, SESSION).select(column)
    both = there.join(staged.select(column).distinct(), [column], "left_semi").distinct().count()
    if both:
        raise ExpectationFailed(f"{name}: unique({column}): {both} in other sessions")


def stored_schema(spark: SparkSession, model: SilverModel) -> T.StructType:
    """Columns of a stored state, whatever the age of its files."""
    nothing = spark.createDataFrame([], change_schema(model.name))
    return complete(model, state(model, nothing)).schema


def read_live(spark: SparkSession, path: str, model: SilverModel) -> DataFrame:
    """Live rows of the state at `path`."""
    finish_replacement(spark, path)
    return live(spark.read.schema(stored_schema(spark, model)).parquet(path))


def has_state(spark: SparkSession, path: str) -> bool:
    """Whether a state was written before: its folder holds partitions."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(folder):
        return False
    return any(s.getPath().getName().startswith(f"{SESSION[0]}=") for s in fs.listStatus(folder))
