"""Rows shuffled as blocks of columns before a partitioned write."""

import pytest
from builders import rows
from pyspark.sql import functions as F

from changeloom.sources import blocks, tables
from changeloom.streaming import bronze


@pytest.fixture
def always(monkeypatch):
    """Blocks at any size."""
    monkeypatch.setattr(tables, "BLOCKS_FROM_BYTES", 0)


ALL_TYPES = """
    id, CAST(id % 7 AS TINYINT) AS a, CAST(id AS SMALLINT) AS b, CAST(id AS INT) AS c, CAST(id / 7 AS FLOAT) AS d, IF(id % 5 = 0, double('NaN'), id / 7) AS e,
    CAST(id AS DECIMAL(38, 3)) AS f, DATE'1900-01-01' + CAST(id AS INT) AS g, TIMESTAMP'1969-12-31 23:59:59.123456' + make_interval(0, 0, 0, 0, 0, 0, id) AS h,
    TIMESTAMP_NTZ'2024-03-31 02:30:00.000001' AS i, IF(id % 3 = 0, NULL, concat('é', id)) AS j, CAST('x' AS BINARY) AS k, id % 2 = 0 AS l,
    CAST(NULL AS STRING) AS m, IF(id % 4 = 0, NULL, id % 4) AS p, IF(id % 6 = 0, NULL, string(id % 3)) AS q
"""


@pytest.mark.parametrize("chunk", [1, 1 << 26])
def test_rows_come_back_as_they_were(spark, monkeypatch, chunk):
    monkeypatch.setattr(blocks, "CHUNK_BYTES", chunk)
    df = spark.sql(f"SELECT {ALL_TYPES} FROM range(2000)")
    assert blocks.fits_blocks(df.schema)
    back = blocks.unpacked(blocks.packed(df, ["p", "q", "l"]).hint("rebalance", "p", "q"), df.schema)
    assert back.schema == df.schema and back.count() == 2000
    assert repr(rows(back, *df.columns)) == repr(rows(df, *df.columns))
    none = blocks.unpacked(blocks.packed(df.where("id < 0"), ["p"]), df.schema)
    assert none.count() == 0


def test_a_block_holds_one_partition(spark):
    df = spark.range(0, 1000, 1, 4).selectExpr("id", "id % 3 AS p")
    packed = blocks.packed(df, ["p"])
    assert rows(packed.groupBy("p").count(), "p", "count") == [(0, 4), (1, 4), (2, 4)]


def test_large_loads_shuffle_blocks_and_small_ones_rows(spark):
    """The exchange of a large load carries blocks, not whole rows."""
    def exchanged(df):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        return "RebalancePartitions" in plan, blocks.BLOCK in plan

    large = spark.range(10_000_000).selectExpr("id", "id % 3 AS p")
    assert exchanged(tables.balanced(large, ["p"], True)) == (True, True)
    assert exchanged(tables.balanced(spark.range(10).selectExpr("id", "id % 3 AS p"), ["p"], True)) == (True, False)
    # A type that a block can't keep exactly.
    nested = large.withColumn("s", F.struct("id"))
    assert exchanged(tables.balanced(nested, ["p"], True)) == (True, False)


def test_a_load_in_blocks_equals_one_in_rows(spark, folder, always):
    df = spark.sql(f"SELECT {ALL_TYPES} FROM range(3000)")
    for number in (0, 1, 1):
        assert bronze.write_load(df, f"{folder}/t", number, ["p", "q"]) == 3000
    table = spark.read.schema(df.schema).parquet(f"{folder}/t")
    assert repr(rows(table, *df.columns)) == repr(rows(df.unionByName(df), *df.columns))
    files = table.select("p", "q", F.input_file_name().alias("file")).distinct()
    # A file for each partition and load.
    assert files.count() == 2 * df.select("p", "q").distinct().count()


def test_a_hot_partition_of_blocks_is_split(spark, folder, always):
    advised = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(advised)
    spark.conf.set(advised, "256k")
    try:
        hot = spark.range(100_000).selectExpr("id", "CASE WHEN id % 3 > 0 THEN 0 ELSE id % 20 END AS p", "md5(string(id)) AS v")
        bronze.write_load(hot, f"{folder}/t", 0, ["p"])
    finally:
        spark.conf.set(advised, before)
    files = spark.read.parquet(f"{folder}/t").select("p", F.col("_metadata.file_path").alias("file")).distinct()
    counts = {r.p: r["count"] for r in files.groupBy("p").count().collect()}
    assert counts[0] > 4, counts
