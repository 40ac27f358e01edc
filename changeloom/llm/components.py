"""Connected components of an edge table by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changeloom.llm.frames import store


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of `edges` (a long, b long); the root is the least node.

    Each round hangs the neighbours of a node on the least of them, first the
    larger ones, then the smaller ones. Minima are combined before the shuffle, written
    and joined back, so a node with many edges is split like any skewed join. A round
    is written to the shared folder; the number of rounds grows as the logarithm
    of the longest path.
    """
    stars = store(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    mark = fingerprint(stars)
    while mark[0]:
        both = stars.unionByName(stars.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = store(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), "least")
        larger = both.join(least, "a").where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        larger = store(larger.where("a <> b").distinct(), "larger")
        lowest = store(larger.groupBy("a").agg(F.min("b").alias("m")), "lowest")
        smaller = larger.join(lowest, "a")
        hung = smaller.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(smaller.select("a", F.col("m").alias("b")))
        stars = store(hung.where("a <> b").distinct(), "edges")
        before, mark = mark, fingerprint(stars)
        if mark == before:
            break
    roots = stars.select(F.col("b").alias("node")).distinct().join(stars.select(F.col("a").alias("node")), "node", "left_anti")
    return stars.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        roots.select("node", F.col("node").alias("root"))
    )


def fingerprint(edges: DataFrame) -> tuple[int, int]:
    """Count and order-free hash of the edges: equal when a round changed nothing."""
    row = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x")).first()
    return row.n, row.x or 0
