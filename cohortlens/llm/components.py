"""Connected components of an edge table, by alternating large and small stars.

Each round rewires every node to the smallest neighbour it knows, with one
aggregate and one join a step, and is written to the shared folder; the number
of rounds grows with the logarithm of the longest path.  No component meets in
one task; rows of a hub are split by the adaptive skew join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.llm import storage

def _mark(e: DataFrame):
    """A fingerprint of an edge table: unchanged when a round changed nothing."""
    return e.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()


def _edges(e: DataFrame, *pairs: tuple[str, str]) -> DataFrame:
    """An (a, b) row for each of the pairs of columns: one branch of the plan, where a union would repeat ``e``."""
    return e.select(F.inline(F.array(*[F.struct(F.col(x).alias("a"), F.col(y).alias("b")) for x, y in pairs])))


def _large_star(e: DataFrame) -> DataFrame:
    both = _edges(e, ("a", "b"), ("b", "a"))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(e: DataFrame) -> DataFrame:
    down = e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a")
    return _edges(moved, ("b", "m"), ("a", "m"))


def components(edges: DataFrame, folder: str, name: str) -> DataFrame:
    """(a long, b long) edges -> (node, component): every node of an edge with the smallest node reachable from it."""
    spark = edges.sparkSession
    e = storage.stage(edges.select(F.col("a").cast("long"), F.col("b").cast("long")).where("a <> b").distinct(),
                      folder, f"{name}_0")
    mark, step = None, 0
    while True:
        now = _mark(e)
        if now == mark or not now["n"]:
            break
        mark, step = now, step + 1
        e = storage.stage(_small_star(_large_star(e)).where("a <> b").distinct(), folder, f"{name}_{step}")
        storage.drop(spark, folder, f"{name}_{step - 1}")
    return e.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        e.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
