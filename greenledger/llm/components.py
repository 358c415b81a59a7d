"""Connected components of a distributed edge table by alternating star operations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from greenledger.llm.common import shuffle_partitions, written


#: Edges that a task writes at least: small tables don't become hundreds of files.
EDGES_PER_TASK = 1 << 14


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of ``edges`` (a, b) that is not its component's
    smallest node; ``root`` is the smallest.

    Each round links every larger neighbour of a node, then the node and its
    smaller neighbours, to the smallest node around, until all that is left are
    stars: no node with a smaller neighbour has another one. That is observed
    while a round's first table is written. Rounds grow with the logarithm of
    the longest path, and only narrow edges move.
    """
    spark = edges.sparkSession
    tasks = shuffle_partitions(spark)
    state, seen = _written(edges.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    while True:
        tasks = max(1, min(tasks, -(-seen["n"] // EDGES_PER_TASK)))  # a round makes no more edges than two times those before
        both = state.union(state.select("b", "a").toDF("a", "b"))
        around = both.groupBy("a").agg(F.min("b").alias("m"), F.count(F.lit(1)).alias("degree")).select(
            "a", F.least("a", "m").alias("m"), "degree")
        large, seen = _written(both.join(around, "a").select("a", "b", "m", "degree"), F.col("b") > F.col("a"), tasks, [
            F.count_if((F.col("b") < F.col("a")) & (F.col("degree") > 1)).alias("loose")])
        if not seen["loose"]:
            return state.toDF("node", "root")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a != b").union(
            least.select("a", "m"))
        state, seen = _written(small.distinct(), tasks=tasks)


def _written(edges: DataFrame, up: Column | None = None, tasks: int | None = None, observed: list[Column] = ()) -> tuple[DataFrame, dict]:
    """The edges, written, and what was observed: their number ``n``, and
    ``observed`` over all rows. With ``up`` only those rows are kept, as (b, m)."""
    seen = Observation()
    rows = edges.observe(seen, F.count(F.lit(1)).alias("n"), *observed)
    if up is not None:
        rows = rows.filter(up).select(F.col("b").alias("a"), F.col("m").alias("b"))
    out = written(rows.coalesce(tasks) if tasks else rows, "edges")
    return out, seen.get
