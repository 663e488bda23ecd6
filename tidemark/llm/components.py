"""Connected components of an edge table, as joins and partial aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shared import in_few_tasks, written


def components(edges: DataFrame) -> DataFrame:
    """``(id, component)``: the smallest id that each end of ``edges(a, b)`` reaches.

    Alternates two steps until the edges stand still: each node hands its larger, then its
    smaller neighbours to its smallest one. Every step is a minimum per node with map-side
    combine and a join that adaptive execution can split, so a hub is no single task's load.
    Loops, repeats and both directions are allowed; ids without an edge don't appear.
    """
    pairs = written(_ordered(edges.select("a", "b"), edges.count()), "edges")
    rows, before = pairs.count(), None
    while True:
        stars = _ordered(_to_smallest(pairs, rows, larger=True), rows)
        pairs = written(_ordered(_to_smallest(stars, rows, larger=False), rows), "edges")
        now = pairs.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        rows = now[0]
        if now == before or now[0] == 0:
            break
        before = now
    roots = in_few_tasks(pairs.select(F.col("b").alias("id")).distinct(), rows).withColumn("component", F.col("id"))
    return pairs.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(roots)


def _ordered(pairs: DataFrame, rows: int) -> DataFrame:
    """Each edge once, from its larger end ``a`` to its smaller end ``b``."""
    once = (
        pairs.where("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )
    return in_few_tasks(once, rows)


def _to_smallest(pairs: DataFrame, rows: int, larger: bool) -> DataFrame:
    if larger:
        around = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = around.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"))
        least = least.select("node", F.least("node", "m").alias("m"))
        # the larger neighbours of a node
        return in_few_tasks(pairs.join(least, F.col("b") == F.col("node")).select("a", F.col("m").alias("b")), rows)
    least = pairs.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"))
    handed = in_few_tasks(pairs.join(least, F.col("a") == F.col("node")), rows)
    return handed.select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct("a", F.col("m").alias("b")))).alias("e")).select("e.a", "e.b")
