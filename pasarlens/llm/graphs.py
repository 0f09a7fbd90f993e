"""Connected components of an edge table, by alternating stars; every round is a stored table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pasarlens.llm.scratch import reduced, stored


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return tuple(row)


def connected_components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component`` (its smallest node) for all nodes of the edges ``a``, ``b``.

    Each round links larger neighbours to the smallest one (large star), then smaller ones (small star), until nothing changes:
    then every edge joins a node to its component. Joins are inner joins of neighbours with one row per node, which adaptive
    execution splits where a node has very many.
    """
    now = stored(
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "edges"
    )
    state = _state(now)
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = reduced(both, "a", F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = reduced(large, "a", F.min("b").alias("m"))
        joined = large.join(least, "a")
        small = joined.select("a", F.col("m").alias("b")).unionByName(
            joined.select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        )
        now = stored(small.distinct(), "edges")
        after = _state(now)
        if after == state:
            break
        state = after
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
