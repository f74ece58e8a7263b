"""Connected components by alternating large-star and small-star steps, as joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradevigil.llm.store import stored


def _ordered(edges: DataFrame) -> DataFrame:
    """Each edge once, from the larger to the smaller end; loops go."""
    return edges.where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    )


def components(edges: DataFrame) -> DataFrame:
    """`node`, `root` (smallest node reachable) for every node of `edges` (`a`, `b`: bigint).

    A step hangs each node's neighbours onto its smallest neighbour; after about log n
    steps only stars are left. Every step's edges are stored, so lineage stays short and
    a lost executor costs one step. Only their count and checksum reach the driver. A
    hub's edges are split over tasks by the skew handling of joins; minima are combined
    before the shuffle. No edges: no rows.
    """
    edges = stored(_ordered(edges).distinct(), "edges")
    seen = None
    while True:
        mark = edges.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first()
        if mark == seen or mark[0] == 0:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            )
        seen = mark
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("low"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        large = _ordered(large).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(least, "a")
        small = small.select("a", F.col("low").alias("b")).unionByName(
            small.select(F.col("b").alias("a"), F.col("low").alias("b"))
        )
        edges = stored(_ordered(small).distinct(), "edges")
