"""Connected components by alternating large-star and small-star steps (joins and groupings only)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import written


def _smallest(edges: DataFrame) -> DataFrame:
    """``u, m``: the smallest of each node and its neighbours."""
    return edges.groupBy("u").agg(F.min("v").alias("v")).select("u", F.least("u", "v").alias("m"))


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` (the component's smallest node) of every node of the edges ``a, b``.

    A hot node's edges may be split over tasks: minima are pre-aggregated, and the joins that bring
    them back are ordinary ones. Every step is written to the shared folder.
    """
    now = written(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "components")
    before = None
    while (state := _state(now)) != before:
        before = state
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = both.join(_smallest(both), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        small = large.join(_smallest(large), "u")
        now = written(small.select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                                                     F.struct("u", F.col("m").alias("v")))).alias("e"))
                      .select("e.u", "e.v").where("u <> v").distinct(), "components")
    star = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return star.unionByName(star.select(F.col("component").alias("node"), "component").distinct())
