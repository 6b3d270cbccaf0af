"""Connected components by alternating large-star and small-star steps.

Each step is two shuffles over the edges; the number of steps grows with the
logarithm of the components' diameter, not with their size. Neither edges nor
labels pass through the driver; each round is cut with ``checkpoint()``, and its
shuffle files go with it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statloom.llm.shared import tidy
from statloom.session import ensure_checkpoint_dir


def _stars(edges: DataFrame) -> DataFrame:
    """One large-star step and one small-star step over edges (u, v) with u > v."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    large = both.join(least, "u").where("v > u AND v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
    least = large.groupBy("u").agg(F.min("v").alias("m"))
    joined = large.join(least, "u")
    return joined.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of the edges (u, v); the component is its smallest node.

    Edges may repeat and go either way; loops are ignored. No edges give no rows.
    """
    ensure_checkpoint_dir(edges.sparkSession)
    with tidy(edges.sparkSession):
        now = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u > v").distinct().checkpoint()
        mark = _mark(now)
        while mark[0]:
            new = _stars(now).checkpoint()
            if (seen := _mark(new)) == mark:
                break
            now, mark = new, seen
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
