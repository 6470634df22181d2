"""Connected components by alternating star contractions (Kiveris et al., "Connected Components in MapReduce and Beyond")."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftline.llm.common import drop_written, written


def _least(edges: DataFrame) -> DataFrame:
    """u, m: the smallest of u and its neighbours v. A table of its own, so that the links of a hub can be split among tasks when joined with it."""
    return written(edges.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")


def components(edges: DataFrame) -> DataFrame:
    """(a, b) long pairs to (id, component): each id that has a link, and the smallest id it reaches.

    Each round is one aggregate and one join per star step, so a hub's links are only ever summed or split, never gathered;
    rounds grow with the logarithm of the longest path. Null ends and self links are ignored; no edges give no rows.
    """
    now = written(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    while not _stars(now):
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = _least(both)
        large = written(both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct(), "large")
        down = _least(large)  # every v is below its u
        small = large.join(down, "u").select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e")).select("e.*").where("u <> v").distinct()
        after = written(small, "edges")
        drop_written(now.sparkSession, now, least, large, down)
        now = after
    return now.select(F.col("u").alias("id"), F.col("v").alias("component")).union(now.select("v", "v").distinct())


def _stars(edges: DataFrame) -> bool:
    """Has every u one v, and is no v a u? Then v is the smallest id of its component."""
    ends = edges.select(F.explode(F.array(F.struct(F.col("u").alias("id"), F.lit(1).alias("up")), F.struct(F.col("v").alias("id"), F.lit(0).alias("up")))).alias("e")).select("e.*")
    return ends.groupBy("id").agg(F.sum("up").alias("ups"), F.min("up").alias("low")).where("ups > 1 or ups = 1 and low = 0").isEmpty()
