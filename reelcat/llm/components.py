"""Connected components by alternating large-star and small-star steps, all in DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelcat.session import stage_table


def components(edges: DataFrame) -> DataFrame:
    """(u, root) for every vertex that isn't its component's smallest; ``edges`` is (u, v) of longs.

    Each step is written out, so lineage stays short and a lost executor repeats one step.
    Hubs are joined against their minimum, never gathered.
    """
    e = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    seen = None
    while True:
        # large star: the larger neighbours of a vertex move to the smallest of its neighbourhood
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.least("u", "m").alias("v"))
        large = stage_table(large.where("u <> v").distinct(), "large-star")
        # small star: a vertex and its smaller neighbours move to the smallest of these
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        e = stage_table(small.select("e.u", "e.v").where("u <> v").distinct(), "small-star")
        now = tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == seen or not now[0]:
            return e.select("u", F.col("v").alias("root"))
        seen = now
