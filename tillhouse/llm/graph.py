"""Connected components by large stars and small stars, as joins and aggregates over an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillhouse.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """Edges (u, v) of longs, any direction, repeats allowed, to (node, root): the least node of its component.

    Nodes without an edge to another do not appear. Every round ends as a written table; a hub with many neighbours
    meets one row in each join, which Spark may split.
    """
    now = stored(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                 .where("u != v").distinct(), "stars")
    seen = None
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = stored(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "stars-least")
        large = stored(both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                       .distinct(), "stars-large")
        least = stored(large.groupBy("u").agg(F.min("v").alias("m")), "stars-least")
        small = (large.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(least.select("u", F.col("m").alias("v"))))
        now = stored(small.distinct(), "stars")
        state = now.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.xxhash64("v", "u") % 1000003)).first()
        if state == seen:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen = state
