"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftwork.plans.stage import Stage


def components(edges: DataFrame, stage: Stage) -> DataFrame:
    """(node, component) of every node that is not its component's smallest one.

    ``edges`` has integer columns a and b in any direction; repeats, loops and nulls do no harm. A
    step links neighbours to the least node around them, so the number of edges never grows and
    chains shorten by a constant factor. The steps end once every node hangs from one that hangs
    from no other, which a single aggregation tells; as links run to smaller nodes, that one is
    the least of its component. Minima are merged within tasks, each step is written, and the
    driver sees a single node at most.
    """
    ends = edges.filter("a <> b").select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")
    )
    stars = stage.table(ends.distinct(), "edges", "zstd")
    while True:
        upward = stars.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down"))
        downward = stars.select(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down"))
        links = upward.union(downward).groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
        if not links.filter("up > 1 or up = 1 and down = 1").head(1):
            return stars.select(F.col("u").alias("node"), F.col("v").alias("component"))
        both = stars.union(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        large = (
            both.filter("v > u")
            .join(least, "u")
            .select(F.col("v").alias("u"), F.least("m", "u").alias("v"))
            .distinct()
        )
        large = stage.table(large, "large_star", "zstd")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), "m")
        stars = stage.table(small.union(least).toDF("u", "v").distinct(), "small_star", "zstd")
