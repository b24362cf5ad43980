"""Connected components of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetgauge.llm.common import as_table


def components(links: DataFrame) -> DataFrame:
    """``id, component`` for every end of ``links`` (``a, b``): the smallest id that links lead to.

    In a large star each node ties its larger neighbours to the smallest one, in a small star its smaller ones.
    Edges never grow in number, and a few rounds leave stars around the smallest ids. Every round is one aggregate
    with partial sums and one plain join, written to the shared folder; nothing but a count and a sum is collected.
    """
    edges = as_table(links.filter("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                     .distinct(), "links")
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("low")).select("u", F.least("u", "low").alias("low"))
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("low").alias("v")).distinct()
        large = as_table(large.filter("u != v"), "large-star")
        low = large.groupBy("u").agg(F.min("v").alias("low"))
        small = large.join(low, "u").select(F.when(F.col("v") == F.col("low"), F.col("u")).otherwise(F.col("v"))
                                            .alias("u"), F.col("low").alias("v"))
        edges = as_table(small.filter("u != v").distinct(), "small-star")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v") % (1 << 40))).first()
        if now == before:
            break
        before = now
    stars = edges.groupBy("u").agg(F.min("v").alias("component")).select(F.col("u").alias("id"), "component")
    return as_table(stars.unionByName(stars.select("component").distinct()
                                      .select(F.col("component").alias("id"), "component")), "components")
