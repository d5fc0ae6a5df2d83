"""Connected components of a link table by alternating star contractions.

Every node is linked to the least node of its neighbourhood, first for
larger neighbours, then for smaller ones, until the links form stars.  Each
step is a grouped minimum and a join, so neither a node's links nor a
component is ever gathered in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.tables import materialize


def summary(links: DataFrame):
    return tuple(links.agg(F.count("*"), F.bit_xor(F.xxhash64("hi", "lo"))).first())


def components(links: DataFrame) -> DataFrame:
    """``node, component`` for the linked nodes that are not the least of their
    component; ``links`` has columns ``a, b`` (not null, any order)."""
    stars = materialize(links.filter("a != b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct())
    before = summary(stars)
    while before[0]:
        both = stars.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(
            stars.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()
        least = large.groupBy("hi").agg(F.min("lo").alias("m"))
        joined = large.join(least, "hi")
        stars = materialize(joined.filter("lo != m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
                            .unionByName(least.select("hi", F.col("m").alias("lo"))).distinct())
        after = summary(stars)
        if after == before:
            break
        before = after
    return stars.select(F.col("hi").alias("node"), F.col("lo").alias("component"))
