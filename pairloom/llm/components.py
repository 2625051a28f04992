"""Connected components of links, by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import Scratch


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """(id, component) of every id in links (a, b): the smallest id reachable.

    Each round hangs the neighbours of every id on its smallest neighbour, so
    the depth of any chain shrinks by a constant factor. A hub with many links
    is one key of a plain join, which adaptive execution splits. Rounds are
    written to the scratch folder; nothing but one count reaches the driver.
    Links of an id to itself or to null are ignored.
    """
    stars = scratch.put(
        links.where("a <> b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct(),
        "stars",
    )
    while True:
        both = stars.unionByName(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
        large = (
            both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        ).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(low, "u")
            .where("v <> m")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(low.select("u", F.col("m").alias("v")))
            .distinct()
        )
        after = scratch.put(small, "stars")
        settled = after.join(stars, ["u", "v"], "left_anti").isEmpty()
        stars = after
        if settled:
            break
    roots = stars.select(F.col("v").alias("id")).distinct().withColumn("component", F.col("id"))
    return stars.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(roots)
