"""Connected components of a link table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common
from .common import join_unique, staged


def components(links: DataFrame) -> DataFrame:
    """``(id, component)`` of every id in ``links`` (a, b); the component is its smallest id.

    Every step is a grouped minimum (combined before the shuffle) and a join to it that leaves the links of
    hot ids where they are (``join_unique``), so an id with very many links stays in no single task.
    Links with a null side count for nothing.
    """
    e = staged(links.where("a IS NOT NULL AND b IS NOT NULL AND a <> b")
               .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "stars")
    ids = e.select(F.col("u").alias("id")).union(e.select(F.col("v").alias("id"))).distinct()
    seen = None
    while True:
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == seen or now[0] == 0:
            break
        seen = now
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (join_unique(both, least, "u", n=2 * now[0]).where("v > u AND v <> m")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        if 2 * now[0] > common.HOT_ROWS:
            large = staged(large, "stars")  # read more than once below
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (join_unique(large, least, "u", n=2 * now[0]).where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(least.select("u", F.col("m").alias("v"))).distinct())
        e = staged(small, "stars")
    return ids.join(e.select(F.col("u").alias("id"), F.col("v").alias("c")), "id", "left").select(
        "id", F.coalesce("c", "id").alias("component"))
