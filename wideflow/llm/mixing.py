"""Mixing sources to target weights by systematic sampling.

Every source has a weight; the targets share the size of all documents by weight,
except that none is above ``cap`` times its source's size: the excess goes to the
others, by weight, until none is above (water filling, in closed form over the sources
ordered by the level at which each is full). A document's expected copies are
target / source size. Their prefix sum over the source's documents, plus one random
offset, gives a copy for each integer boundary that the document crosses.

The prefix sum is distributed: documents of a source are ordered by size class, then
bucket, then size and id; a first aggregate counts each (source, class, bucket) cell,
a window over those counts gives each cell's start, and a window within cells gives
the place in the cell. A cell holds a small part of a source, however large that is,
and the size order keeps the words taken close to the target.

Defined cases: a null or empty text has size 0 and is copied like any other; a null
source is a source of its own, after all others; repeated rows count and are sampled
each on its own; null ids order before others; an empty table gives no rows; columns other than these pass through.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import staged, text_or_empty, words


def text_size(text: str = "text") -> Column:
    """Number of words in a text (null: 0)."""
    return F.size(words(text_or_empty(text))).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), cap: int = 3) -> DataFrame:
    """``(source, source_size, target)`` from ``(source, source_size)``; one row per source throughout.

    Weights repeat over the sources in code point order, null last.
    """
    cycle = F.array(*[F.lit(w) for w in weights])
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    s = sizes.withColumn("w", F.element_at(cycle, (F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1).cast("int")).cast("long"))
    s = s.withColumn("full_at", F.lit(float(cap)) * F.col("source_size") / F.col("w"))
    order = Window.orderBy("full_at", F.col("source").asc_nulls_last())
    before, everything = order.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy(F.lit(1))
    s = s.withColumn("level", (F.sum("source_size").over(everything) - cap * F.coalesce(F.sum("source_size").over(before), F.lit(0)))
                     / (F.sum("w").over(everything) - F.coalesce(F.sum("w").over(before), F.lit(0))))
    # The first source that is not full at its level fixes the level of all.
    s = s.withColumn("level", F.min(F.when(F.col("level") <= F.col("full_at"), F.struct("full_at", "level"))).over(everything)["level"])
    return s.select("source", "source_size", F.least(F.lit(float(cap)) * F.col("source_size"), F.col("level") * F.col("w")).alias("target"))


def mix(docs: DataFrame, size: Column | None = None, id_col: str = "doc_id", source_col: str = "source",
        weights: tuple[int, ...] = (1, 2, 3), cap: int = 3, seed: int = 11) -> DataFrame:
    """All rows of ``docs`` with ``_size``, ``_source_size``, ``_target`` and ``_copies`` (0 to ``cap``)."""
    size = text_size() if size is None else size
    d = docs.withColumn("_size", size)
    # Buckets grow with the root of the rows: cells stay small, and so does their number.
    n = d.select(F.count("*")).first()[0]
    buckets = math.ceil(math.sqrt(n) / 32) or 1
    d = d.withColumns({
        "_mx_class": F.when(F.col("_size") > 0, F.floor(F.log2(F.col("_size").cast("double")) * 4)).otherwise(-1).cast("long"),
        "_mx_bucket": F.pmod(F.coalesce(F.col(id_col).cast("long"), F.lit(0)), F.lit(buckets).cast("long")),
    })
    # A null source becomes a key that joins and windows alike, so one shuffle serves both.
    d = d.withColumns({"_mx_null": F.col(source_col).isNull(), "_mx_source": F.coalesce(F.col(source_col), F.lit(""))})
    key = ["_mx_null", "_mx_source", "_mx_class", "_mx_bucket"]
    cells = staged(d.groupBy(key).agg(F.count("*").alias("n"), F.sum("_size").alias("s")), "mix-cells")
    source = F.when(~F.col("_mx_null"), F.col("_mx_source"))
    goal = targets(cells.groupBy(source.alias("source")).agg(F.sum("s").alias("source_size")), weights, cap).select(
        F.col("source").isNull().alias("_mx_null"), F.coalesce("source", F.lit("")).alias("_mx_source"),
        F.col("source_size").alias("_source_size"), F.col("target").alias("_target"))
    start = (Window.partitionBy("_mx_null", "_mx_source").orderBy("_mx_class", "_mx_bucket")
             .rowsBetween(Window.unboundedPreceding, -1))
    cells = (cells.withColumn("_mx_start", F.coalesce(F.sum("n").over(start), F.lit(0)))
             .join(goal, ["_mx_null", "_mx_source"]).select(*key, "_mx_start", "_source_size", "_target"))
    inside = Window.partitionBy(key).orderBy("_size", id_col)
    joined = d.withColumn("_mx_place", F.row_number().over(inside)).join(cells, key)
    offset = F.conv(F.substring(F.md5(F.concat(F.coalesce(F.col(source_col), F.lit("\\N")), F.lit(f":{seed}"))), 1, 8), 16, 10).cast("double") / F.lit(float(2 ** 32))
    rate = F.when(F.col("_source_size") > 0, F.col("_target") / F.col("_source_size")).otherwise(0.0)
    place = (F.col("_mx_start") + F.col("_mx_place")).cast("double")
    copies = F.floor(place * rate + offset) - F.floor((place - 1) * rate + offset)
    return (joined.withColumn("_copies", F.least(copies, F.lit(cap)).cast("long"))
            .drop(*key, "_mx_place", "_mx_start"))
