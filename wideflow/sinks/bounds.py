"""Split points of a cell table, kept beside it, so that the files of all its batches are cut at the same keys.

A table's pointer (``sinks.live``) lists its split points: range ``i`` holds the keys from split point ``i`` up to the next one. An
aligned batch sends each row to its range's task (the range is found by a binary search among the points, per row), so no
file crosses a split point that was known when it was written. Before that, ranges that the batch would overfill are split: new points come
from an even hash sample of those ranges' distinct keys and are published together with the batch. Points are never removed, so
ranges only get finer and older files cover whole runs of later ranges. Of two writers that split at once both sets of points stay;
the files of the one that published first may then cross points of the other.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TASK = "_task"
#: Rows (wide rows of a load, cells of a sync) of one batch beyond which it splits a range.
ROWS_PER_RANGE = 1_000_000
#: Sampled keys for each range that is to be made. They place the points only; every row is written.
SAMPLED_KEYS = 128
#: New points of one batch; ranges that still are too large are split by the next batches.
NEW_POINTS = 4_096


def _literal(values: list, of: str) -> Column:
    """An array literal as one parsed text, not one expression per element."""
    return F.from_json(F.lit(json.dumps(values)), f"array<{of}>")


def range_of(key: str, points: list[str]) -> Column:
    """The number of split points up to the key, by binary search; 0 for a null key."""
    if not points:
        return F.lit(0)
    known = _literal(points, "string")
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(len(points).bit_length()))])
    # beyond the last point ``get`` is null, so the step is not taken
    return F.aggregate(steps, F.lit(0), lambda at, step: F.when(F.get(known, at + step - 1) <= F.col(key), at + step).otherwise(at))


def rows_per_range(keys: DataFrame, points: list[str], key: str = "row_key") -> dict[int, int]:
    """Rows per range that has any: at most one small row per range for the driver."""
    counts = keys.select(range_of(key, points).alias("r")).groupBy("r").agg(F.count(F.lit(1)).alias("n"))
    return {r.r: r.n for r in counts.collect()}


def new_points(keys: DataFrame, points: list[str], counts: dict[int, int], most: int = ROWS_PER_RANGE, key: str = "row_key") -> list[str]:
    """Points that cut the ranges with more than ``most`` rows into even parts, as far as distinct keys allow."""
    full = {r: n for r, n in counts.items() if n > most}
    if not full:
        return []
    parts = min(sum(-(-n // most) for n in full.values()), NEW_POINTS)
    every = max(1, sum(full.values()) // (parts * SAMPLED_KEYS))
    hot = keys.select(F.col(key).alias("k"), range_of(key, points).alias("r")).where(F.col("k").isNotNull())
    marked = F.get(_literal([int(r in full) for r in range(len(points) + 1)], "int"), F.col("r")) == 1

    def starts(sample: DataFrame) -> list[str]:
        least = sample.distinct().repartitionByRange(parts, "k").groupBy(F.spark_partition_id()).agg(F.min("k").alias("k")).collect()
        return sorted(set(sorted(row.k for row in least)[1:]) - set(points))  # the first part needs no point of its own
    held = hot.where(marked).select("k")
    found = starts(held.where(F.pmod(F.xxhash64("k"), F.lit(every)) == 0))
    if not found and every > 1:  # few keys that repeat very often: the sample may miss them
        found = starts(held)
    return found


def aligned(df: DataFrame, points: list[str], counts: dict[int, int], key: str = "row_key") -> DataFrame:
    """``df`` with a column ``_task``: one task per range that has rows, in key order. Grouping by (``_task``, key) needs no other exchange."""
    task, n = [0] * (len(points) + 1), 0
    for r in sorted(counts):
        task[r], n = n, n + 1
    tagged = df.withColumn(TASK, F.get(_literal(task, "int"), range_of(key, points)))
    return tagged.repartitionById(max(n, 1), TASK)


def split_and_align(df: DataFrame, points: list[str], most: int = ROWS_PER_RANGE, key: str = "row_key") -> tuple[DataFrame, list[str]]:
    """The rows by range of the table, and the points that this batch adds. ``df`` is read up to three times and should lie on disk."""
    counts = rows_per_range(df.select(key), points, key)
    added = new_points(df.select(key), points, counts, most, key)
    if added:
        points = sorted({*points, *added})
        counts = rows_per_range(df.select(key), points, key)
    return aligned(df, points, counts, key), added
