"""Cell tables as bucketed catalogue tables.

Written with ``bucketBy(n, row_key)`` and sorted by (row_key, family,
qualifier), a cell table tells the planner how its rows are laid out: version
resolution (grouped by row_key, family, qualifier), pivot to wide and multi-get
(grouped or joined by row_key) then run without any shuffle, and two tables
with the same bucket count join on row_key without one. Later appends add
files to the same buckets; the layout stays known.

The table data lives under the given path (the shared work folder on a
cluster); the catalogue only holds the definition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..schema import CELL_COLS

BUCKET_SORT = ["row_key", "family", "qualifier"]


def write_bucketed(cells: DataFrame, table: str, path: str, buckets: int, mode: str = "append") -> None:
    """Append a cell batch to a bucketed table (created on first write at ``path``).

    The batch is hash-partitioned on row_key into exactly ``buckets`` parts
    first - the same hash the bucket id uses - so each task writes one bucket
    and a batch adds one file per bucket, not one per task and bucket.
    """
    (cells.select(*CELL_COLS).repartition(buckets, "row_key")
     .write.mode(mode).format("parquet")
     .bucketBy(buckets, "row_key").sortBy(*BUCKET_SORT)
     .option("path", path).saveAsTable(table))


def read_bucketed(spark: SparkSession, table: str) -> DataFrame:
    return spark.table(table).select(*CELL_COLS)
