"""Table scans: catalogue tables or Parquet paths, projected to fixed columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import DETAIL_COLS, HEADER_COLS


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A base table of the test data set (one Parquet file per table)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Spread a scan that yields fewer partitions than the cluster can run at once.

    The source jobs reshuffle right after reading (a fixed 400-way shuffle);
    here it happens only when needed: a big table split into thousands of
    files is left alone, a small or single file (one task) is spread round-robin
    over the default parallelism. The number of tasks is taken from the planner's
    size estimate, so nothing runs to find it out.
    """
    spark = df.sparkSession
    target = min_partitions or spark.sparkContext.defaultParallelism
    return df.repartition(target) if scan_tasks(df) < target else df


def scan_tasks(df: DataFrame, split: int | None = None) -> int:
    """About how many tasks a plan's input splits into, from its estimated bytes (by default as Spark splits files)."""
    spark = df.sparkSession
    n_bytes = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    split = split or spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    return -(-n_bytes // split)


def open_table(spark: SparkSession, table: str | DataFrame) -> DataFrame:
    """A catalogue table name, a Parquet path, or an existing DataFrame."""
    if isinstance(table, DataFrame):
        return table
    if "/" in table:
        return spark.read.parquet(table)
    return spark.table(table)


def as_strings(df: DataFrame, cols: list[str]) -> DataFrame:
    """Fixed column list, every column cast to STRING (a missing column fails at analysis)."""
    return df.select([F.col(c).cast("string").alias(c) for c in cols])


def scan_header(spark: SparkSession, table: str | DataFrame) -> DataFrame:
    """The 21 invoice-header columns as strings; pruned at the Parquet scan."""
    return as_strings(open_table(spark, table), HEADER_COLS)


def scan_detail(spark: SparkSession, table: str | DataFrame) -> DataFrame:
    """The 16 invoice-line columns as strings."""
    return as_strings(open_table(spark, table), DETAIL_COLS)
