"""Writers: cell-table batches (plain or key-sorted bulk layout), CSV, text, previews.

A cell table is a Parquet folder partitioned by ``family`` and then by
``batch``, one folder per write; a pointer file names the live ones
(``sinks.live``), so a write becomes visible whole, when it is published, and a
write that is repeated under the same batch name replaces its own batch only.
Reads resolve versions (``operators.cells.latest``).
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import CELL_COLS, CELL_SCHEMA
from . import live

SORT_KEY = ["family", "row_key", "qualifier"]


def new_batch() -> str:
    return "b" + uuid.uuid4().hex[:16]


def _capped(writer, max_records_per_file: int | None):
    return writer.option("maxRecordsPerFile", max_records_per_file) if max_records_per_file else writer


def write_cells(cells: DataFrame, path: str, mode: str = "append",
                max_records_per_file: int | None = None, batch: str | None = None) -> None:
    """Append a cell batch without moving rows between tasks.

    The family-partitioned writer sorts each task's rows by family anyway;
    sorting by (family, row_key, qualifier) instead costs little more and gives
    every file tight row-key min/max statistics for key-range pruning. With a
    ``batch`` name the write replaces an earlier one of that name. With the mode
    ``errorifexists`` the table must be new.
    """
    spark = cells.sparkSession
    if mode == "errorifexists" and live.live(spark, path) is not None:
        raise FileExistsError(path)
    replace_batch(cells, path, batch or new_batch(), lambda f: batch is not None and live.batch_of(f) == batch, max_records_per_file)


def replace_batch(cells: DataFrame, path: str, batch: str, gone, max_records_per_file: int | None = None,
                  change: live.Change | None = None) -> None:
    """Write a batch of any families and publish it in place of the live folders that are ``gone``.

    It is written to a folder of its own first: Spark's commit clears the work area of the folder it writes to, also that of
    other writers. Its family folders are then moved to their places, where no reader sees them before they are published.
    """
    spark, own = cells.sparkSession, live.attempt(batch)
    live.begin(spark, path)
    staged = f"{path}/{live.STAGED}/{own}"
    w = cells.select(*CELL_COLS).sortWithinPartitions(*SORT_KEY).write.partitionBy("family")
    _capped(w, max_records_per_file).parquet(staged)
    live.place(spark, path, staged, own)
    live.publish(spark, path, own, gone, *([change] if change else []))


def write_family_batch(cells: DataFrame, path: str, family: str, batch: str, replace: bool = False,
                       max_records_per_file: int | None = None, change: live.Change | None = None) -> None:
    """Write cells of one family, already sorted by (row_key, qualifier) in each task, as they come.

    They go straight to the batch's folder, so the writer adds no sort of its own.
    """
    spark, own = cells.sparkSession, live.attempt(batch)

    def earlier(folder: str) -> bool:
        return folder.startswith(f"family={family}/") and live.batch_of(folder) == batch
    live.begin(spark, path)
    if not replace and any(map(earlier, live.live(spark, path))):
        raise FileExistsError(f"{path}: batch {batch} of family {family}")
    w = cells.select(*[c for c in CELL_COLS if c != "family"]).write.option("compression", "zstd")
    _capped(w, max_records_per_file).parquet(f"{path}/family={family}/batch={own}")
    live.publish(spark, path, own, earlier, *([change] if change else []))


def by_key_range(df: DataFrame, num_partitions: int | None = None) -> DataFrame:
    """A range exchange on row_key - Spark samples the keys to pick balanced bounds.

    All rows of one key stay in one task, like a region. Without
    ``num_partitions`` AQE may merge small neighbouring ranges.
    """
    return (df.repartitionByRange(num_partitions, "row_key") if num_partitions
            else df.repartitionByRange("row_key"))


def write_cells_sorted(cells: DataFrame, path: str, mode: str = "append",
                       num_partitions: int | None = None,
                       max_records_per_file: int | None = None) -> None:
    """Bulk layout of any cells: files sorted by key, with disjoint key ranges."""
    write_cells(by_key_range(cells, num_partitions), path, mode, max_records_per_file)


def read_cells(spark: SparkSession, path: str, folders: list[str] | None = None) -> DataFrame:
    """All stored versions of the live batches (or of the given folders or files); family is a partition column (pruned by family filters)."""
    folders = live.live(spark, path) if folders is None else folders
    if folders == []:
        return spark.createDataFrame([], CELL_SCHEMA)
    reader = spark.read.schema(CELL_SCHEMA)
    found = reader.parquet(path) if folders is None else reader.option("basePath", path).parquet(*[f"{path}/{f}" for f in folders])
    return found.select(*CELL_COLS)


# CSV: '' and NULL are told apart only with explicit markers.
CSV_NULL = "__NULL__"
CSV_EMPTY = "__EMPTY__"


def write_csv(df: DataFrame, path: str, mode: str = "append", lossless: bool = True) -> None:
    w = df.write.mode(mode)
    if lossless:
        w = w.option("nullValue", CSV_NULL).option("emptyValue", CSV_EMPTY)
    w.csv(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType, lossless: bool = True) -> DataFrame:
    r = spark.read.schema(schema)
    if lossless:
        r = r.option("nullValue", CSV_NULL)
    df = r.csv(path)
    if lossless:
        df = df.select([F.when(F.col(f.name) == CSV_EMPTY, F.lit("")).otherwise(F.col(f.name)).alias(f.name)
                        if isinstance(f.dataType, T.StringType) else F.col(f.name) for f in schema.fields])
    return df


def write_text_lines(df: DataFrame, path: str, cols: list[str], sep: str = ",", mode: str = "append") -> None:
    """One text line per row: the listed columns joined by ``sep`` (NULLs skipped)."""
    df.select(F.concat_ws(sep, *[F.col(c) for c in cols]).alias("value")).write.mode(mode).text(path)


def preview(df: DataFrame, n: int, order: list[str]) -> DataFrame:
    """First ``n`` rows in key order (a top-n: a local top-k per task, then one merge)."""
    return df.orderBy(*order).limit(n)
