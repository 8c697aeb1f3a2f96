"""Key and time ranges of a cell table's files, so that a read opens only the files that may hold what it asks for.

One small row per file: ``(family, batch, file, low, high, ts_low, ts_high, n, keys)``, kept in ``_ranges`` beside the table; ``keys`` is a
sketch of the file's distinct row keys (HyperLogLog, some 4 KB), which merges to an estimate for any set of files. A file never
changes, so each folder is looked through once, over the columns ``row_key`` and ``ts`` alone, by the first read that asks
(``refresh``); readers that do so at once write equal rows. Rows of folders that are no longer live are passed over. An
index folder counts only when Spark's commit has marked it whole. The driver gets the names of the files to read and of the live
folders, as for every scan, and no keys.
"""

from __future__ import annotations

import uuid
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.cells import ts_lit
from ..schema import CELL_SCHEMA
from . import live

RANGES = "_ranges"
SCHEMA = ("family string, batch string, file string, low string, high string, ts_low timestamp_ntz, ts_high timestamp_ntz, n bigint, "
          "keys binary")
#: Registers of a file's key sketch (2 to this power): estimates have a relative standard error of 1.04 / sqrt(4096) = 1.6 %.
SKETCH_BITS = 12
#: A key batch is looked up in the files' ranges as at most so many ranges of its own.
KEY_RANGES = 1_000


def _named(entry: str) -> tuple[str | None, str, str | None]:
    """Family, batch and file (None: all files) of a pointer's entry."""
    family, batch, *file = entry.split("/", 2)
    family = unquote(family.removeprefix("family="))
    return (None if family == "__HIVE_DEFAULT_PARTITION__" else family), unquote(batch.removeprefix("batch=")), (file[0] if file else None)


def _stored(spark: SparkSession, table: str) -> DataFrame:
    whole = live._fs(spark, table).globStatus(live._path(spark, f"{table}/{RANGES}/*/_SUCCESS"))
    paths = [str(f.getPath().getParent()) for f in whole or []]
    rows = spark.read.schema(SCHEMA).parquet(*paths) if paths else spark.createDataFrame([], SCHEMA)
    return rows.where("keys IS NOT NULL")  # rows of an index without sketches are made anew


def refresh(spark: SparkSession, table: str) -> list[str]:
    """Looks through the live folders that were not yet; returns the table's live entries."""
    live.begin(spark, table)
    entries = live.live(spark, table)
    seen = {(r.family, r.batch) for r in _stored(spark, table).select("family", "batch").distinct().collect()}
    new = sorted({live.folder_of(e) for e in entries if _named(e)[:2] not in seen})
    if new:
        schema = T.StructType([*CELL_SCHEMA.fields, T.StructField("batch", T.StringType())])
        cells = spark.read.schema(schema).option("basePath", table).parquet(*[f"{table}/{f}" for f in new])
        (cells.groupBy("family", "batch", F.col("_metadata.file_name").alias("file"))
         .agg(F.min("row_key").alias("low"), F.max("row_key").alias("high"), F.min("ts").alias("ts_low"), F.max("ts").alias("ts_high"),
              F.count(F.lit(1)).alias("n"), F.hll_sketch_agg("row_key", SKETCH_BITS).alias("keys"))
         .write.parquet(f"{table}/{RANGES}/{uuid.uuid4().hex}"))
    return entries


def file_ranges(spark: SparkSession, table: str, entries: list[str] | None = None) -> DataFrame:
    """The rows of the live files (or of the given entries), with the ``entry`` that each belongs to. Empty files have none."""
    known = refresh(spark, table)
    entries = known if entries is None else entries
    named = spark.createDataFrame([(e, *_named(e)) for e in entries], "entry string, _f string, _b string, _file string")
    rows = _stored(spark, table).dropDuplicates(["family", "batch", "file"])
    mine = rows["family"].eqNullSafe(named["_f"]) & (rows["batch"] == named["_b"])
    return rows.join(named, mine & (named["_file"].isNull() | (named["_file"] == rows["file"]))).select("entry", *rows.columns)


def key_ranges(keys: DataFrame, key: str = "row_key") -> DataFrame:
    """At most ``KEY_RANGES`` disjoint ranges ``(key_low, key_high)`` that hold all keys: one per key, if there are fewer."""
    k = keys.select(F.col(key).alias("k")).where("k IS NOT NULL").distinct()
    return (k.repartitionByRange(KEY_RANGES, "k").groupBy(F.spark_partition_id())
            .agg(F.min("k").alias("key_low"), F.max("k").alias("key_high")).select("key_low", "key_high"))


def choose(spark: SparkSession, table: str, keys: DataFrame | None = None, key: str = "row_key", start: str | None = None,
           stop: str | None = None, ts_from=None, ts_to=None, families: list[str] | None = None,
           entries: list[str] | None = None) -> list[str]:
    """The live files (relative to the table) that may hold cells of the given keys, key range, time range and families.

    The keys are compared with the files' ranges as ``key_ranges``: a bounded list, broadcast.
    """
    rows = file_ranges(spark, table, entries)
    cond: Column = F.lit(True)
    if start is not None:
        cond = cond & (F.col("high") >= start)
    if stop is not None:
        cond = cond & (F.col("low") < stop)
    if ts_from is not None:
        cond = cond & (F.col("ts_high") >= ts_lit(ts_from))
    if ts_to is not None:
        cond = cond & (F.col("ts_low") < ts_lit(ts_to))
    if families:
        cond = cond & F.col("family").isin(*families)
    rows = rows.where(cond)
    if keys is not None:
        rows = rows.join(F.broadcast(key_ranges(keys, key)), F.expr("low <= key_high AND high >= key_low"), "left_semi")
    return sorted(f"{live.folder_of(r.entry)}/{r.file}" for r in rows.select("entry", "file").collect())


def too_deep(rows: DataFrame, depth: int) -> DataFrame:
    """Those of ``file_ranges`` that hold a key which more than ``depth`` files of their family may hold.

    A sweep over the ends of the key ranges, per family: how many ranges are open at each end, and where, from there on, the
    next place is that is covered too often. It sorts two small rows per file.
    """
    ends = rows.where("low IS NOT NULL").select("*", F.explode(F.array(
        F.struct(F.col("low").alias("at"), F.lit(0).alias("closes")), F.struct(F.col("high").alias("at"), F.lit(1).alias("closes")))).alias("_e"))
    order = Window.partitionBy("family").orderBy("_e.at", "_e.closes")
    opened = ends.withColumn("_open", F.sum(F.when(F.col("_e.closes") == 0, 1).otherwise(-1)).over(
        order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    hot = opened.withColumn("_hot", F.min(F.when(F.col("_open") > depth, F.col("_e.at"))).over(
        order.rowsBetween(Window.currentRow, Window.unboundedFollowing)))
    return hot.where("_e.closes = 0 AND _hot <= high").select(*rows.columns)


def estimate_rows(spark: SparkSession, table: str, families: list[str] | None = None) -> int:
    """The number of row keys of the live files, estimated from their sketches: no cell is read that a refresh has read before.

    Keys that several files hold count once. The relative standard error is 1.6 % (``SKETCH_BITS``).
    """
    rows = file_ranges(spark, table)
    if families:
        rows = rows.where(F.col("family").isin(*families))
    return rows.agg(F.hll_sketch_estimate(F.hll_union_agg("keys"))).first()[0] or 0
