"""Wide-column data as a cell table: (row_key, family, qualifier, ts, seq, value).

A read returns the latest version of each cell, ordered by (ts, seq) with the
value as the last tie-breaker, so every read is deterministic. Two writers that
use the same (ts, seq) for one row key can therefore leave a mix of their cells:
batches must not share a (ts, seq), and a batch holds one row per key. Range and time
filters are applied to the raw versions first (they reach the Parquet scan as
pushed filters), then versions are resolved.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import FILLS
from ..schema import CELL_COLS, CELL_ID
from ..sources.tables import scan_tasks
from .lookup import measure


def unpivot(df: DataFrame, cols: list[str], family: str, key: str = "row_key",
            fill: str | None = None) -> DataFrame:
    """Wide rows -> (row_key, family, qualifier, value), one cell per listed column.

    NULLs are kept unless ``fill`` ('-1' or 'null') replaces blanks, as the
    loads do before storing.
    """
    cells = (df.select(key, *cols)
             .unpivot([key], cols, "qualifier", "value")
             .withColumn("family", F.lit(family)))
    if fill is not None:
        cells = cells.withColumn("value", FILLS[fill](F.col("value")))
    return cells.select(F.col(key).alias("row_key"), "family", "qualifier", "value")


#: A key batch of up to so many keys is broadcast to the cell scan.
MULTI_GET_BROADCAST_KEYS = 200_000
#: A key batch of up to so many keys is also given to the scan as a list (``spark.sql.parquet.pushdown.inFilterThreshold`` lets
#: Parquet look for each of them in the statistics of row groups and pages).
MULTI_GET_LISTED_KEYS = 200


def ts_lit(v) -> Column:
    """A wall-clock timestamp literal (no time-zone conversion on any session)."""
    if isinstance(v, Column):
        return v.cast("timestamp_ntz")
    if isinstance(v, dt.datetime):
        v = v.isoformat(sep=" ")
    return F.lit(str(v)).cast("timestamp_ntz")


def stamp(cells: DataFrame, ts: dt.datetime | Column, seq: int | Column = 0) -> DataFrame:
    """Give a cell batch its write timestamp and sequence number."""
    seq_col = seq if isinstance(seq, Column) else F.lit(seq)
    return cells.withColumns({"ts": ts_lit(ts), "seq": seq_col.cast("bigint")}).select(*CELL_COLS)


def _winner() -> Column:
    return F.max(F.struct("ts", "seq", "value")).alias("_w")


def latest(cells: DataFrame, within: str | None = None) -> DataFrame:
    """Latest version per (row_key, family, qualifier); partial aggregation runs map-side.

    Cells already partitioned by a column ``within`` that the row key determines are not shuffled again.
    """
    return (cells.groupBy(*([within] if within else []), *CELL_ID).agg(_winner())
            .select(*CELL_ID, "_w.ts", "_w.seq", "_w.value"))


#: Cells of one row that lie beside each other and share their write stamp.
RUN_SCHEMA = "row_key string, family string, ts timestamp_ntz, seq bigint, qualifier array<string>, value array<string>"


def _differs(batch: pa.RecordBatch, cols: list[str]) -> np.ndarray:
    """Per row, whether any of the columns differs from the row before (the first row does; so does a null from anything)."""
    new = np.ones(batch.num_rows, dtype=bool)
    if batch.num_rows > 1:
        new[1:] = False
        for c in cols:
            a = batch.column(c)
            new[1:] |= np.asarray(pc.fill_null(pc.not_equal(a.slice(1), a.slice(0, len(a) - 1)), True))
    return new


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stored cells -> runs. Of versions of one cell that lie beside each other only the latest stays."""
    for b in batches:
        if not b.num_rows:
            continue
        if not _differs(b, CELL_ID).all():
            b = b.take(pc.sort_indices(b, [(c, "ascending") for c in [*CELL_ID, "ts", "seq", "value"]], null_placement="at_start"))
            b = b.filter(pa.array(np.append(_differs(b, CELL_ID)[1:], True)))
        starts = np.flatnonzero(_differs(b, ["row_key", "family", "ts", "seq"]))
        offsets, firsts = pa.array(np.append(starts, b.num_rows), pa.int32()), b.take(pa.array(starts))
        yield pa.RecordBatch.from_arrays(
            [*[firsts.column(c) for c in ("row_key", "family", "ts", "seq")],
             *[pa.ListArray.from_arrays(offsets, b.column(c)) for c in ("qualifier", "value")]],
            ["row_key", "family", "ts", "seq", "qualifier", "value"])


#: Stored bytes of cells (a few per cell) that one task behind the exchange of ``latest_by_row`` is given.
STORED_BYTES_PER_TASK = 4 * 1024 * 1024
#: More tasks than any stored table needs: Spark takes an input of unknown size for an endless one.
UNKNOWN_SIZE_TASKS = 1_000_000


def latest_by_row(cells: DataFrame, pack: bool = True) -> DataFrame:
    """``latest`` for stored batches of rows with few cells each, as the loads write them: exchanged by row_key alone.

    The files hold the cells of a row beside each other, and so they stay in the exchange, where their common parts compress.
    With ``pack`` each task first puts a row's cells into one row with arrays (key and stamp once, not once per cell): least
    shuffled bytes for more CPU time. Versions are resolved cell by cell behind the exchange, with no other one and one sort; its tasks
    follow the stored bytes, so a sort fits in memory at any size. Any order of the cells gives the same result. All cells of
    a row meet in one task: rows with a great many qualifiers are for ``latest``.
    """
    cells = cells.select(*CELL_COLS)
    spark, tasks = cells.sparkSession, scan_tasks(cells, STORED_BYTES_PER_TASK)
    if tasks > UNKNOWN_SIZE_TASKS:
        tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    tasks = max(spark.sparkContext.defaultParallelism, tasks)
    if pack:
        runs = cells.mapInArrow(_runs, RUN_SCHEMA).repartition(tasks, "row_key")
        return latest(runs.select("row_key", "family", "ts", "seq", F.inline(F.arrays_zip("qualifier", "value"))))
    return latest(cells.repartition(tasks, "row_key"))


#: A long has so many bits besides its sign: one for each name of a cell.
NAMED_CELLS = 63


def latest_of_repeated(cells: DataFrame) -> DataFrame:
    """``latest`` for stored cells of rows most of which were written once: only rows that may hold a cell twice are exchanged and resolved.

    One pass takes, by a hash of the row key, the number of cells and a bit for each name (family and qualifier) among them. Rows with as many
    bits as cells hold each cell once and stay where they are; rows that share a hash count as one, so they are merely resolved too. The pass exchanges one
    small row per key and task. With more than ``NAMED_CELLS`` names, or more such rows than may be broadcast, all rows go to ``latest_by_row``.
    """
    cells = cells.select(*CELL_COLS)
    names = cells.select("family", "qualifier").distinct().limit(NAMED_CELLS + 1).collect()
    if len(names) > NAMED_CELLS:
        return latest_by_row(cells)
    bit = F.lit(0).cast("bigint")
    for i, n in enumerate(names):
        bit = F.when(F.col("family").eqNullSafe(n["family"]) & F.col("qualifier").eqNullSafe(n["qualifier"]), F.lit(1 << i)).otherwise(bit)
    hashed = cells.withColumn("_hash", F.xxhash64("row_key"))
    held = hashed.groupBy("_hash").agg(F.count(F.lit(1)).alias("_n"), F.bit_or(bit).alias("_names"))
    often, few = measure(held.where(F.bit_count("_names") < F.col("_n")).select("_hash"))
    if not few:
        return latest_by_row(cells)
    if often.isEmpty():
        return cells
    return (hashed.join(F.broadcast(often), "_hash", "left_anti").select(*CELL_COLS)
            .unionByName(latest(hashed.join(F.broadcast(often), "_hash", "left_semi").select(*CELL_COLS))))


def scan(cells: DataFrame, start: str | None = None, stop: str | None = None,
         ts_from=None, ts_to=None, at_ts=None, families: list[str] | None = None,
         qualifiers: list[str] | None = None) -> DataFrame:
    """Key range [start, stop), time range [ts_from, ts_to), exact timestamp and
    family/qualifier selection on raw versions, then the latest of what is left."""
    return latest(select_versions(cells, start, stop, ts_from, ts_to, at_ts, families, qualifiers))


def select_versions(cells, start=None, stop=None, ts_from=None, ts_to=None, at_ts=None,
                    families=None, qualifiers=None) -> DataFrame:
    cond = F.lit(True)
    if start is not None:
        cond = cond & (F.col("row_key") >= F.lit(start))
    if stop is not None:
        cond = cond & (F.col("row_key") < F.lit(stop))
    if ts_from is not None:
        cond = cond & (F.col("ts") >= _ts(ts_from))
    if ts_to is not None:
        cond = cond & (F.col("ts") < _ts(ts_to))
    if at_ts is not None:
        cond = cond & (F.col("ts") == _ts(at_ts))
    if families:
        cond = cond & F.col("family").isin(*families)
    if qualifiers:
        cond = cond & F.col("qualifier").isin(*qualifiers)
    return cells.filter(cond)


def _ts(v) -> Column:
    return v if isinstance(v, Column) else ts_lit(v)


def to_wide(cells: DataFrame, family: str, names: list[str], one_scan: bool = False) -> DataFrame:
    """Cells -> row_key + one column per name (latest value, NULL when absent).

    One aggregation grouped by row_key only, over two scans: the named cells
    (family and qualifiers pruned at the scan, all columns) and the bare row
    keys of the whole table, so that a row with none of the names appears too.
    The latest version of each named cell is picked inside the same pass (no
    separate version step, no join). ``one_scan`` reads everything once instead: for
    bucketed tables, whose grouping by row_key then needs no shuffle.
    """
    if one_scan:
        aggs = [F.max(F.when((F.col("family") == family) & (F.col("qualifier") == n), F.struct("ts", "seq", "value"))).alias(f"_w{i}")
                for i, n in enumerate(names)]
        return (cells.groupBy("row_key").agg(*aggs)
                .select("row_key", *[F.col(f"_w{i}.value").alias(n) for i, n in enumerate(names)]))
    named = (select_versions(cells, families=[family], qualifiers=names)
             .select("row_key", "qualifier", F.struct("ts", "seq", "value").alias("_v")))
    bare = cells.select("row_key", F.lit(None).cast("string").alias("qualifier"),
                        F.lit(None).cast(named.schema["_v"].dataType).alias("_v"))
    aggs = [F.max(F.when(F.col("qualifier") == n, F.col("_v"))).alias(f"_w{i}") for i, n in enumerate(names)]
    return (named.unionByName(bare).groupBy("row_key").agg(*aggs)
            .select("row_key", *[F.col(f"_w{i}.value").alias(n) for i, n in enumerate(names)]))


def family_cells(cells: DataFrame, family: str) -> DataFrame:
    """The latest cells of one family: whatever qualifiers each row has there."""
    return scan(cells, families=[family]).select("row_key", "qualifier", "value")


def qualifiers_per_row(cells: DataFrame, family: str) -> DataFrame:
    """(row_key, qualifier) for every qualifier present in a row of one family.

    Long form on purpose: a wide row may hold any number of qualifiers, so they
    are never gathered into one value per row.
    """
    return cells.filter(F.col("family") == family).select("row_key", "qualifier").distinct()


def qualifiers_for_keys(cells: DataFrame, keys: DataFrame, family: str, key: str = "row_key") -> DataFrame:
    """Qualifiers present for the given row keys (a batch of column listings)."""
    k = keys.select(F.col(key).alias("row_key")).distinct()
    return qualifiers_per_row(cells, family).join(k, "row_key", "left_semi")


def count_rows(cells: DataFrame) -> DataFrame:
    """Number of row keys (not cells); two-phase distinct count. A null key is not counted.

    On a bucketed table each task counts the keys of its own buckets and only these counts are exchanged.
    """
    return cells.agg(F.count_distinct("row_key").alias("n_rows"))


def partition_profile(df: DataFrame) -> DataFrame:
    """``(partition, n)``: the rows of each partition that has any."""
    return df.groupBy(F.spark_partition_id().alias("partition")).agg(F.count(F.lit(1)).alias("n"))


def multi_get(cells: DataFrame, keys: DataFrame, family: str, qualifier: str,
              key: str = "row_key") -> DataFrame:
    """A batch of point reads: every key row with the latest value of one cell (NULL if absent).

    The batch's smallest and greatest key bound the cell scan (pushed to the
    files, with the keys themselves if they are few), and a semi-join with the distinct keys leaves only wanted versions
    before anything is shuffled or aggregated. The keys are broadcast behind a
    check of their number; a larger batch is joined by shuffle.
    """
    wanted = keys.select(F.col(key).alias("row_key")).where("row_key IS NOT NULL").distinct()
    n, low, high = wanted.agg(F.count(F.lit(1)), F.min("row_key"), F.max("row_key")).first()
    found = select_versions(cells, start=low, families=[family], qualifiers=[qualifier])
    if high is not None:
        found = found.filter(F.col("row_key") <= F.lit(high))
    if 0 < n <= MULTI_GET_LISTED_KEYS:
        found = found.filter(F.col("row_key").isin([r.row_key for r in wanted.collect()]))
    hit = (found.join(F.broadcast(wanted) if n <= MULTI_GET_BROADCAST_KEYS else wanted, "row_key", "left_semi")
           .groupBy("row_key").agg(F.max(F.struct("ts", "seq", "value")).alias("_w"))
           .select(F.col("row_key").alias(key), F.col("_w.value").alias("value")))
    return keys.join(hit, on=key, how="left")
