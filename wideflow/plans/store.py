"""Load and sync jobs that write cell tables.

* ``load_header`` / ``load_detail``: accepted rows, one per key -> cells -> one
  new batch (key-sorted bulk layout or plain Put-style), rejects to their own folder.
* ``sync_tables``: copy the latest cells of a source table (key range or time
  range) into a target table as a new batch; ``sync_new`` copies what no earlier run has copied.
* ``multi_get_stored`` / ``scan_stored``: reads that open only the files that may hold what they ask for.
* ``compact`` / ``compact_ranges``: rewrite the latest view of a table, or of its overlapping files only.

Wide rows, not cells, are exchanged (once, on row_key), de-duplicated and sorted
there, and unpivoted in qualifier order, so cells leave each task sorted. A plan
that is read more than once (range sampling and write, or write and rejects) is
written to the shared work folder first and removed after the load; nothing
is cached on executors.
"""

from __future__ import annotations

import datetime as dt
import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.cells import latest, multi_get, scan, select_versions, stamp, unpivot
from ..operators.merge import dedupe_rows, dedupe_stored, restamp, settle_hot_keys
from ..schema import CELL_ID, DETAIL_COLS, DETAIL_FAMILY, HEADER_FAMILY, HEADER_STORED_COLS
from ..session import fresh_path, remove_path
from ..sinks import bounds, live, ranges
from ..sinks.files import by_key_range, new_batch, read_cells, replace_batch, write_cells, write_family_batch
from . import loads

#: ``bulk``: files of a batch sorted by key, in disjoint key ranges. ``aligned``: the same, cut at the table's own split points, which all its
#: aligned batches share. ``put``: no range exchange.
LAYOUTS = ("bulk", "put", "aligned")


@dataclass(frozen=True)
class LoadCounts:
    """What a load did with its input rows, counted while they were written."""

    rows: int
    accepted: int
    rejected: dict[str, int]


def now_utc() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


def batch_seq() -> int:
    return time.time_ns() // 1000


def _within(df: DataFrame) -> str | None:
    return bounds.TASK if bounds.TASK in df.columns else None


def header_rows_lww(rows: DataFrame) -> DataFrame:
    """Header rows, one per key: colliding invoices resolve to one whole invoice, the greatest value tuple."""
    return dedupe_rows(rows, "row_key", HEADER_STORED_COLS, _within(rows))


def detail_rows_lww(rows: DataFrame) -> DataFrame:
    """Line rows, one per key: same-key writes in one batch resolve to the greatest value tuple."""
    return dedupe_rows(rows, "row_key", DETAIL_COLS, _within(rows))


def header_cells(rows: DataFrame, fill: str = "-1", work: str | None = None) -> DataFrame:
    """Accepted header rows -> 24 cells per key in family fpxx, in qualifier order. Rows on disk are de-duplicated with a folder ``work``."""
    rows = dedupe_stored(rows, "row_key", HEADER_STORED_COLS, work) if work else header_rows_lww(rows)
    return unpivot(rows, sorted(HEADER_STORED_COLS), HEADER_FAMILY, fill=fill)


def detail_cells(rows: DataFrame, fill: str = "-1", work: str | None = None) -> DataFrame:
    rows = dedupe_stored(rows, "row_key", DETAIL_COLS, work) if work else detail_rows_lww(rows)
    return unpivot(rows.select("row_key", *DETAIL_COLS), sorted(DETAIL_COLS), DETAIL_FAMILY, fill=fill)


def _arranged(df: DataFrame, layout: str, num_partitions: int | None, table_path: str,
              rows_per_range: int | None = None) -> tuple[DataFrame, list[str]]:
    """By key range for the bulk layout; by the table's ranges for the aligned one, with the split points that the batch adds;
    by hash into the caller's number of tasks, if given, for Put-style."""
    if layout not in LAYOUTS:
        raise ValueError(f"unknown layout {layout!r}")
    if layout == "aligned":
        if num_partitions:
            raise ValueError("the aligned layout has one task per range: give rows_per_range instead of num_partitions")
        return bounds.split_and_align(df, live.points(df.sparkSession, table_path), rows_per_range or bounds.ROWS_PER_RANGE)
    if layout == "bulk":
        return by_key_range(df, num_partitions), []
    return (df.repartition(num_partitions, "row_key") if num_partitions else df), []


def _load(tagged: DataFrame, to_cells, order_cols: list[str], family: str, table_path: str, rejects_path: str | None, layout: str,
          run_ts, seq, replace: bool, num_partitions, max_records_per_file, batch: str | None, rows_per_range: int | None,
          counted: bool, staged: bool = False, after_staging: Callable[[], None] | None = None) -> LoadCounts | None:
    spark = tagged.sparkSession
    run_ts = run_ts or now_utc()
    seq = batch_seq() if seq is None else seq
    batch = batch or f"b{seq}"
    exchanged = layout != "put" or bool(num_partitions)  # before the rows are de-duplicated
    kept = fresh_path(spark, "tagged") if rejects_path or exchanged or counted or staged else None
    work = fresh_path(spark, "repeated") if staged and not exchanged else None
    counts = None
    if kept:
        watched, observation = loads.observed(tagged)
        watched.write.option("compression", "zstd").parquet(kept)
        got = observation.get
        counts = LoadCounts(got["rows"], got["accepted"], {r: got[r] for r in loads.REASONS if got[r]})
        tagged = spark.read.schema(tagged.schema).parquet(kept)
        if after_staging:
            after_staging()
    accepted = loads.accepted(tagged)
    rows, points = _arranged(settle_hot_keys(accepted, "row_key", order_cols) if exchanged else accepted, layout, num_partitions,
                             table_path, rows_per_range)
    write_family_batch(stamp(to_cells(rows, work=work), run_ts, seq), table_path, family, batch, replace, max_records_per_file,
                       live.Change(points=points) if points else None)
    if rejects_path:
        (loads.rejected(tagged).write.mode("overwrite" if replace else "errorifexists")
         .option("partitionOverwriteMode", "static").parquet(f"{rejects_path}/batch={batch}"))
    for folder in filter(None, (kept, work)):
        remove_path(spark, folder)
    return counts


def load_header(header: DataFrame, by_name: DataFrame, by_tax: DataFrame, year: str,
                table_path: str, rejects_path: str | None = None, layout: str = "bulk",
                fill: str | None = None, mode: str = "compat", run_ts=None, seq=None, replace: bool = False,
                num_partitions=None, max_records_per_file=None, batch: str | None = None, rows_per_range: int | None = None,
                counted: bool = False) -> LoadCounts | None:
    """Header load. Bulk and aligned layouts store blanks as '-1', Put-style as 'null' (unless ``fill``).

    A rerun with the same ``run_ts``, ``seq`` and ``batch`` name (by default from ``seq``) and with ``replace``
    replaces its own batch (cells and rejects) and leaves all others alone. Returns the input's rows by outcome
    wherever they are staged before the write, which they always are with ``counted``; else None.
    """
    fill = fill or ("null" if layout == "put" else "-1")
    tagged = loads.tag_header(header, by_name, by_tax, year, mode)
    return _load(tagged, lambda rows, work: header_cells(rows, fill, work), HEADER_STORED_COLS, HEADER_FAMILY, table_path, rejects_path, layout,
                 run_ts, seq, replace, num_partitions, max_records_per_file, batch, rows_per_range, counted)


def load_detail(detail: DataFrame, by_tax: DataFrame, table_path: str, rejects_path: str | None = None,
                layout: str = "put", mode: str = "compat", run_ts=None, seq=None, replace: bool = False,
                num_partitions=None, max_records_per_file=None, batch: str | None = None, rows_per_range: int | None = None,
                counted: bool = False, staged: bool = False, after_staging: Callable[[], None] | None = None) -> LoadCounts | None:
    """Line load; see ``load_header``. A Put-style load with ``staged`` writes its tagged rows first and then exchanges only those
    whose keys come more than once: much less disk for its shuffles where most come once. The input is not read after ``after_staging()``."""
    tagged = loads.tag_detail(detail, by_tax, mode)
    return _load(tagged, detail_cells, DETAIL_COLS, DETAIL_FAMILY, table_path, rejects_path, layout, run_ts, seq, replace,
                 num_partitions, max_records_per_file, batch, rows_per_range, counted, staged, after_staging)


def sync_cells(source: DataFrame, target_path: str, run_ts=None, ts_policy: str = "write_time",
               family: str | None = None, start=None, stop=None, ts_from=None, ts_to=None,
               layout: str = "bulk", num_partitions=None, max_records_per_file=None, batch: str | None = None,
               rows_per_range: int | None = None) -> None:
    """Merge source cells (any cell DataFrame) into the target table as one new batch.

    Only the latest source cell per id in the scan range travels; readers of
    the target resolve versions, so the target is never rewritten. The selected
    versions are exchanged by row_key once; resolving them needs no other exchange.
    """
    versions = select_versions(source, start, stop, ts_from, ts_to, families=[family] if family else None)
    arranged, points = _arranged(versions, layout, num_partitions, target_path, rows_per_range)
    cells = restamp(latest(arranged, _within(arranged)), run_ts or now_utc(), ts_policy)
    change = live.Change(points=points) if points else None
    if family:
        write_family_batch(cells.sortWithinPartitions("row_key", "qualifier"), target_path, family, batch or new_batch(),
                           bool(batch), max_records_per_file, change)
    elif change:
        replace_batch(cells, target_path, batch or new_batch(), lambda f: batch is not None and live.batch_of(f) == batch,
                      max_records_per_file, change)
    else:
        write_cells(cells, target_path, max_records_per_file=max_records_per_file, batch=batch)


def sync_tables(spark: SparkSession, source_path: str, target_path: str, **kw) -> None:
    """Key-range or time-range sync between two stored cell tables."""
    sync_cells(read_cells(spark, source_path), target_path, **kw)


def compact(spark: SparkSession, source_path: str, target_path: str | None = None, num_partitions=None,
            max_records_per_file=None, layout: str = "bulk", rows_per_range: int | None = None) -> None:
    """Rewrite the latest version of every cell in bulk (or aligned) layout: into a new table, or in place.

    In place, the new batch and the end of the batches it was made of become visible at once; batches that were
    published meanwhile stay as they are. If a batch that was read is replaced meanwhile, ``live.Replaced`` is raised.
    """
    if target_path in (None, source_path):
        live.begin(spark, source_path)
        read = live.live(spark, source_path)
        rows, points = _arranged(read_cells(spark, source_path, read), layout, num_partitions, source_path, rows_per_range)
        replace_batch(latest(rows, _within(rows)), source_path, new_batch(), set(read).__contains__, max_records_per_file,
                      live.Change(made_of=read, points=points))
    else:
        if live.live(spark, target_path) is not None:
            raise FileExistsError(target_path)
        rows, points = _arranged(read_cells(spark, source_path), layout, num_partitions, target_path, rows_per_range)
        replace_batch(latest(rows, _within(rows)), target_path, new_batch(), lambda f: False, max_records_per_file, live.Change(points=points))


def compact_ranges(spark: SparkSession, path: str, depth: int = 8, num_partitions=None, max_records_per_file=None) -> list[str]:
    """Rewrite, in bulk layout, only the files that may hold a key which more than ``depth`` files of their family may hold.

    All other files stay as they are. Returns the files that were rewritten. As after ``compact``, of the rewritten files only the latest
    versions remain.
    """
    rows = ranges.file_ranges(spark, path)
    deep = set((r.entry, r.file) for r in ranges.too_deep(rows, depth).select("entry", "file").collect())
    if not deep:
        return []
    files = sorted(f"{live.folder_of(e)}/{f}" for e, f in deep)
    parts: dict[str, list[str]] = {e: [] for e, _ in deep}
    for r in rows.select("entry", "file").collect():
        if r.entry in parts and (r.entry, r.file) not in deep:
            parts[r.entry].append(f"{live.folder_of(r.entry)}/{r.file}")
    cells = latest(by_key_range(read_cells(spark, path, files), num_partitions))
    replace_batch(cells, path, new_batch(), lambda f: False, max_records_per_file, live.Change(sorted(parts), parts))
    return files


def multi_get_stored(spark: SparkSession, path: str, keys: DataFrame, family: str, qualifier: str, key: str = "row_key") -> DataFrame:
    """``operators.cells.multi_get`` on the files whose key ranges hold some of the keys."""
    files = ranges.choose(spark, path, keys, key, families=[family])
    return multi_get(read_cells(spark, path, files), keys, family, qualifier, key)


def scan_stored(spark: SparkSession, path: str, start=None, stop=None, ts_from=None, ts_to=None, families=None, qualifiers=None) -> DataFrame:
    """``operators.cells.scan`` on the files whose key and time ranges meet the asked ones."""
    files = ranges.choose(spark, path, start=start, stop=stop, ts_from=ts_from, ts_to=ts_to, families=families)
    return scan(read_cells(spark, path, files), start, stop, ts_from, ts_to, families=families, qualifiers=qualifiers)


def sync_new(spark: SparkSession, source_path: str, target_path: str, run_ts=None, ts_policy: str = "write_time",
             num_partitions=None, max_records_per_file=None) -> list[str]:
    """Copy into the target what the source got since the last such run; returns the source's entries that were new.

    The target's pointer names the source folders that were copied and changes together with the copied batch, so a killed run
    is done again and a finished one is not, whatever time stamps its cells have. A cell is copied if its latest version in
    the whole source lies in a new folder: a late batch does not bring older values back. Folders that a compaction made
    of copied ones are not new; one made of copied and other folders is copied whole.
    """
    live.begin(spark, source_path)
    live.begin(spark, target_path)
    entries, made = live.live(spark, source_path), live.lineage(spark, source_path)
    before = set(live.synced(spark, target_path, source_path))

    def known(entry: str) -> bool:
        folder = live.folder_of(entry)
        return folder in before or (folder in made and set(made[folder]) <= before)
    new = [e for e in entries if not known(e)]
    if not new:
        return []
    fresh = read_cells(spark, source_path, new)
    others = ranges.choose(spark, source_path, keys=fresh, entries=[e for e in entries if known(e)])
    old = read_cells(spark, source_path, others)
    old = old.join(fresh.select(*CELL_ID).distinct(), CELL_ID, "left_semi")
    both = fresh.withColumn("_old", F.lit(False)).unionByName(old.withColumn("_old", F.lit(True)))
    winners = (both.groupBy(*CELL_ID).agg(F.max(F.struct("ts", "seq", "value", "_old")).alias("_w"))
               .where("NOT _w._old").select(*CELL_ID, "_w.ts", "_w.seq", "_w.value"))
    cells = restamp(by_key_range(winners, num_partitions), run_ts or now_utc(), ts_policy)
    seen = set(map(live.folder_of, entries))
    seen |= {x for f in seen for x in made.get(f, [])}
    replace_batch(cells, target_path, new_batch(), lambda f: False, max_records_per_file,
                  live.Change(copied={source_path: sorted(seen)}))
    return new
