"""Upserts and table merges on cell tables.

A merge is an upsert union: source cells replace target cells with the same
(row_key, family, qualifier); every other target cell stays; deletes do not
travel. By default source cells take the write time as their timestamp (as a
bulk load or Put does); ``ts_policy='source'`` keeps their own timestamps.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..schema import CELL_COLS
from .cells import latest, scan, ts_lit
from .lookup import DEFAULT_HOT_KEY_MIN_ROWS, measure

TS_POLICIES = ("write_time", "source")


def dedupe_rows(df: DataFrame, key: str, order_cols: list[str], within: str | None = None) -> DataFrame:
    """Last write wins per key inside one batch.

    The source system leaves the order of same-key writes undefined; here the
    row with the greatest ``order_cols`` tuple wins, as a whole. One exchange on
    the key and one sort; the planner's rank limit also drops losers before the
    exchange, so a hot key does not travel. Input already partitioned by the
    key (by hash or range) is not shuffled again, nor is input partitioned by a column ``within`` that the
    key determines. The rows leave sorted by key.
    """
    others = [c for c in df.columns if c not in (key, within) and c not in order_cols]
    best = Window.partitionBy(*([within] if within else []), key).orderBy(*[F.col(c).desc_nulls_last() for c in [*order_cols, *others]])
    return df.withColumn("_rank", F.row_number().over(best)).where("_rank = 1").drop("_rank")


def dedupe_stored(df: DataFrame, key: str, order_cols: list[str], work: str) -> DataFrame:
    """``dedupe_rows`` for rows on disk most of whose keys come once: those stay in their tasks, and only rows of other keys are exchanged.

    One pass counts rows by a hash of the key; keys that share a hash count as one, so they are merely exchanged too. The hashes that come more often are
    written to the folder ``work``, for the caller to remove. If they are too many to be broadcast, all rows are exchanged.
    The rows of each task leave sorted by key. ``df`` is read up to three times.
    """
    hashed = df.withColumn("_hash", F.xxhash64(key))
    often, few = measure(hashed.groupBy("_hash").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("_hash"), path=work)
    if not few:
        return dedupe_rows(df, key, order_cols)
    once = df if often.isEmpty() else hashed.join(F.broadcast(often), "_hash", "left_anti").drop("_hash")
    once = once.sortWithinPartitions(key)
    if often.isEmpty():
        return once
    return once.unionByName(dedupe_rows(hashed.join(F.broadcast(often), "_hash", "left_semi").drop("_hash"), key, order_cols))


def settle_hot_keys(df: DataFrame, key: str, order_cols: list[str], min_rows: int | None = None) -> DataFrame:
    """``df`` with only the winners (``dedupe_rows``) of its hot keys; all rows of other keys stay.

    For input that is exchanged by ranges of the key (or into a given number of tasks) before it is
    de-duplicated: there a hot key's rows would all travel to one task. A key is hot when it holds
    more rows than a fair share per shuffle partition, and at least ``wideflow.hotKeyMinRows``; hot keys are therefore
    fewer than the partitions. Finding them shuffles one count per key and task, and the hot rows leave each task
    as one row per key. ``df`` is read up to three times and should lie on disk.
    """
    spark = df.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    least = min_rows if min_rows is not None else int(spark.conf.get("wideflow.hotKeyMinRows", None) or DEFAULT_HOT_KEY_MIN_ROWS)
    total = df.count()
    if total <= least:
        return df
    often = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > max(total // parts, least, 1)).select(key)
    hot = F.broadcast(spark.createDataFrame(often.collect(), often.schema))
    if hot.isEmpty():
        return df
    same = df[key].eqNullSafe(hot[key])
    return df.join(hot, same, "left_anti").unionByName(dedupe_rows(df.join(hot, same, "left_semi"), key, order_cols))


def key_collisions(keyed: DataFrame, identity: list[str], key: str = "row_key") -> DataFrame:
    """Keys that more than one distinct ``identity`` shares: (key, n rows, n_invoices)."""
    return (keyed.groupBy(key).agg(F.count(F.lit(1)).alias("n"),
                                   F.count_distinct(F.concat_ws("|", *identity)).alias("n_invoices"))
            .filter(F.col("n_invoices") > 1))


def restamp(cells: DataFrame, run_ts: dt.datetime | None, ts_policy: str) -> DataFrame:
    """Source cells as a merge writes them: with the write time, or with their own timestamps."""
    if ts_policy not in TS_POLICIES:
        raise ValueError(f"unknown ts_policy {ts_policy!r}")
    if ts_policy == "write_time":
        if run_ts is None:
            raise ValueError("run_ts is required for ts_policy='write_time'")
        cells = cells.withColumn("ts", ts_lit(run_ts))
    return cells.select(*CELL_COLS)


def source_batch(source: DataFrame, run_ts: dt.datetime | None = None, ts_policy: str = "write_time",
                 family: str | None = None, start=None, stop=None, ts_from=None, ts_to=None) -> DataFrame:
    """The cells a merge copies: latest source cells in the scan range, restamped."""
    src = scan(source, start=start, stop=stop, ts_from=ts_from, ts_to=ts_to,
               families=[family] if family else None)
    return restamp(src, run_ts, ts_policy)


def merge_cells(target: DataFrame, source: DataFrame, run_ts: dt.datetime | None = None,
                ts_policy: str = "write_time", family: str | None = None,
                start=None, stop=None, ts_from=None, ts_to=None) -> DataFrame:
    """Latest view of target after merging the selected source cells into it."""
    batch = source_batch(source, run_ts, ts_policy, family, start, stop, ts_from, ts_to)
    return latest(target.select(*CELL_COLS).unionByName(batch))
