"""Streaming load: files arriving over several micro-batches give the batch result."""

import os
import time

from pyspark.sql import functions as F

from conftest import SF_SMALL
from wideflow.operators import cells as C
from wideflow.operators import merge as M
from wideflow.plans import store
from wideflow.session import fresh_path
from wideflow.sinks import files as S
from wideflow.sources import fixtures as fx
from wideflow.streaming import sync


def test_stream_in_two_batches_equals_batch_load(spark):
    header = fx.inv_header(spark, SF_SMALL)
    by_name, by_tax = fx.code_by_name(spark, SF_SMALL), fx.code_by_tax(spark, SF_SMALL)
    incoming = fresh_path(spark, "t-incoming")
    parts = header.withColumn("_p", F.xxhash64(F.right("fphm", F.lit(5))) % 2 == 0)  # colliding numbers end alike
    parts.filter("_p").drop("_p").coalesce(1).write.parquet(incoming + "/a")
    parts.filter("NOT coalesce(_p, false)").drop("_p").coalesce(1).write.parquet(incoming + "/b")
    stream = sync.read_stream(spark, incoming, header.schema, max_files_per_trigger=1, recursive=True)
    table, ckpt = fresh_path(spark, "t-stream-table"), fresh_path(spark, "t-stream-ckpt")
    q = sync.start_header_load(stream, by_name, by_tax, "16", table, ckpt, available_now=True)
    q.awaitTermination()
    assert q.lastProgress is not None
    batches = spark.read.schema(S.CELL_SCHEMA).parquet(table).select("seq").distinct().count()
    assert batches >= 2
    streamed = sorted(C.latest(S.read_cells(spark, table)).select("row_key", "qualifier", "value").collect())
    bpath = fresh_path(spark, "t-batch-table")
    store.load_header(header, by_name, by_tax, "16", bpath, layout="put")
    batch = sorted(C.latest(S.read_cells(spark, bpath)).select("row_key", "qualifier", "value").collect())
    assert streamed == batch


def test_replayed_epoch_changes_nothing(spark):
    header = fx.inv_header(spark, SF_SMALL)
    lookups = fx.code_by_name(spark, SF_SMALL), fx.code_by_tax(spark, SF_SMALL)
    table, rejects, ckpt = (fresh_path(spark, n) for n in ("t-replay", "t-replay-rejects", "t-replay-ckpt"))

    def epoch():
        store.load_header(header, *lookups, "16", table, rejects, layout="put", seq=3, replace=True,
                          run_ts=sync.epoch_stamp(spark, ckpt, 3))
        return (sorted(S.read_cells(spark, table).collect(), key=str), spark.read.parquet(rejects).count())

    once, again = epoch(), epoch()
    assert once == again and once[1] > 0
    assert sync.epoch_stamp(spark, ckpt, 4) >= sync.epoch_stamp(spark, ckpt, 3)


def test_stored_rows_are_deduped_as_others(spark):
    rows = [(f"k{i % 300}", f"{i % 7}", None if i % 5 == 0 else "b") for i in range(320)] + [(None, "1", "x"), (None, None, "y"), ("", "1", "x")]
    for some in (rows, rows[:300], []):
        df = spark.createDataFrame(some, "row_key string, a string, b string").repartition(3)
        want = sorted(map(repr, M.dedupe_rows(df, "row_key", ["a"]).collect()))
        for limit in ("33554432", "0"):
            spark.conf.set("wideflow.broadcastMaxBytes", limit)
            try:
                assert sorted(map(repr, M.dedupe_stored(df, "row_key", ["a"], fresh_path(spark, "t-repeated")).collect())) == want
            finally:
                spark.conf.unset("wideflow.broadcastMaxBytes")


def test_stream_of_lines_leaves_no_shuffle_files(spark):
    """The shuffles of the stream's joins are dropped once an epoch's rows are staged, those of its load when it ends."""
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def files():
        found = disk.getAllFiles()
        paths = (found.apply(i).getPath() for i in range(found.size()))
        return {p: os.path.getsize(p) for p in paths if os.path.basename(p).startswith("shuffle_") and os.path.exists(p)}

    lines = sync.read_stream(spark, SF_SMALL, fx.read_table(spark, SF_SMALL, "lineitem").schema, file_glob="lineitem.parquet")
    sql, tables = fx.FIXTURES["inv_detail"]
    detail = spark.sql(sql, **{t: lines if t == "lineitem" else fx.read_table(spark, SF_SMALL, t) for t in tables})
    path, batch_path = fresh_path(spark, "t-lines"), fresh_path(spark, "t-lines-batch")
    before, keep = files(), spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        q = sync.start_detail_load(detail, fx.code_by_tax(spark, SF_SMALL), path, fresh_path(spark, "t-lines-ckpt"), available_now=True)
        assert spark.conf.get(sync.DROP_SHUFFLES, None) is None
        q.awaitTermination()
        for _ in range(50):
            left = sum(n for p, n in files().items() if p not in before)
            if left < 10_000:
                break
            time.sleep(0.2)
        assert left < 10_000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", keep)
    store.load_detail(fx.inv_detail(spark, SF_SMALL), fx.code_by_tax(spark, SF_SMALL), batch_path)
    streamed, loaded = (sorted(map(str, read(S.read_cells(spark, p)).select("row_key", "qualifier", "value").collect()))
                        for read, p in ((C.latest_of_repeated, path), (C.latest, batch_path)))
    assert streamed == loaded
