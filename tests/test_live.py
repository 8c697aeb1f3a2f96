"""Live batches: what readers see while tables are written, replaced and compacted, and streams beside each other."""

import datetime as dt
import threading

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from wideflow.operators import cells as C
from wideflow.plans import store
from wideflow.session import fresh_path
from wideflow.sinks import files as S
from wideflow.sinks import live
from wideflow.sources import fixtures as fx
from wideflow.streaming import sync

T = dt.datetime(2024, 1, 1)


def batch(spark, *rows, family="f"):
    return C.stamp(spark.createDataFrame([(k, family, "q", v) for k, v in rows], "row_key string, family string, qualifier string, value string"), T, 1)


def values(spark, path):
    return sorted((r.row_key, r.value) for r in S.read_cells(spark, path).collect())


def test_replace_is_seen_whole_or_not_at_all(spark, monkeypatch):
    path = fresh_path(spark, "t-live")
    S.write_cells(batch(spark, ("a", "1"), ("b", "1")), path, batch="x")
    S.write_cells(batch(spark, ("c", "1")), path, batch="y")
    before, seen, publish = values(spark, path), [], live.publish
    reader = S.read_cells(spark, path)

    def watched(*args):
        seen.append(values(spark, path))  # all files are written, nothing is published
        return publish(*args)
    monkeypatch.setattr(live, "publish", watched)
    S.write_cells(batch(spark, ("a", "2")), path, batch="x")
    assert seen == [before] and values(spark, path) == [("a", "2"), ("c", "1")]
    assert sorted((r.row_key, r.value) for r in reader.collect()) == before  # a reader that started before ends on what it saw

    def killed(*args):
        raise KeyboardInterrupt
    monkeypatch.setattr(live, "publish", killed)
    for write in (lambda: S.write_cells(batch(spark, ("d", "9")), path, batch="x"), lambda: store.compact(spark, path),
                  lambda: S.write_family_batch(batch(spark, ("e", "9")), path, "f", "y", replace=True)):
        with pytest.raises(KeyboardInterrupt):
            write()
        assert values(spark, path) == [("a", "2"), ("c", "1")]
    monkeypatch.setattr(live, "publish", publish)
    assert live.remove_unlisted(spark, path, dt.timedelta(hours=1)) == []
    listed = live.live(spark, path)
    assert len(live.remove_unlisted(spark, path, dt.timedelta(0))) == 4 and sorted(live._folders(spark, path, "*")) == sorted(listed)
    assert values(spark, path) == [("a", "2"), ("c", "1")]


def test_first_write_that_is_killed_leaves_an_empty_table(spark, monkeypatch):
    path = fresh_path(spark, "t-live-first")
    with monkeypatch.context() as m:
        m.setattr(live, "publish", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt))
        with pytest.raises(KeyboardInterrupt):
            S.write_cells(batch(spark, ("a", "1")), path)
    assert values(spark, path) == []
    S.write_family_batch(batch(spark, ("b", "1")), path, "f", "x")
    assert values(spark, path) == [("b", "1")]
    with pytest.raises(FileExistsError):
        S.write_family_batch(batch(spark, ("b", "2")), path, "f", "x")
    S.write_family_batch(batch(spark, ("g", "1"), family="g"), path, "g", "x")  # another family's batch of that name
    assert values(spark, path) == [("b", "1"), ("g", "1")]


def test_folders_written_before_there_were_pointers_are_adopted(spark):
    path = fresh_path(spark, "t-live-old")
    batch(spark, ("a", "1")).drop("family").write.parquet(f"{path}/family=f/batch=b0")
    assert values(spark, path) == [("a", "1")] and live.live(spark, path) is None
    S.write_cells(batch(spark, ("b", "1")), path)
    assert values(spark, path) == [("a", "1"), ("b", "1")]


def test_writers_at_once_lose_nothing(spark):
    path = fresh_path(spark, "t-live-many")
    writers = [threading.Thread(target=S.write_cells, args=(batch(spark, (f"k{i}", "1")), path)) for i in range(6)]
    for w in writers:
        w.start()
    for w in writers:
        w.join()
    assert values(spark, path) == [(f"k{i}", "1") for i in range(6)]
    assert not live._put(spark, path, live._numbers(spark, path)[-1], {"folders": []}) and len(values(spark, path)) == 6


def test_write_killed_before_its_folders_are_placed(spark, monkeypatch):
    path = fresh_path(spark, "t-live-staged")
    S.write_cells(batch(spark, ("a", "1")), path)
    with monkeypatch.context() as m:
        def killed(*args):
            raise KeyboardInterrupt
        m.setattr(live, "place", killed)
        with pytest.raises(KeyboardInterrupt):
            S.write_cells(batch(spark, ("b", "1")), path)
    assert values(spark, path) == [("a", "1")]
    gone = live.remove_unlisted(spark, path, dt.timedelta(0))
    assert len(gone) == 1 and gone[0].startswith("_staged/") and values(spark, path) == [("a", "1")]
    S.write_cells(batch(spark, ("b", "1")), path)
    assert values(spark, path) == [("a", "1"), ("b", "1")] and live.remove_unlisted(spark, path, dt.timedelta(0)) == []


def test_compaction_in_place_keeps_batches_published_meanwhile(spark, monkeypatch):
    path = fresh_path(spark, "t-live-compact")
    S.write_cells(batch(spark, ("a", "1")), path)
    S.write_cells(C.stamp(batch(spark, ("a", "2")).drop("ts", "seq"), T, 2), path)
    publish = live.publish

    def late(*args):
        monkeypatch.setattr(live, "publish", publish)
        S.write_cells(batch(spark, ("b", "1")), path)
        return publish(*args)
    monkeypatch.setattr(live, "publish", late)
    store.compact(spark, path)
    assert values(spark, path) == [("a", "2"), ("b", "1")] and len(live.live(spark, path)) == 2


def halves(spark, rows, key, name):
    """Two folders with a part of the rows each."""
    incoming = fresh_path(spark, name)
    for i in range(2):
        rows.where(F.pmod(F.xxhash64(F.right(key, F.lit(5))), F.lit(2)) == i).coalesce(1).write.parquet(f"{incoming}/{i}")
    return incoming


@pytest.mark.parametrize("kind", ["header", "detail"])
def test_two_streams_and_a_new_checkpoint_keep_all_rows(spark, kind):
    by_name, by_tax = fx.code_by_name(spark, SF_SMALL), fx.code_by_tax(spark, SF_SMALL)
    rows = fx.inv_header(spark, SF_SMALL) if kind == "header" else fx.inv_detail(spark, SF_SMALL)
    incoming = halves(spark, rows, "fphm", f"t-two-{kind}")
    table, rejects = fresh_path(spark, "t-two-table"), fresh_path(spark, "t-two-rejects")

    def run(folder, checkpoint):
        stream = sync.read_stream(spark, folder, rows.schema)
        if kind == "header":
            q = sync.start_header_load(stream, by_name, by_tax, "16", table, checkpoint, rejects, available_now=True)
        else:
            q = sync.start_detail_load(stream, by_tax, table, checkpoint, rejects, available_now=True)
        q.awaitTermination()
        return C.latest(S.read_cells(spark, table)).select("row_key", "qualifier", "value").count(), spark.read.parquet(rejects).count()

    first, second = fresh_path(spark, "t-two-ckpt"), fresh_path(spark, "t-two-ckpt")
    run(f"{incoming}/0", first)
    both = run(f"{incoming}/1", second)
    want = fresh_path(spark, "t-two-want")
    if kind == "header":
        store.load_header(rows, by_name, by_tax, "16", want, want + "-rejects", layout="put")
    else:
        store.load_detail(rows, by_tax, want, want + "-rejects", layout="put")
    assert both == (S.read_cells(spark, want).count(), spark.read.parquet(want + "-rejects").count()) and both[1] > 0
    assert run(f"{incoming}/0", first) == both  # nothing new for the first stream
    assert len(live.live(spark, table)) == 2 and sync.stream_id(spark, first) != sync.stream_id(spark, second)
    assert run(f"{incoming}/0", fresh_path(spark, "t-two-ckpt"))[0] == both[0]  # the same rows by a new checkpoint: versions more, keys the same
    assert len(live.live(spark, table)) == 3


def test_epochs_of_a_stream_keep_their_order():
    a, b = "f" * 32, "0" * 31 + "1"
    assert sync.epoch_batch(a, 3)[1] < sync.epoch_batch(a, 4)[1] < 1 << 63
    assert len({sync.epoch_batch(o, e) for o in (a, b) for e in range(3)}) == 6


def test_hot_key_leaves_each_task_as_one_row(spark):
    from wideflow.operators import merge as M
    rows = spark.range(9_000).selectExpr("CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 3 = 1 THEN concat('k', id % 500) ELSE NULL END AS row_key",
                                         "cast(id * 7919 % 9001 AS string) AS v", "id AS other").repartition(6)
    settled = M.settle_hot_keys(rows, "row_key", ["v"], min_rows=1_000)
    count = {r.row_key: r.n for r in settled.groupBy("row_key").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert count.pop("hot") == 1 and count.pop(None) == 1 and sum(count.values()) == 3_000  # a null key is a key
    assert sorted(M.dedupe_rows(settled, "row_key", ["v"]).collect(), key=str) == sorted(M.dedupe_rows(rows, "row_key", ["v"]).collect(), key=str)
    tree = S.by_key_range(settled, 4)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in tree and tree.index("rangepartitioning") < tree.index("WindowGroupLimit") and "Partial" in tree
    assert M.settle_hot_keys(rows, "row_key", ["v"]) is rows and M.settle_hot_keys(rows, "row_key", ["v"], min_rows=5_000).count() == 9_000


@pytest.mark.parametrize("layout", ["put", "bulk"])
def test_load_with_a_hot_key(spark, layout):
    header = fx.inv_header(spark, SF_SMALL)
    one = header.where("NOT contains(xfmc, '?') AND length(fphm) = 8").limit(1)
    rows = header.unionByName(one.crossJoin(spark.range(1_000)).withColumn("je", F.col("id").cast("string")).drop("id")).repartition(4)
    args = (fx.code_by_name(spark, SF_SMALL), fx.code_by_tax(spark, SF_SMALL), "16")
    found = []
    for least in ("100000", "100"):
        spark.conf.set("wideflow.hotKeyMinRows", least)
        try:
            path = fresh_path(spark, "t-hot")
            store.load_header(rows, *args, path, layout=layout, num_partitions=3, run_ts=T, seq=1)
        finally:
            spark.conf.unset("wideflow.hotKeyMinRows")
        found.append(sorted(S.read_cells(spark, path).collect(), key=str))
    assert found[0] == found[1]
