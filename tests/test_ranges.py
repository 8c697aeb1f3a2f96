"""Reads, compaction and syncs of stored tables that open only the files they need."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from wideflow.operators import cells as C
from wideflow.plans import jobs, store
from wideflow.session import fresh_path
from wideflow.sinks import files as S
from wideflow.sinks import live, ranges

T0 = dt.datetime(2024, 1, 1)


def batch(spark, keys, day=0, family="f", value="v"):
    rows = spark.createDataFrame([(k, family, "q", value) for k in keys], "row_key string, family string, qualifier string, value string")
    return C.stamp(rows, T0 + dt.timedelta(days=day), day)


def names(low, high):
    return [f"k{i:05d}" for i in range(low, high)]


def opened(df):
    return {f.rsplit("/", 1)[-1] for f in df.inputFiles()}


def test_scattered_keys_open_only_the_files_that_may_hold_them(spark):
    path = fresh_path(spark, "t-ranges")
    for day in range(3):
        S.write_cells_sorted(batch(spark, names(0, 4000), day, value=f"v{day}"), path, num_partitions=40)
    wanted = names(0, 4000)[::800]                     # 5 of 4000 keys, far apart
    keys = spark.createDataFrame([(k,) for k in [*wanted, "zz", None]], "row_key string")
    files = ranges.choose(spark, path, keys)
    per_file = (S.read_cells(spark, path).groupBy(F.col("_metadata.file_name").alias("f"))
                .agg(F.min("row_key").alias("a"), F.max("row_key").alias("b")).collect())
    assert len(per_file) == 120
    may_hold = {r.f for r in per_file if any(r.a <= k <= r.b for k in wanted)}
    assert {f.rsplit("/", 1)[-1] for f in files} == may_hold and len(may_hold) == 15
    got = store.multi_get_stored(spark, path, keys, "f", "q")
    assert opened(got) == may_hold
    assert {r.row_key: r.value for r in got.collect()} == {**dict.fromkeys(wanted, "v2"), "zz": None, None: None}
    assert store.multi_get_stored(spark, path, keys.where("false"), "f", "q").collect() == []
    fifty = spark.createDataFrame([(k,) for k in names(0, 4000)[7::80]], "row_key string")
    assert {r.value for r in store.multi_get_stored(spark, path, fifty, "f", "q").collect()} == {"v2"}


def test_keys_in_bounded_ranges(spark, monkeypatch):
    keys = spark.createDataFrame([(k,) for k in names(0, 300)], "row_key string")
    assert sorted(map(tuple, ranges.key_ranges(keys).collect())) == [(k, k) for k in names(0, 300)]
    monkeypatch.setattr(ranges, "KEY_RANGES", 10)
    got = sorted(map(tuple, ranges.key_ranges(keys).collect()))
    assert len(got) <= 10 and all(any(a <= k <= b for a, b in got) for k in names(0, 300))
    assert all(b < a for (_, b), (a, _) in zip(got, got[1:]))


def test_time_range_opens_no_file_of_other_batches(spark, monkeypatch):
    path = fresh_path(spark, "t-times")
    for day in range(6):
        S.write_cells(batch(spark, names(0, 50), day, value=f"v{day}"), path, batch=f"d{day}")
    looked = []
    read = ranges.refresh
    monkeypatch.setattr(ranges, "refresh", lambda *a: looked.append(1) or read(*a))
    got = store.scan_stored(spark, path, start="k00010", stop="k00020", ts_from=T0 + dt.timedelta(days=2), ts_to=T0 + dt.timedelta(days=4))
    assert all("batch=d2." in f or "batch=d3." in f for f in got.inputFiles()) and got.inputFiles()
    assert {(r.row_key, r.value) for r in got.collect()} == {(k, "v3") for k in names(10, 20)}
    S.write_cells(batch(spark, names(0, 5), 3, value="w"), path, batch="d9")  # not looked through yet
    S.write_cells(batch(spark, names(0, 5), 2, value="x"), path, batch="d3")  # replaced: its old files are not live
    later = store.scan_stored(spark, path, ts_from=T0 + dt.timedelta(days=2), ts_to=T0 + dt.timedelta(days=4))
    assert {(r.row_key, r.value) for r in later.collect()} == {(k, "w") for k in names(0, 5)} | {(k, "v2") for k in names(5, 50)}
    assert store.scan_stored(spark, path, ts_from=T0 + dt.timedelta(days=90)).collect() == []


def test_compaction_of_ranges_leaves_other_files_alone(spark):
    path = fresh_path(spark, "t-deep")
    S.write_cells_sorted(batch(spark, names(0, 1000), 0, value="a"), path, num_partitions=10)
    S.write_cells_sorted(batch(spark, names(0, 1000), 0, family="g", value="a"), path, num_partitions=10)
    for day in (1, 2, 3):
        S.write_cells(batch(spark, names(340, 360), day, value=f"v{day}").coalesce(1), path)
    before = sorted((r.row_key, r.family, r.value) for r in C.latest(S.read_cells(spark, path)).collect())
    files, reader = opened(S.read_cells(spark, path)), S.read_cells(spark, path)
    done = store.compact_ranges(spark, path, depth=3)
    rewritten = {f.rsplit("/", 1)[-1] for f in done}
    assert 4 <= len(done) <= 5 and all(f.startswith("family=f/") for f in done)
    now = S.read_cells(spark, path)
    assert files - opened(now) <= rewritten and len(opened(now) & files) >= 9
    assert sorted((r.row_key, r.family, r.value) for r in C.latest(now).collect()) == before
    assert now.where("family = 'f' AND row_key = 'k00350'").count() == 1
    assert reader.count() == 2060                                  # readers that began before still find their files
    assert store.compact_ranges(spark, path, depth=3) == []
    live.remove_unlisted(spark, path, dt.timedelta(0))             # folders of which some files are live stay
    assert sorted((r.row_key, r.family, r.value) for r in C.latest(S.read_cells(spark, path)).collect()) == before
    assert jobs.run(["compact", "--source", path, "--deeper-than", "3"], spark) == []


def test_depth_sweep_equals_a_plain_count(spark):
    import random
    rnd = random.Random(2)
    files = [(rnd.choice(["f", "g", None]), f"x{i}", *sorted(rnd.choices("abcdefghij", k=2))) for i in range(80)] + [("f", "none", None, None)]
    df = spark.createDataFrame(files, "family string, file string, low string, high string")
    for depth in (1, 4, 9, 20):
        want = {f for fam, f, a, b in files if a and any(
            sum(1 for g, _, c, d in files if c and g == fam and c <= k <= d) > depth for k in "abcdefghij" if a <= k <= b)}
        assert {r.file for r in ranges.too_deep(df, depth).collect()} == want


def test_a_batch_replaced_during_compaction_does_not_come_back(spark, monkeypatch):
    path = fresh_path(spark, "t-replaced")
    S.write_cells(batch(spark, ["a", "b"], value="old"), path, batch="x")
    S.write_cells(batch(spark, ["a", "b"], value="old"), path, batch="y")
    publish = live.publish
    for compact in (lambda: store.compact(spark, path), lambda: store.compact_ranges(spark, path, depth=1)):
        def late(*args, **kw):
            monkeypatch.setattr(live, "publish", publish)
            S.write_cells(batch(spark, ["c"], value="new"), path, batch="x")
            return publish(*args, **kw)
        monkeypatch.setattr(live, "publish", late)
        with pytest.raises(live.Replaced):
            compact()
        assert sorted((r.row_key, r.value) for r in S.read_cells(spark, path).collect()) == [("a", "old"), ("b", "old"), ("c", "new")]
        S.write_cells(batch(spark, ["a", "b"], value="old"), path, batch="x")


def test_repeated_sync_copies_new_batches_once(spark):
    source, target = fresh_path(spark, "t-src"), fresh_path(spark, "t-dst")
    day = lambda n: dt.datetime(2030, 1, 1 + n)

    def content():
        return sorted((r.row_key, r.value, r.ts) for r in S.read_cells(spark, target).collect())
    assert store.sync_new(spark, source, target, day(0)) == []
    S.write_cells(batch(spark, ["a", "b"], 5, value="new"), source)
    assert len(store.sync_new(spark, source, target, day(1))) == 1
    first = content()
    assert first == [("a", "new", day(1)), ("b", "new", day(1))]
    assert store.sync_new(spark, source, target, day(2)) == [] and content() == first
    S.write_cells(batch(spark, ["b", "c"], 1, value="late"), source)       # older stamps than what was copied
    assert len(store.sync_new(spark, source, target, day(3))) == 1
    assert content() == sorted([*first, ("c", "late", day(3))])            # the late batch adds c and does not bring back b
    store.compact(spark, source)
    assert store.sync_new(spark, source, target, day(4)) == []             # made of copied batches only
    S.write_cells(batch(spark, ["d"], 9, value="d"), source)
    store.compact_ranges(spark, source, depth=0)
    assert len(store.sync_new(spark, source, target, day(5))) == 1         # made of copied and other batches
    assert {(r.row_key, r.value) for r in C.latest(S.read_cells(spark, target)).collect()} == {("a", "new"), ("b", "new"), ("c", "late"), ("d", "d")}
    assert jobs.run(["sync-new", "--source", source, "--target", target], spark) == []


def test_killed_sync_is_done_again(spark, monkeypatch):
    source, target = fresh_path(spark, "t-src2"), fresh_path(spark, "t-dst2")
    S.write_cells(batch(spark, ["a"]), source)
    with monkeypatch.context() as m:
        def killed(*args, **kw):
            raise KeyboardInterrupt
        m.setattr(live, "publish", killed)
        with pytest.raises(KeyboardInterrupt):
            store.sync_new(spark, source, target)
    assert S.read_cells(spark, target).collect() == []
    assert len(store.sync_new(spark, source, target)) == 1 and S.read_cells(spark, target).count() == 1
