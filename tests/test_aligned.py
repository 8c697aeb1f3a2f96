"""Split points of a table, counts by the writing pass, key sketches and counts of bucketed tables."""

import bisect
import datetime as dt

import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from wideflow.operators import cells as C
from wideflow.plans import jobs, loads, store
from wideflow.session import fresh_path
from wideflow.sinks import bounds, bucketed, live, ranges
from wideflow.sinks import files as S
from wideflow.sources import fixtures as fx

T0 = dt.datetime(2024, 1, 1)


def cells_of(spark, keys, day=0, value="v", families=("f",)):
    rows = spark.createDataFrame([(k, f, "q", value) for k in keys for f in families],
                                 "row_key string, family string, qualifier string, value string")
    return C.stamp(rows, T0 + dt.timedelta(days=day), day)


def names(low, high):
    return [f"k{i:05d}" for i in range(low, high)]


def file_spans(spark, path):
    return sorted((r.low, r.high) for r in ranges.file_ranges(spark, path).select("low", "high").collect())


def crossing(spans, points):
    """Files that hold keys on both sides of a split point."""
    return [s for s in spans if bisect.bisect_right(points, s[0]) != bisect.bisect_right(points, s[1])]


def sync(spark, path, keys, day=0, **kw):
    store.sync_cells(cells_of(spark, keys, day, f"v{day}"), path, ts_policy="source", family="f", layout="aligned", **kw)


def test_range_of_equals_a_plain_search(spark):
    keys = ["", "a", "ab", "b", "zz", "é", "語", "𝄞", "\x00", "k\"\\", None]
    for points in ([], ["b"], ["a", "b"], sorted(["", "a", "é", "語", "𝄞", "k\"\\"]), names(0, 700)):
        df = spark.createDataFrame([(k,) for k in keys + names(0, 700)[::97]], "row_key string")
        got = df.select("row_key", bounds.range_of("row_key", points).alias("r")).collect()
        assert all(r.r == (0 if r.row_key is None else bisect.bisect_right(points, r.row_key)) for r in got)


def test_batches_share_their_bounds(spark):
    path = fresh_path(spark, "t-aligned")
    sync(spark, path, names(0, 8000), rows_per_range=1000)
    first = live.points(spark, path)
    spans = file_spans(spark, path)
    assert len(spans) == len(first) + 1 == 8 and all(500 <= int(b[1:]) - int(a[1:]) <= 1600 for a, b in spans)
    sync(spark, path, names(0, 8000)[::9], 1, rows_per_range=1000)      # a small batch splits nothing
    assert live.points(spark, path) == first and len(file_spans(spark, path)) == 16
    assert crossing(file_spans(spark, path), first) == []
    sync(spark, path, names(2000, 2100), 2, rows_per_range=1000)        # a batch of few ranges makes few files
    assert 1 <= len(file_spans(spark, path)) - 16 <= 2
    assert crossing(file_spans(spark, path), first) == []
    got = {r.row_key: r.value for r in C.latest(S.read_cells(spark, path)).collect()}
    assert got == {k: "v2" if 2000 <= i < 2100 else "v1" if i % 9 == 0 else "v0" for i, k in enumerate(names(0, 8000))}


def test_ranges_that_overflow_are_split(spark):
    path = fresh_path(spark, "t-grow")
    sync(spark, path, names(0, 2000), rows_per_range=1000)
    first = live.points(spark, path)
    assert len(first) == 1
    sync(spark, path, names(2000, 6000), 1, rows_per_range=1000)        # keys that only grow: the last range is split
    now = live.points(spark, path)
    assert set(first) < set(now) and len(now) >= 4 and all(p >= "k01000" for p in set(now) - set(first))
    newest = [s for s in file_spans(spark, path) if s[0] >= "k02000"]
    assert crossing(newest, now) == [] and len(newest) >= 4
    assert S.read_cells(spark, path).count() == 6000


def test_one_key_with_a_third_of_all_rows(spark):
    path = fresh_path(spark, "t-hot")
    many = C.stamp(spark.range(3000).select(F.when(F.col("id") % 3 == 0, "k00500").otherwise(F.format_string("k%05d", F.col("id"))).alias("row_key"),
                                            F.lit("f").alias("family"), F.lit("q").alias("qualifier"), F.col("id").cast("string").alias("value")), T0)
    sizes = []
    for _ in range(4):
        before = set(live.live(spark, path) or [])
        store.sync_cells(many, path, ts_policy="source", family="f", layout="aligned", rows_per_range=400)
        points = live.points(spark, path)
        own = ranges.file_ranges(spark, path, sorted(set(live.live(spark, path)) - before)).select("low", "high").collect()
        assert crossing([(r.low, r.high) for r in own], points) == []
        sizes.append(len(points))
    assert sizes[0] >= 3 and sizes[-1] <= 30                            # the range of the hot key gets finer, others do not
    got = {r.row_key: r.value for r in C.latest(S.read_cells(spark, path)).collect()}
    assert len(got) == 2000 + (500 % 3 == 0) and got["k00500"] == max(str(i) for i in range(3000) if i % 3 == 0 or i == 500)
    only = C.stamp(spark.range(900).selectExpr("'same' row_key", "'f' family", "'q' qualifier", "CAST(id AS string) value"), T0)
    store.sync_cells(only, fresh_path(spark, "t-same"), ts_policy="source", family="f", layout="aligned", rows_per_range=100)


def test_aligned_rows_are_exchanged_once(spark, monkeypatch):
    plans = []
    write = store.write_family_batch
    monkeypatch.setattr(store, "write_family_batch", lambda cells, *a, **k: plans.append(
        cells._jdf.queryExecution().executedPlan().toString()) or write(cells, *a, **k))
    args = (fx.inv_header(spark, SF_SMALL), fx.code_by_name(spark, SF_SMALL), fx.code_by_tax(spark, SF_SMALL))
    path, bulk = fresh_path(spark, "t-al"), fresh_path(spark, "t-bu")
    for _ in range(2):
        store.load_header(*args, "16", path, layout="aligned", rows_per_range=200)
    store.load_header(*args, "16", bulk, layout="bulk")
    assert all(p.count("Exchange") == 1 for p in plans[:2])
    assert len(live.points(spark, path)) >= 4 and crossing(file_spans(spark, path), live.points(spark, path)) == []

    def wide(p):
        return sorted((r.row_key, r.qualifier, r.value) for r in C.latest(S.read_cells(spark, p)).collect())
    assert wide(path) == wide(bulk)
    with pytest.raises(ValueError):
        store.load_header(*args, "16", path, layout="aligned", num_partitions=3)


def test_points_of_two_writers_stay_and_replaced_batches_keep_them(spark, monkeypatch):
    path = fresh_path(spark, "t-two")
    publish = live.publish

    def late(*a, **kw):
        monkeypatch.setattr(live, "publish", publish)
        sync(spark, path, names(0, 3000), 1, rows_per_range=700)
        return publish(*a, **kw)
    monkeypatch.setattr(live, "publish", late)
    sync(spark, path, names(100, 3100), 2, rows_per_range=1000)
    points = live.points(spark, path)
    assert len(points) >= 5 and points == sorted(points) and S.read_cells(spark, path).count() == 6000
    store.compact(spark, path, layout="aligned")
    assert set(points) <= set(live.points(spark, path)) and crossing(file_spans(spark, path), points) == []
    assert len(file_spans(spark, path)) == len(points) + 1 and S.read_cells(spark, path).count() == 3100


def test_aligned_batch_without_rows_and_whole_table(spark):
    path = fresh_path(spark, "t-none")
    sync(spark, path, [], rows_per_range=10)
    assert live.points(spark, path) == [] and S.read_cells(spark, path).collect() == []
    store.sync_cells(cells_of(spark, names(0, 60), families=("f", "g")), path, ts_policy="source", layout="aligned", rows_per_range=30)
    assert len(live.points(spark, path)) >= 2 and S.read_cells(spark, path).count() == 120
    copy = fresh_path(spark, "t-copy")
    store.compact(spark, path, copy, layout="aligned", rows_per_range=60)
    assert S.read_cells(spark, copy).count() == 120 and live.points(spark, copy)
    with pytest.raises(FileExistsError):
        store.compact(spark, path, copy)


@pytest.mark.parametrize("kind", ["header", "detail"])
def test_counts_of_a_load_add_up(spark, kind, capsys):
    tax = fx.code_by_tax(spark, SF_SMALL)
    if kind == "header":
        src = fx.inv_header(spark, SF_SMALL)
        tagged = loads.tag_header(src, fx.code_by_name(spark, SF_SMALL), tax, "16")
        def run(**kw): return store.load_header(src, fx.code_by_name(spark, SF_SMALL), tax, "16", fresh_path(spark, "t-c"), **kw)  # noqa: E704
    else:
        src = fx.inv_detail(spark, SF_SMALL)
        tagged = loads.tag_detail(src, tax)
        def run(**kw): return store.load_detail(src, tax, fresh_path(spark, "t-c"), **kw)  # noqa: E704
    want = {r.outcome: r.n for r in loads.reject_counts(tagged).collect()}
    rejects = fresh_path(spark, "t-cr")
    for got in (run(layout="put", rejects_path=rejects), run(layout="put", counted=True), run(layout="aligned")):
        assert got.rows == src.count() == got.accepted + sum(got.rejected.values())
        assert {"accepted": got.accepted, **got.rejected} == want
    assert spark.read.parquet(rejects).count() == sum(got.rejected.values())
    assert run(layout="put") is None                                    # not staged, so not counted
    jobs._told(got)
    assert f"Rows: {got.rows}, accepted: {got.accepted}, rejected: {got.rows - got.accepted}" in capsys.readouterr().out


def test_every_reason_is_listed():
    import inspect
    import re
    text = inspect.getsource(loads.tag_header) + inspect.getsource(loads.tag_detail) + inspect.getsource(loads._header_gate_reason)
    assert set(re.findall(r', "([a-z]+_[a-z_]+)"\)(?!\))', text)) - {"_yy", "_fpbm"} <= set(loads.REASONS)


def test_row_estimate_counts_shared_keys_once(spark, monkeypatch):
    path = fresh_path(spark, "t-est")
    assert ranges.estimate_rows(spark, path) == 0
    for day in range(3):
        S.write_cells_sorted(cells_of(spark, names(0, 20000)[day * 2000:], day, families=("f", "g")), path, num_partitions=5)
    assert abs(ranges.estimate_rows(spark, path) - 20000) <= 20000 * 4 * 0.0163        # four standard errors
    assert ranges.estimate_rows(spark, path, ["none"]) == 0
    assert jobs.run(["count-rows", "--table", path, "--estimate"], spark) == ranges.estimate_rows(spark, path)
    S.write_cells(cells_of(spark, names(30000, 30010), 4), path)
    assert len(file_spans(spark, path)) > 30
    assert ranges.estimate_rows(spark, path) >= 19000


def test_index_without_sketches_is_made_anew(spark):
    path = fresh_path(spark, "t-old")
    S.write_cells(cells_of(spark, names(0, 100)), path)
    ranges.file_ranges(spark, path).count()
    old = ranges._stored(spark, path).drop("keys")
    rows = old.collect()
    spark.createDataFrame(rows, old.schema).write.mode("append").parquet(f"{path}/{ranges.RANGES}/old")
    assert ranges.file_ranges(spark, path).count() == len(rows)


def test_bucketed_count_exchanges_no_key(spark):
    name, path = "wf_t_count", fresh_path(spark, "t-bucket")
    for day in range(2):
        bucketed.write_bucketed(cells_of(spark, names(0, 300)[day * 100:], day), name, path, 8)
    n = C.count_rows(bucketed.read_bucketed(spark, name))
    plan = n._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Exchange SinglePartition" in plan and n.first().n_rows == 300
