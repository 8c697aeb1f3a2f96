"""Cell tables: version resolution, layout of bulk writes, merges, pushdown, plan checks."""

import datetime as dt
import glob
import os

import pyarrow.parquet as pq
from pyspark.sql import functions as F

import __spark_entry__ as E
from conftest import SF_SMALL
from wideflow.operators import cells as C
from wideflow.operators import merge as M
from wideflow.plans import store
from wideflow.plans.registry import REGISTRY
from wideflow.session import fresh_path
from wideflow.sinks import files as S
from wideflow.sources import fixtures as fx

T0 = dt.datetime(2024, 1, 1)
T1 = dt.datetime(2024, 1, 2)


def _cells(spark, rows):
    return spark.createDataFrame(rows, "row_key string, family string, qualifier string, ts timestamp_ntz, seq long, value string")


def test_latest_tie_breaks(spark):
    rows = [("k1", "f", "q", T0, 1, "a"), ("k1", "f", "q", T1, 0, "b"),       # later ts wins
            ("k2", "f", "q", T1, 1, "a"), ("k2", "f", "q", T1, 2, "b"),       # equal ts: seq
            ("k3", "f", "q", T1, 1, "a"), ("k3", "f", "q", T1, 1, "c"),       # equal ts+seq: value
            ("k4", "f", "q", T0, 1, None)]
    got = {r.row_key: r.value for r in C.latest(_cells(spark, rows)).collect()}
    assert got == {"k1": "b", "k2": "b", "k3": "c", "k4": None}


def test_partition_profile_lists_rows_per_partition(spark):
    df = spark.range(0, 103, 1, 4)
    got = {r.partition: r.n for r in C.partition_profile(df).collect()}
    assert got == {i: len(p) for i, p in enumerate(df.rdd.glom().collect())}
    assert len(got) == 4 and sum(got.values()) == 103
    some = C.partition_profile(df.where("id < 30")).collect()
    assert sum(r.n for r in some) == 30 and len(some) == 2


def test_to_wide_keeps_rows_without_named_cells(spark):
    rows = [("k1", "f", "a", T0, 1, "1"), ("k1", "f", "a", T1, 1, "2"), ("k2", "g", "x", T0, 1, "9"),
            ("k3", "f", "b", T0, 1, "3")]
    got = {r.row_key: (r.a, r.b) for r in C.to_wide(_cells(spark, rows), "f", ["a", "b"]).collect()}
    assert got == {"k1": ("2", None), "k2": (None, None), "k3": (None, "3")}


def test_bulk_layout_sorted_and_disjoint(spark):
    path = fresh_path(spark, "t-bulk")
    cells = C.stamp(C.unpivot(E.queries()["header_keyed"](spark, SF_SMALL),
                              ["xfmc", "fpdm", "fphm", "kpyf"], "fpxx"), T0, 1)
    S.write_cells_sorted(cells, path, num_partitions=4)
    ranges = []
    local = path[len("file:"):] if path.startswith("file:") else path
    for f in sorted(glob.glob(os.path.join(local, "family=fpxx", "batch=*", "*.parquet"))):
        t = pq.read_table(f, columns=["row_key", "qualifier"]).to_pylist()
        if not t:
            continue
        keys = [(r["row_key"].encode(), r["qualifier"].encode()) for r in t]
        assert keys == sorted(keys), f
        ranges.append((keys[0], keys[-1]))
    assert len(ranges) > 1
    ranges.sort()
    for (lo1, hi1), (lo2, hi2) in zip(ranges, ranges[1:]):
        assert hi1 < lo2                                   # key ranges do not overlap


def test_sync_is_idempotent(spark):
    cells = fx.cells(spark, SF_SMALL)
    target = cells.filter(F.col("ts") >= C.ts_lit(dt.datetime(2024, 1, 16)))
    tpath = fresh_path(spark, "t-sync")
    S.write_cells(target, tpath)
    run = dt.datetime(2024, 2, 1)
    store.sync_cells(cells, tpath, run_ts=run, family="ev", start="00000010", stop="00000100")
    once = sorted(C.latest(S.read_cells(spark, tpath)).collect())
    store.sync_cells(cells, tpath, run_ts=run, family="ev", start="00000010", stop="00000100")
    twice = sorted(C.latest(S.read_cells(spark, tpath)).collect())
    assert once == twice
    lazy = sorted(M.merge_cells(target, cells, run, family="ev", start="00000010", stop="00000100").collect())
    assert once == lazy


def plan_text(spark, df) -> str:
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    try:
        return spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")


def test_key_and_time_ranges_reach_the_scan(spark):
    path = fresh_path(spark, "t-push")
    S.write_cells_sorted(fx.cells(spark, SF_SMALL), path)
    df = C.scan(S.read_cells(spark, path), start="00000010", stop="00000020",
                ts_from=dt.datetime(2024, 1, 8), ts_to=dt.datetime(2024, 1, 15), families=["ev"])
    plan = plan_text(spark, df)
    assert "GreaterThanOrEqual(row_key,00000010)" in plan and "LessThan(row_key,00000020)" in plan
    assert "GreaterThanOrEqual(ts," in plan
    assert "PartitionFilters: [isnotnull(family" in plan and "(family" in plan
    assert "ReadSchema: struct<row_key:string,qualifier:string,ts:timestamp_ntz,seq:bigint,value:string>" in plan


def test_upsert_last_write_wins_across_batches(spark):
    path = fresh_path(spark, "t-upsert")
    b1 = C.stamp(_cells(spark, [("k", "f", "q", T0, 0, "old"), ("j", "f", "q", T0, 0, "keep")]).drop("ts", "seq"), T0, 1)
    b2 = C.stamp(_cells(spark, [("k", "f", "q", T0, 0, "new")]).drop("ts", "seq"), T1, 2)
    S.write_cells(b1, path)
    S.write_cells(b2, path)
    got = {r.row_key: r.value for r in C.latest(S.read_cells(spark, path)).collect()}
    assert got == {"k": "new", "j": "keep"}


def test_no_python_udfs_in_any_plan(spark):
    for name, (fn, _sql) in REGISTRY.items():
        plan = fn(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
        assert "EvalPython" not in plan and "PythonUDF" not in plan, name


def test_csv_roundtrip_lossless(spark):
    path = fresh_path(spark, "t-csv")
    df = spark.createDataFrame([("a", ""), ("b", None)], "k string, v string")
    S.write_csv(df, path)
    back = sorted(S.read_csv(spark, path, df.schema).collect())
    assert [tuple(r) for r in back] == [("a", ""), ("b", None)]


def test_bucketed_table_reads_without_shuffle(spark):
    from wideflow.sinks import bucketed as B
    cells = fx.cells(spark, SF_SMALL)
    name, path = "wf_t_bucketed", fresh_path(spark, "t-bucketed")
    B.write_bucketed(cells, name, path, 4)
    B.write_bucketed(cells.filter(F.col("qualifier") == "view"), name, path, 4)   # a second batch
    t = B.read_bucketed(spark, name)
    for df in (C.latest(t), C.to_wide(t, "ev", ["click", "view"], one_scan=True)):
        plan = plan_text(spark, df)
        assert "Exchange" not in plan, plan
    assert sorted(C.latest(t).collect()) == sorted(C.latest(cells).collect())
    keys = spark.createDataFrame([("00000001",), ("99999999",)], "row_key string")
    got = {r.row_key: r.value for r in C.multi_get(t, keys, "ev", "click").collect()}
    assert set(got) == {"00000001", "99999999"} and got["99999999"] is None


def test_bucketed_batch_writes_one_file_per_bucket(spark):
    from wideflow.sinks import bucketed as B
    name, path = "wf_t_bucket_files", fresh_path(spark, "t-bucket-files")
    B.write_bucketed(fx.cells(spark, SF_SMALL), name, path, 4)
    local = path[len("file:"):] if path.startswith("file:") else path
    files = [f for f in glob.glob(os.path.join(local, "*.parquet"))]
    assert 0 < len(files) <= 4, files


def test_wide_read_prunes_family_and_adds_bare_keys(spark):
    path = fresh_path(spark, "t-wide")
    S.write_cells_sorted(fx.cells(spark, SF_SMALL), path)
    stored = S.read_cells(spark, path)
    df = C.to_wide(stored, "ev", ["click", "view"])
    plan = plan_text(spark, df)
    assert "family" in plan.split("PartitionFilters:")[1][:200] and "In(qualifier, [click,view])" in plan, plan
    assert "ReadSchema: struct<row_key:string>" in plan          # the key-only scan
    assert plan.count("Arguments: hashpartitioning(row_key") == 1
    assert sorted(df.collect(), key=str) == sorted(C.to_wide(fx.cells(spark, SF_SMALL), "ev", ["click", "view"], one_scan=True).collect(), key=str)
    assert df.where("row_key >= '7'").count() > 0                 # rows of the other family only


def test_multi_get_pushes_keys_to_the_scan(spark):
    path = fresh_path(spark, "t-get")
    S.write_cells_sorted(fx.cells(spark, SF_SMALL), path)
    keys = spark.createDataFrame([("00000003",), ("00000001",), ("00000003",), ("99999999",), (None,)], "row_key string")
    df = C.multi_get(S.read_cells(spark, path), keys, "ev", "click")
    plan = plan_text(spark, df)
    assert "GreaterThanOrEqual(row_key,00000001)" in plan and "LessThanOrEqual(row_key,99999999)" in plan, plan
    tree = plan.split("\n\n")[0]
    assert "LeftSemi" in plan and tree.rindex("HashJoin") > tree.index("Aggregate")  # printed from the top: the semi-join is below
    assert len(df.collect()) == 5
    assert C.multi_get(S.read_cells(spark, path), keys.limit(0), "ev", "click").collect() == []


def test_put_writes_follow_the_number_of_partitions(spark):
    path = fresh_path(spark, "t-put")
    store.sync_cells(fx.cells(spark, SF_SMALL), path, run_ts=T0, family="ev", layout="put", num_partitions=3)
    local = path[len("file:"):] if path.startswith("file:") else path
    assert 1 < len(glob.glob(os.path.join(local, "family=ev", "batch=*", "*.parquet"))) <= 3


def test_latest_by_row_is_latest(spark):
    rows = [(f"k{i % 7}", "f" if i % 3 else "g", f"q{i % 4}", T0 if i % 5 else T1, i % 6, None if i % 11 == 0 else f"v{i % 13}") for i in range(400)]
    rows += [("k1", "f", "q0", T1, 9, None), ("k1", "f", "q0", T1, 9, "a"), ("k1", "f", "q0", T1, 9, "a"), (None, "f", "q", T0, 1, "a"),
             (None, "f", "q", T0, 1, "b"), ("k", None, "q", T0, None, "a"), ("k", None, "q", None, 3, "b"), ("k", "f", None, T0, 1, "é"), ("", "f", "", T0, 1, "")]
    for cells in (_cells(spark, rows), _cells(spark, rows).coalesce(1).sort("family", "row_key", "qualifier"), _cells(spark, [])):
        want = sorted(map(repr, C.latest(cells).collect()))
        assert sorted(map(repr, C.latest_by_row(cells).collect())) == want
        assert sorted(map(repr, C.latest_by_row(cells, pack=False).collect())) == want


def test_latest_by_row_exchanges_a_row_once(spark):
    """24 cells of a row travel as one row, by row key alone, into tasks whose number follows the stored bytes."""
    path = fresh_path(spark, "runs")
    rows = [(f"k{i:05d}", "f", f"q{q:02d}", T0, 1, f"v{i % 10}") for i in range(500) for q in range(24)]
    S.write_cells_sorted(_cells(spark, rows), path)
    cells = S.read_cells(spark, path)
    runs = sum(b.num_rows for b in C._runs(iter(cells.coalesce(1).sort("row_key", "qualifier").toArrow().to_batches())))
    assert 500 <= runs <= 510
    for pack in (True, False):
        plan = C.latest_by_row(cells, pack)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange") == 1 and "hashpartitioning(row_key" in plan and "REPARTITION_BY_NUM" in plan


def test_latest_of_repeated_is_latest(spark):
    rows = [(f"k{i % 7}", "f" if i % 3 else "g", f"q{i % 4}", T0 if i % 5 else T1, i % 6, None if i % 11 == 0 else f"v{i % 13}") for i in range(400)]
    rows += [(f"single{i}", f, f"q{q}", T0, 1, f"v{i}{q}") for i in range(50) for f in "fg" for q in range(4)]
    rows += [(None, "f", "q", T0, 1, "a"), ("k", None, "q", T0, None, "a"), ("k", "f", None, T0, 1, "é"), ("", "f", "", T0, 1, ""), ("two", None, "q", T0, 1, "a"), ("two", None, "q", T1, 1, "b")]
    many = [(f"k{i % 5}", "f", f"q{i}", T0, 1, "v") for i in range(C.NAMED_CELLS + 1)] + [("k0", "f", "q0", T1, 2, "w")]
    at_most = [r for r in many if r[2] != "q1"]
    for some in (rows, [*rows, (None, "f", "q", T1, 1, "b")], many, at_most, rows[400:-1], []):
        cells = _cells(spark, some).repartition(5)
        want = sorted(map(repr, C.latest(cells).collect()))
        assert sorted(map(repr, C.latest_of_repeated(cells).collect())) == want
        spark.conf.set("wideflow.broadcastMaxBytes", "0")
        try:
            assert sorted(map(repr, C.latest_of_repeated(cells).collect())) == want
        finally:
            spark.conf.unset("wideflow.broadcastMaxBytes")


def test_rows_stored_once_are_read_without_an_exchange(spark):
    path = fresh_path(spark, "once")
    S.write_cells(_cells(spark, [(f"k{i:05d}", "f", f"q{q:02d}", T0, 1, f"v{i % 10}") for i in range(500) for q in range(24)]), path)
    plan = C.latest_of_repeated(S.read_cells(spark, path))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    S.write_cells(_cells(spark, [("k00003", "f", "q01", T1, 2, "new")]), path)
    read = C.latest_of_repeated(S.read_cells(spark, path))
    assert read.count() == 500 * 24 and read.where("value = 'new'").count() == 1
