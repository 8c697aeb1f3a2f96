"""Load rules on hand-written edge rows, accounting invariants and lookup paths."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from wideflow.plans import loads
from wideflow.schema import DETAIL_COLS, HEADER_COLS
from wideflow.sources import fixtures as fx

NAMES = [("ACME", "S000001"), ("Blank Co", ""), ("Word Co", "null"), ("Dup", "D1"), ("Dup", "D2"),
         ("Buyer B", "C000009"), ("𝔘nicode", "U000001")]
TAXES = [("TX1", "T000001"), ("TX2", "T000002"), ("TXW", "T000003")]


def _lk(spark):
    return (spark.createDataFrame(NAMES, "row_key string, qybm string"),
            spark.createDataFrame(TAXES, "row_key string, qybm string"))


def _header(spark, rows):
    base = {c: "v" for c in HEADER_COLS}
    full = []
    for r in rows:
        d = dict(base, **r)
        full.append(tuple(d[c] for c in HEADER_COLS))
    return spark.createDataFrame(full, ", ".join(f"{c} string" for c in HEADER_COLS))


def _tag(spark, rows, **kw):
    by_name, by_tax = _lk(spark)
    out = loads.tag_header(_header(spark, rows), by_name, by_tax, "16", **kw).collect()
    return {r.fphm: r for r in out}


GOOD = dict(xfmc="ACME", xfsbh="TX1", gfmc="Buyer B", fpdm="3302100001", kpyf="201905")


def test_header_edge_rows(spark):
    rows = [
        dict(GOOD, fphm="00000001"),
        dict(GOOD, fphm="00000002", xfmc=None),                     # D1: null name -> reject
        dict(GOOD, fphm="00000003", xfmc="?ACME"),
        dict(GOOD, fphm="00000004", xfsbh="null"),
        dict(GOOD, fphm="00000005", xfmc="\t ACME \x01"),            # control chars around the key
        dict(GOOD, fphm="00000006", xfmc="Blank Co", xfsbh="TX2"),  # '' code -> tax fallback
        dict(GOOD, fphm="00000007", xfmc="Word Co", xfsbh="TXX"),   # 'null' code, no tax -> -1
        dict(GOOD, fphm="00000008", gfmc=None),                     # D2: null buyer -> -1
        dict(GOOD, fphm="0000000A"),                                 # non-digit number
        dict(GOOD, fphm="1234567890123456789012"),                   # cut starts past the code
        dict(GOOD, fphm="00000011", kpyf=" 20 "),                    # too short after trim
        dict(GOOD, fphm="00000012", kpyf=None),                      # blank month -> caller's year
        dict(GOOD, fphm="00000013", xfmc="Dup"),                     # duplicate lookup key
        dict(GOOD, fphm="00000014", xfmc="𝔘nicode"),                # above U+FFFF
        dict(GOOD, fphm="00000015", fpdm="null"),
    ]
    t = _tag(spark, rows)
    assert len(t) == len(rows)                                       # no row multiplied or lost
    assert t["00000001"].reject_reason is None and t["00000001"].row_key.startswith("S00000119")
    assert t["00000001"].gfqybm == "C000009"
    assert t["00000002"].reject_reason == "blank_seller_name"
    assert t["00000003"].reject_reason == "garbled_seller_name"
    assert t["00000004"].reject_reason == "blank_seller_tax_id"
    assert t["00000005"].xfqybm == "S000001" and t["00000005"].reject_reason is None
    assert t["00000006"].xfqybm == "T000002"
    assert t["00000007"].reject_reason == "unresolved_seller"
    assert t["00000008"].gfqybm == "-1" and t["00000008"].reject_reason is None
    assert t["0000000A"].reject_reason == "bad_invoice_no"
    assert t["1234567890123456789012"].reject_reason == "bad_invoice_no"
    assert t["00000011"].reject_reason == "bad_month"
    assert t["00000012"].row_key[7:9] == "16"
    assert t["00000013"].xfqybm == "D2"                              # greatest code on duplicates
    assert t["00000014"].xfqybm == "U000001"
    assert t["00000015"].reject_reason == "blank_invoice_code"


def test_header_variants(spark):
    rows = [dict(GOOD, fphm="00000001", xfmc="Blank Co", xfsbh="TX2"),
            dict(GOOD, fphm="00000002", xfmc="no"),
            dict(GOOD, fphm="00000003", xfmc="Word Co", xfsbh="TXX")]
    keep = _tag(spark, rows, rule="keep_empty", variant="preview")
    assert keep["00000001"].xfqybm == ""                              # empty code counts as found
    assert keep["00000002"].reject_reason == "blank_seller_name"      # 'no' is missing here
    assert keep["00000003"].xfqybm == "-1" and keep["00000003"].reject_reason is None  # '-1' passes
    by_name, by_tax = _lk(spark)
    nul = loads.enrich_header(_header(spark, rows[:1] + rows[2:]), by_name, by_tax, rule="nullable",
                              variant="preview").collect()
    got = {r.fphm: r for r in nul}
    assert got["00000003"].xfqybm is None


def test_detail_edge_rows(spark):
    base = {c: "v" for c in DETAIL_COLS}
    good = dict(base, xf_nsrsbh="TX1", fpdm="3302100001", fphm="00000001", fpmxxh="1", kpyf="201905")
    rows = [good, dict(good, fpmxxh="-2"), dict(good, xf_nsrsbh="TXX"), dict(good, kpyf="2019"),
            dict(good, kpyf=" 20   "), dict(good, fpmxxh=None)]
    df = spark.createDataFrame([tuple(r[c] for c in DETAIL_COLS) for r in rows],
                               ", ".join(f"{c} string" for c in DETAIL_COLS))
    _, by_tax = _lk(spark)
    got = [r.reject_reason for r in loads.tag_detail(df, by_tax).orderBy(F.monotonically_increasing_id()).collect()]
    assert sorted(got, key=str) == sorted([None, "dash_in_key", "unresolved_seller", "short_month",
                                           "bad_month", "blank_line_no"], key=str)


@pytest.mark.parametrize("kind", ["header", "detail"])
def test_accounting_invariant(spark, kind):
    if kind == "header":
        src = fx.inv_header(spark, SF_SMALL)
        tagged = loads.tag_header(src, fx.code_by_name(spark, SF_SMALL), fx.code_by_tax(spark, SF_SMALL), "16")
    else:
        src = fx.inv_detail(spark, SF_SMALL)
        tagged = loads.tag_detail(src, fx.code_by_tax(spark, SF_SMALL))
    counts = {r.outcome: r.n for r in loads.reject_counts(tagged).collect()}
    assert sum(counts.values()) == src.count()
    assert 0.5 * src.count() < counts["accepted"] < src.count() and len(counts) > 5


def test_dictionary_path_equals_broadcast_path(spark):
    """Large-lookup plan (key dictionary + attach) gives the same rows as the broadcast plan."""
    args = (fx.inv_header(spark, SF_SMALL), fx.code_by_name(spark, SF_SMALL), fx.code_by_tax(spark, SF_SMALL))
    small = sorted(loads.header_keyed(*args).collect(), key=str)
    spark.conf.set("wideflow.broadcastMaxBytes", "0")
    try:
        df = loads.header_keyed(*args)
        plan = df._jdf.queryExecution().executedPlan().toString()
        large = sorted(df.collect(), key=str)
    finally:
        spark.conf.unset("wideflow.broadcastMaxBytes")
    assert small == large
    assert "_salt" in plan and "_rows0" in plan   # the stored key dictionaries, attached by salted joins


def _hot_header(spark):
    """Header rows where one seller/buyer pair holds a third of all rows."""
    hdr = fx.inv_header(spark, SF_SMALL)
    hot = hdr.withColumn("h", F.xxhash64("fphm") % 3 == 0)
    return (hot.withColumn("xfmc", F.when(F.col("h"), F.lit("Supplier#000000001")).otherwise(F.col("xfmc")))
               .withColumn("xfsbh", F.when(F.col("h"), F.lit("TX00000001")).otherwise(F.col("xfsbh")))
               .withColumn("gfmc", F.when(F.col("h"), F.lit("Customer#000000001")).otherwise(F.col("gfmc")))
               .drop("h"))


def test_one_hot_seller_with_many_buyers(spark):
    """A dictionary is unique on its join key, so a seller with many buyers is one entry."""
    from wideflow.operators.lookup import NO_KEY, lookup_columns
    names = spark.createDataFrame([("hot", "S1"), ("b1", "C1"), ("b7", "C7")], "row_key string, qybm string")
    rows = spark.createDataFrame([("hot" if i % 3 else NO_KEY, f"b{i}") for i in range(600)], "s string, b string")

    def run():
        df = lookup_columns(rows, names, {"s": "sc", "b": "bc"})
        return sorted(df.select("s", "b", "sc", "bc").collect(), key=str), df._jdf.queryExecution().executedPlan().toString()

    got, plan = _with_conf(spark, dict(SHUFFLE_PATH, **{"wideflow.hotKeyMinRows": "10"}), run)
    want = [(s, b, "S1" if s == "hot" else None, {"b1": "C1", "b7": "C7"}.get(b)) for s, b in
            [("hot" if i % 3 else NO_KEY, f"b{i}") for i in range(600)]]
    assert sorted(str(tuple(r)) for r in got) == sorted(map(str, want))
    assert plan.count("_salt") > 1


def _with_conf(spark, conf, fn):
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        return fn()
    finally:
        for k in conf:
            spark.conf.unset(k)


SHUFFLE_PATH = {"wideflow.broadcastMaxBytes": "0", "spark.sql.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.coalescePartitions.enabled": "false"}


def test_hot_key_is_split_on_the_shuffle_path(spark):
    hot = _hot_header(spark)
    by_name, by_tax = fx.code_by_name(spark, SF_SMALL), fx.code_by_tax(spark, SF_SMALL)
    expected = sorted(loads.header_keyed(hot, by_name, by_tax).collect(), key=str)
    conf = dict(SHUFFLE_PATH, **{"wideflow.hotKeyMinRows": "10", "spark.sql.adaptive.skewJoin.enabled": "false"})

    def run():
        df = loads.header_keyed(hot, by_name, by_tax)
        rows = sorted(df.collect(), key=str)
        return rows, df._jdf.queryExecution().executedPlan().toString()

    got, plan = _with_conf(spark, conf, run)
    assert got == expected
    assert "_salt" in plan and "explode" in plan, plan


def test_salting_spreads_only_hot_keys(spark):
    from wideflow.operators.lookup import salt_hot_keys
    rows = [("hot", i) for i in range(300)] + [(f"k{i}", i) for i in range(100)]
    df = spark.createDataFrame(rows, "k string, v long")
    resolved = df.groupBy("k").agg(F.count(F.lit(1)).alias("_rows")).withColumn("code", F.upper("k"))

    def run():
        wide, dictionary = salt_hot_keys(df, resolved, ["k"], "_rows")
        w = {(r.k, r.n) for r in wide.groupBy("k").agg(F.count_distinct("_salt").alias("n")).collect()}
        d = {r.k: r.n for r in dictionary.groupBy("k").agg(F.count(F.lit(1)).alias("n")).collect()}
        joined = sorted(wide.join(dictionary, ["k", "_salt"], "left").select("k", "v", "code").collect())
        return w, d, joined

    w, d, joined = _with_conf(spark, {"wideflow.hotKeyMinRows": "10", "spark.sql.shuffle.partitions": "8"}, run)
    # share = 400 // 8 = 50 rows, so the hot key gets ceil(300 / 50) = 6 salts
    assert ("hot", 6) in w and d["hot"] == 6
    assert all(n == 1 for k, n in w if k != "hot") and all(n == 1 for k, n in d.items() if k != "hot")
    assert joined == sorted(df.join(resolved, "k", "left").select("k", "v", "code").collect())


def test_detail_large_lookup_path_equals_broadcast_path(spark):
    args = (fx.inv_detail(spark, SF_SMALL), fx.code_by_tax(spark, SF_SMALL))
    small = sorted(loads.detail_keyed(*args).collect())
    large = _with_conf(spark, dict(SHUFFLE_PATH, **{"wideflow.hotKeyMinRows": "10"}),
                       lambda: sorted(loads.detail_keyed(*args).collect()))
    assert small == large


def test_lookup_from_cell_table_uses_latest_version(spark):
    import datetime as dt
    from wideflow.operators.enrich import seller_code_by_tax
    from wideflow.operators.lookup import lookup_from_cells
    t0, t1 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)
    cells = spark.createDataFrame(
        [("TX1", "qyxx", "qybm", t0, 1, "OLD"), ("TX1", "qyxx", "qybm", t1, 1, "NEW"),
         ("TX2", "qyxx", "other", t1, 1, "IGNORED"), ("TX3", "qyxx", "qybm", t0, 1, "null")],
        "row_key string, family string, qualifier string, ts timestamp_ntz, seq long, value string")
    lk = lookup_from_cells(cells)
    rows = spark.createDataFrame([("TX1",), ("TX2",), ("TX3",), (" TX1 ",)], "xf_nsrsbh string")
    got = {r.xf_nsrsbh: r.xfqybm for r in seller_code_by_tax(rows, lk).collect()}
    assert got == {"TX1": "NEW", "TX2": "-1", "TX3": "-1", " TX1 ": "NEW"}


@pytest.mark.parametrize("layout", ["put", "bulk"])
def test_colliding_invoices_never_mix(spark, layout):
    """Every stored row equals one accepted input row, also where several invoices share a key."""
    from wideflow.operators import cells as C
    from wideflow.plans import store
    from wideflow.schema import HEADER_STORED_COLS
    from wideflow.session import fresh_path
    from wideflow.sinks import files as S
    args = (fx.inv_header(spark, SF_SMALL), fx.code_by_name(spark, SF_SMALL), fx.code_by_tax(spark, SF_SMALL))
    path = fresh_path(spark, "t-collide")
    store.load_header(*args, "16", path, layout=layout, num_partitions=3)
    fill = "null" if layout == "put" else "-1"
    blank = {None, ""} if layout == "put" else {None, "", "null"}
    rows = [tuple(r) for r in loads.header_keyed(*args).select("row_key", *HEADER_STORED_COLS).collect()]
    accepted = {(r[0], *(fill if v in blank else v for v in r[1:])) for r in rows}
    stored = [tuple(r) for r in C.to_wide(S.read_cells(spark, path), "fpxx", HEADER_STORED_COLS).collect()]
    assert len(stored) == len({r[0] for r in rows}) < len(rows)
    assert set(stored) <= accepted
    assert S.read_cells(spark, path).count() == 24 * len(stored)


def test_rerun_of_a_batch_replaces_it(spark):
    import datetime as dt
    from wideflow.plans import store
    from wideflow.session import fresh_path
    from wideflow.sinks import files as S
    args = (fx.inv_header(spark, SF_SMALL), fx.code_by_name(spark, SF_SMALL), fx.code_by_tax(spark, SF_SMALL))
    path, rejects = fresh_path(spark, "t-rerun"), fresh_path(spark, "t-rerun-rejects")
    seen = []
    for seq in (5, 6, 6):
        store.load_header(*args, "16", path, rejects, layout="put", run_ts=dt.datetime(2024, 1, seq), seq=seq, replace=True)
        seen.append((sorted(S.read_cells(spark, path).collect(), key=str), spark.read.parquet(rejects).count()))
    assert seen[1] == seen[2] and len(seen[1][0]) == 2 * len(seen[0][0]) and seen[1][1] == 2 * seen[0][1]
