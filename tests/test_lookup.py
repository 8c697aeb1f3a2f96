"""Lookups: what a key dictionary is made of, and how the stages that use it are compiled."""

import json

from wideflow.operators import enrich, lookup
from wideflow.schema import HEADER_COLS


def _header(spark):
    rows = [tuple({"xfmc": n, "xfsbh": t, "gfmc": b}.get(c) for c in HEADER_COLS)
            for n, t, b in (("s1", "t1", "s2"), ("s2", "t2", None), ("s3", "t1", "s1"), (" s1 ", "t9", "s9"), ("s1", "t1", "s2"))]
    return spark.createDataFrame(rows, ", ".join(f"{c} string" for c in HEADER_COLS))


def test_second_dictionary_does_not_run_the_first_lookup(spark, monkeypatch):
    seen, measure = [], lookup.measure

    def watched(df, max_bytes=None, persist=True):
        if persist:
            seen.append(json.loads(df._jdf.queryExecution().optimizedPlan().toJSON()))
        return measure(df, max_bytes, persist)
    monkeypatch.setattr(lookup, "measure", watched)
    by_name = spark.createDataFrame([("s1", "N1"), ("s2", "null")], "row_key string, qybm string")
    by_tax = spark.createDataFrame([("t1", "T1"), ("t2", "T2")], "row_key string, qybm string")
    got = enrich.header_codes(_header(spark), by_name, by_tax, max_bytes=0).select("xfmc", "gfqybm", "xfqybm").collect()
    assert sorted(map(tuple, got)) == [(" s1 ", "-1", "N1"), ("s1", "-1", "N1"), ("s1", "-1", "N1"), ("s2", "-1", "T2"), ("s3", "N1", "T1")]
    joins = [sum(n["class"].endswith(".Join") for n in plan) for plan in seen]
    assert joins == [1, 1]  # each with its own lookup; the second one held the first one's joins too


def test_limit_of_compiled_methods(spark):
    key, value = lookup.HUGE_METHOD
    by_tax = spark.createDataFrame([("t1", "T1")], "row_key string, qybm string")
    try:
        spark.conf.unset(key)
        enrich.seller_code_by_tax(_header(spark), by_tax, "xfsbh")
        assert spark.conf.get(key) == value
        spark.conf.set(key, "60000")
        enrich.seller_code_by_tax(_header(spark), by_tax, "xfsbh")
        assert spark.conf.get(key) == "60000"  # the caller's choice stays
    finally:
        spark.conf.unset(key)


def test_column_of_few_keys_is_broadcast_beside_one_of_many(spark):
    names = [(f"s{i % 5}", f"b{i}") for i in range(200)]
    header = spark.createDataFrame([tuple({"xfmc": s, "gfmc": b}.get(c) for c in HEADER_COLS) for s, b in names],
                                   ", ".join(f"{c} string" for c in HEADER_COLS))
    by_name = spark.createDataFrame([(k, k.upper()) for pair in names for k in pair], "row_key string, qybm string")
    by_tax = spark.createDataFrame([("t1", "T1")], "row_key string, qybm string")
    got = enrich.header_codes(header, by_name, by_tax, max_bytes=1000)
    salted = [line for line in got._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join" in line and "_salt#" in line]
    assert any("_buyer_key" in line for line in salted) and not any("_name_key" in line for line in salted)
    rows = got.select("xfmc", "gfmc", "xfqybm", "gfqybm").collect()
    assert sorted(map(tuple, rows)) == sorted((s, b, s.upper(), b.upper()) for s, b in names)
