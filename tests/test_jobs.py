"""Command-line jobs end to end on stored tables (lookups given as cell tables)."""

import datetime as dt

from conftest import SF_SMALL
from wideflow.operators import cells as C
from wideflow.plans import jobs, loads
from wideflow.session import fresh_path
from wideflow.sinks import files as S
from wideflow.sources import fixtures as fx


def _as_lookup_cells(df):
    return C.stamp(df.select("row_key", "qybm").withColumnRenamed("qybm", "value")
                   .selectExpr("row_key", "'qyxx' AS family", "'qybm' AS qualifier", "value"),
                   dt.datetime(2024, 1, 1), 1)


def test_jobs_end_to_end(spark):
    hdr, names, taxes = (fresh_path(spark, n) for n in ("j-hdr", "j-names", "j-taxes"))
    fx.inv_header(spark, SF_SMALL).write.parquet(hdr)
    S.write_cells(_as_lookup_cells(fx.code_by_name(spark, SF_SMALL)), names)
    S.write_cells(_as_lookup_cells(fx.code_by_tax(spark, SF_SMALL)), taxes)
    target, rejects = fresh_path(spark, "j-target"), fresh_path(spark, "j-rejects")
    jobs.run(["load-header", "--table", hdr, "--by-name", names, "--by-tax", taxes, "--target", target,
              "--rejects", rejects, "--year", "16", "--lookup-cells"], spark)
    n = jobs.run(["count-rows", "--table", target], spark)
    keys = [r.row_key for r in loads.header_keyed(
        fx.inv_header(spark, SF_SMALL), fx.code_by_name(spark, SF_SMALL), fx.code_by_tax(spark, SF_SMALL)).collect()]
    expected = sorted(set(keys))
    assert n == len(expected) < len(keys)                        # colliding invoices share a row
    assert spark.read.parquet(rejects).count() == 1500 - len(keys)

    got = sorted({r.row_key for r in S.read_cells(spark, target).select("row_key").collect()})
    assert got == expected

    copy = fresh_path(spark, "j-copy")
    jobs.run(["merge", "--source", target, "--target", copy, "--family", "fpxx", "--start", expected[10]], spark)
    assert jobs.run(["count-rows", "--table", copy], spark) == len(expected) - 10

    shared = fresh_path(spark, "j-shared")
    jobs.run(["key-collisions", "--table", hdr, "--by-name", names, "--by-tax", taxes, "--year", "16", "--lookup-cells",
              "--out", shared], spark)
    found = {r.row_key for r in spark.read.parquet(shared).collect()}
    assert found and found <= {k for k in keys if keys.count(k) > 1}

    csv = fresh_path(spark, "j-csv")
    jobs.run(["export", "--table", target, "--family", "fpxx", "--columns", "fpdm,fphm,xfqybm",
              "--where", "xfqybm LIKE 'S%'", "--csv", csv], spark)
    assert spark.read.csv(csv).count() > 0

    quals = fresh_path(spark, "j-quals")
    jobs.run(["qualifiers", "--table", target, "--family", "fpxx", "--out", quals], spark)
    assert spark.read.parquet(quals).count() == len(expected) * 24

    compacted = fresh_path(spark, "j-compact")
    jobs.run(["compact", "--source", target, "--target", compacted], spark)
    assert sorted(C.latest(S.read_cells(spark, compacted)).collect()) == sorted(C.latest(S.read_cells(spark, target)).collect())
