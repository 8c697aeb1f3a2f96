"""Plan shapes that matter at scale."""

import re

from conftest import SF_SMALL
from test_cells import plan_text
from wideflow.operators import cells as C
from wideflow.plans import loads, store
from wideflow.sinks import files as S
from wideflow.sources import fixtures as fx


def _lk(spark):
    return fx.code_by_name(spark, SF_SMALL), fx.code_by_tax(spark, SF_SMALL)


def test_small_lookups_never_shuffle_the_wide_rows(spark):
    df = loads.header_keyed(fx.inv_header(spark, SF_SMALL), *_lk(spark))
    plan = plan_text(spark, df)
    assert plan.count("BroadcastHashJoin") >= 3
    for key in ("_name_key", "_tax_key", "_buyer_key"):
        assert f"hashpartitioning({key}" not in plan, key


def test_each_lookup_is_planned_on_its_own(spark):
    """Large names, small tax ids: the names' dictionary is attached by salted joins, the tax ids are broadcast."""
    from pyspark.sql import functions as F
    header = fx.inv_header(spark, SF_SMALL)
    names, taxes = _lk(spark)
    wide = names.unionByName(spark.range(2000).select(F.concat(F.lit("other"), "id").alias("row_key"), F.lit("X").alias("qybm")))
    conf = {"wideflow.broadcastMaxBytes": "9000", "spark.sql.autoBroadcastJoinThreshold": "-1", "wideflow.hotKeyMinRows": "10"}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        plan = plan_text(spark, loads.header_keyed(header, wide, taxes))
    finally:
        for k in conf:
            spark.conf.unset(k)
    assert "hashpartitioning(_tax_key" not in plan
    # every shuffle join on a name carries the salt; a dictionary's own key is unique
    for key in re.findall(r"hashpartitioning\(([^)]*)\)", plan):
        assert ("_name_key" not in key and "_buyer_key" not in key) or "_salt" in key, key


def test_loads_exchange_wide_rows_once(spark):
    """After the lookups: one exchange on row_key, rows (not cells) sorted, unpivoted above the window."""
    rows = loads.header_keyed(fx.inv_header(spark, SF_SMALL), *_lk(spark))
    cells = C.stamp(store.header_cells(S.by_key_range(rows)), store.now_utc(), 1)
    plan = plan_text(spark, cells)
    # the lookups' own de-duplication is all that is hashed by a row_key
    lookups = plan_text(spark, rows).count("hashpartitioning(row_key")
    assert plan.count("rangepartitioning(row_key") == 1 and plan.count("hashpartitioning(row_key") == lookups, plan
    tree = plan.split("\n\n")[0]
    assert tree.index("Expand") < tree.index("Window")


def test_bulk_write_is_range_partitioned_and_sorted(spark):
    cells = C.stamp(store.header_cells(loads.header_keyed(fx.inv_header(spark, SF_SMALL), *_lk(spark))),
                    store.now_utc(), 1)
    parts = cells.repartitionByRange("row_key").sortWithinPartitions(*S.SORT_KEY)
    plan = plan_text(spark, parts)
    assert "rangepartitioning(row_key" in plan
    # family is a constant here, so the optimizer drops it from the sort keys
    assert re.search(r"Arguments: \[(family#\d+ ASC NULLS FIRST, )?row_key#\d+ ASC NULLS FIRST, "
                     r"qualifier#\d+ ASC NULLS FIRST\], false", plan), plan


def test_version_resolution_is_one_shuffle_with_partial_aggregation(spark):
    plan = plan_text(spark, C.latest(fx.cells(spark, SF_SMALL)))
    assert plan.count("Arguments: hashpartitioning(row_key") == 1
    assert "partial_max" in plan
