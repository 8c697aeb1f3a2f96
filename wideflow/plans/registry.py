"""Registered queries: name -> (Spark builder, DuckDB oracle SQL or None).

Each builder takes ``(spark, sf_dir)`` and returns a DataFrame over the whole
tables in ``sf_dir``. Column names are identical on both sides. Builders of
write paths (upserts, bulk layout, CSV, text) write to a fresh folder under the
session's checkpoint folder and return what they read back.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import keys as K
from ..functions import text as X
from ..operators import cells as C
from ..operators import merge as M
from ..operators.enrich import header_codes, seller_code_by_tax
from ..operators.lookup import lookup_columns
from ..schema import DETAIL_COLS, HEADER_COLS, HEADER_FAMILY, HEADER_STORED_COLS
from ..session import fresh_path
from ..sinks import bounds
from ..sinks import bucketed as B
from ..sinks import files as S
from ..sources import fixtures as fx
from ..sources.tables import scan_detail, scan_header, scan_tasks
from ..streaming import sync as stream_sync
from . import loads, store
from . import oracle as O

Builder = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[Builder, str | None]] = {}

YEAR = "16"
RUN_TS = dt.datetime(2024, 2, 1)
SPLIT_TS = dt.datetime(2024, 1, 16)
KEY_FROM, KEY_TO = "00000010", "00000100"
RANGE_FROM, RANGE_TO = "00000010", "00000020"
T_FROM, T_TO = dt.datetime(2024, 1, 8), dt.datetime(2024, 1, 15)
EV_NAMES = ["click", "error", "purchase", "signup", "view"]
PREVIEW_N = 10
SALT = "wideflow-demo-salt"

W = O.with_

WIDE_SQL = ", ".join(
    f"max(CASE WHEN family = 'ev' AND qualifier = '{n}' THEN value END) AS {n}" for n in EV_NAMES)


def register(name: str, sql: str | None):
    def deco(fn: Builder) -> Builder:
        REGISTRY[name] = (fn, sql)
        return fn
    return deco


def _lk(spark, sf_dir):
    return fx.code_by_name(spark, sf_dir), fx.code_by_tax(spark, sf_dir)


def _hdr(spark, sf_dir):
    return fx.inv_header(spark, sf_dir)


def _dtl(spark, sf_dir):
    return fx.inv_detail(spark, sf_dir)


def _header_keyed(spark, sf_dir, **kw):
    return loads.header_keyed(_hdr(spark, sf_dir), *_lk(spark, sf_dir), year=YEAR, **kw)


def _detail_keyed(spark, sf_dir):
    return loads.detail_keyed(_dtl(spark, sf_dir), fx.code_by_tax(spark, sf_dir))


def _blank_some_codes(by_name: DataFrame) -> DataFrame:
    """Lookup twist for the variant rules: codes of keys ending in '3' become ''."""
    return by_name.withColumn("qybm", F.when(F.right("row_key", F.lit(1)) == "3", F.lit("")).otherwise(F.col("qybm")))


LOOKUPS_BLANKED = (O.fixtures_cte("code_by_name", "code_by_tax") + ",\n"
                   "nm AS (SELECT row_key, max(CASE WHEN right(row_key, 1) = '3' THEN '' ELSE qybm END) AS qybm "
                   "FROM code_by_name WHERE row_key IS NOT NULL AND row_key <> '' GROUP BY row_key),\n"
                   "tx AS (SELECT row_key, max(qybm) AS qybm FROM code_by_tax WHERE row_key IS NOT NULL AND row_key <> '' GROUP BY row_key)")

HK = O.header_keyed_cte(YEAR)
DK = O.detail_keyed_cte()
CELLS = O.fixtures_cte("cells")
TS = lambda d: f"TIMESTAMP '{d.isoformat(sep=' ')}'"


# =============================================================== sources (SRC)

@register("scan_header", W(O.fixtures_cte("inv_header"), f"SELECT {O.HEADER21} FROM inv_header"))
def q_scan_header(spark, sf_dir):
    return scan_header(spark, _hdr(spark, sf_dir))


@register("scan_detail", W(O.fixtures_cte("inv_detail"), f"SELECT {O.DETAIL16} FROM inv_detail"))
def q_scan_detail(spark, sf_dir):
    return scan_detail(spark, _dtl(spark, sf_dir))


@register("cells_latest", W(CELLS, O.latest_sql("cells")))
def q_cells_latest(spark, sf_dir):
    return C.latest(fx.cells(spark, sf_dir))


@register("cells_key_range", W(CELLS, O.latest_sql(
    f"(SELECT * FROM cells WHERE row_key >= '{RANGE_FROM}' AND row_key < '{RANGE_TO}')")))
def q_cells_key_range(spark, sf_dir):
    return C.scan(fx.cells(spark, sf_dir), start=RANGE_FROM, stop=RANGE_TO)


@register("cells_key_from", W(CELLS, O.latest_sql(f"(SELECT * FROM cells WHERE row_key >= '{KEY_TO}')")))
def q_cells_key_from(spark, sf_dir):
    return C.scan(fx.cells(spark, sf_dir), start=KEY_TO)


@register("cells_time_range", W(CELLS, O.latest_sql(
    f"(SELECT * FROM cells WHERE ts >= {TS(T_FROM)} AND ts < {TS(T_TO)})")))
def q_cells_time_range(spark, sf_dir):
    return C.scan(fx.cells(spark, sf_dir), ts_from=T_FROM, ts_to=T_TO)


@register("cells_at_ts", W(CELLS, O.latest_sql("(SELECT * FROM cells WHERE ts = (SELECT min(ts) FROM cells))")))
def q_cells_at_ts(spark, sf_dir):
    cells = fx.cells(spark, sf_dir)
    return C.scan(cells, at_ts=cells.agg(F.min("ts")).scalar())  # a subquery, run with the query


@register("multi_get", W(CELLS + ",\nk AS (SELECT lpad(CAST(c_custkey AS STRING), 8, '0') AS row_key FROM customer),\n"
                         "hit AS (" + O.latest_sql("(SELECT * FROM cells WHERE family = 'ev' AND qualifier = 'purchase')",
                                                   part="row_key", cols="row_key, value") + ")",
                         "SELECT k.row_key, hit.value FROM k LEFT JOIN hit ON k.row_key = hit.row_key"))
def q_multi_get(spark, sf_dir):
    keys = fx.read_table(spark, sf_dir, "customer").select(
        F.lpad(F.col("c_custkey").cast("string"), 8, "0").alias("row_key"))
    return C.multi_get(fx.cells(spark, sf_dir), keys, "ev", "purchase")


# ================================================================= sinks (SNK)

def _cells_out(df):
    return df.select("row_key", "family", "qualifier", "value")


HK_LWW = O.dedupe_sql("hk", "row_key", O.HEADER24, "row_key, " + O.HEADER24)
HK1 = HK + f",\nh1 AS ({HK_LWW})"


@register("dedupe_header_keys", W(HK, HK_LWW))
def q_dedupe_header_keys(spark, sf_dir):
    return store.header_rows_lww(_header_keyed(spark, sf_dir))


@register("upsert_header", W(HK1, O.unpivot_sql("h1", O.HEADER24, "fpxx", O.fill_nw)))
def q_upsert_header(spark, sf_dir):
    path = fresh_path(spark, "upsert_header")
    store.load_header(_hdr(spark, sf_dir), *_lk(spark, sf_dir), YEAR, path, layout="put")
    return _cells_out(C.latest_by_row(S.read_cells(spark, path)))


@register("stream_header_upsert", W(HK1, O.unpivot_sql("h1", O.HEADER24, "fpxx", O.fill_nw)))
def q_stream_header_upsert(spark, sf_dir):
    """Orders arrive as a file stream; the header view is a stream-static join;
    each micro-batch is loaded into the cell table (run to completion here)."""
    orders = stream_sync.read_stream(spark, sf_dir, fx.read_table(spark, sf_dir, "orders").schema,
                                     file_glob="orders.parquet")
    sql, _ = fx.FIXTURES["inv_header"]
    header = spark.sql(sql, orders=orders, customer=fx.read_table(spark, sf_dir, "customer"),
                       lineitem=fx.read_table(spark, sf_dir, "lineitem"), supplier=fx.read_table(spark, sf_dir, "supplier"))
    path, ckpt = fresh_path(spark, "stream_header"), fresh_path(spark, "stream_ckpt")
    q = stream_sync.start_header_load(header, *_lk(spark, sf_dir), YEAR, path, ckpt, available_now=True)
    q.awaitTermination()
    return _cells_out(C.latest_by_row(S.read_cells(spark, path), pack=False))


DK_LWW = O.dedupe_sql("dk", "row_key", O.DETAIL16, "row_key, " + O.DETAIL16 + ", xfqybm")


@register("upsert_detail", W(DK + f",\nd1 AS ({DK_LWW})", O.unpivot_sql("d1", O.DETAIL16, "fpmx", O.fill_m1)))
def q_upsert_detail(spark, sf_dir):
    path = fresh_path(spark, "upsert_detail")
    store.load_detail(_dtl(spark, sf_dir), fx.code_by_tax(spark, sf_dir), path, layout="put")
    return _cells_out(C.latest_by_row(S.read_cells(spark, path)))


@register("bulk_header_cells", W(HK1, O.unpivot_sql("h1", O.HEADER24, "fpxx", O.fill_m1)))
def q_bulk_header_cells(spark, sf_dir):
    path = fresh_path(spark, "bulk_header")
    store.load_header(_hdr(spark, sf_dir), *_lk(spark, sf_dir), YEAR, path, layout="bulk")
    return _cells_out(C.latest_by_row(S.read_cells(spark, path), pack=False))


@register("aligned_header_cells", W(HK1, O.unpivot_sql("h1", O.HEADER24, "fpxx", O.fill_m1)))
def q_aligned_header_cells(spark, sf_dir):
    """The header load run twice in the aligned layout: the second batch's files are cut at the split points that the first one left."""
    path = fresh_path(spark, "aligned_header")
    eighth = -(-fx.read_table(spark, sf_dir, "orders").count() // 8)  # at least eight ranges, also of small tables
    for _ in range(2):
        store.load_header(_hdr(spark, sf_dir), *_lk(spark, sf_dir), YEAR, path, layout="aligned",
                          rows_per_range=max(1, min(eighth, bounds.ROWS_PER_RANGE)))
    return _cells_out(C.latest_by_row(S.read_cells(spark, path)))


TGT = f"(SELECT * FROM cells WHERE ts >= {TS(SPLIT_TS)})"
SRC = f"(SELECT * FROM cells WHERE ts < {TS(SPLIT_TS)} AND qualifier IN ('click', 'view'))"


def _merge_sql(target: str, source_sel: str, restamp: bool = True) -> str:
    ts = TS(RUN_TS) if restamp else "ts"
    return W(CELLS + f",\nsl AS ({O.latest_sql(source_sel)}),\n"
             f"sb AS (SELECT row_key, family, qualifier, {ts} AS ts, seq, value FROM sl),\n"
             f"u AS (SELECT row_key, family, qualifier, ts, seq, value FROM {target} t UNION ALL SELECT * FROM sb)",
             O.latest_sql("u"))


SRC_KEYS = f"(SELECT * FROM {SRC} s WHERE family = 'ev' AND row_key >= '{KEY_FROM}' AND row_key < '{KEY_TO}')"


def _target(spark, sf_dir):
    return fx.cells(spark, sf_dir).filter(F.col("ts") >= C.ts_lit(SPLIT_TS))


def _source(spark, sf_dir):
    return fx.cells(spark, sf_dir).filter((F.col("ts") < C.ts_lit(SPLIT_TS))
                                          & F.col("qualifier").isin("click", "view"))


@register("merge_by_key_range", _merge_sql(TGT, SRC_KEYS))
def q_merge_by_key_range(spark, sf_dir):
    return M.merge_cells(_target(spark, sf_dir), _source(spark, sf_dir), RUN_TS, "write_time",
                         family="ev", start=KEY_FROM, stop=KEY_TO)


@register("merge_keep_source_ts", _merge_sql(TGT, SRC_KEYS, restamp=False))
def q_merge_keep_source_ts(spark, sf_dir):
    return M.merge_cells(_target(spark, sf_dir), _source(spark, sf_dir), ts_policy="source",
                         family="ev", start=KEY_FROM, stop=KEY_TO)


@register("merge_insert_new_cells", _merge_sql(f"(SELECT * FROM {TGT} t0 WHERE qualifier <> 'view')", SRC_KEYS))
def q_merge_insert_new_cells(spark, sf_dir):
    target = _target(spark, sf_dir).filter(F.col("qualifier") != "view")
    return M.merge_cells(target, _source(spark, sf_dir), RUN_TS, family="ev", start=KEY_FROM, stop=KEY_TO)


@register("stream_detail_upsert", W(DK + f",\nd1 AS ({DK_LWW})", O.unpivot_sql("d1", O.DETAIL16, "fpmx", O.fill_m1)))
def q_stream_detail_upsert(spark, sf_dir):
    """Order lines arrive as a file stream, joined with the static tables of the line view; each micro-batch is loaded."""
    lines = stream_sync.read_stream(spark, sf_dir, fx.read_table(spark, sf_dir, "lineitem").schema, file_glob="lineitem.parquet")
    sql, tables = fx.FIXTURES["inv_detail"]
    detail = spark.sql(sql, **{t: lines if t == "lineitem" else fx.read_table(spark, sf_dir, t) for t in tables})
    path, ckpt = fresh_path(spark, "stream_detail"), fresh_path(spark, "stream_ckpt")
    q = stream_sync.start_detail_load(detail, fx.code_by_tax(spark, sf_dir), path, ckpt, available_now=True)
    q.awaitTermination()
    return _cells_out(C.latest_of_repeated(S.read_cells(spark, path)))


@register("compact_in_place", W(CELLS, O.latest_sql("cells")))
def q_compact_in_place(spark, sf_dir):
    """Cells stored in two batches (older and newer half), compacted into one batch of the same table."""
    path = fresh_path(spark, "compact_in_place")
    S.write_cells(_target(spark, sf_dir), path)
    S.write_cells(fx.cells(spark, sf_dir).filter(F.col("ts") < C.ts_lit(SPLIT_TS)), path)
    store.compact(spark, path)
    return S.read_cells(spark, path)


def _stored_in_batches(spark, sf_dir, name: str) -> str:
    """The cells stored in bulk layout as four batches that follow each other in time."""
    path, cells = fresh_path(spark, name), fx.cells(spark, sf_dir)
    bounds = [None, *sorted((T_FROM, SPLIT_TS, T_TO), key=str), None]
    for low, high in zip(bounds, bounds[1:]):
        S.write_cells_sorted(C.select_versions(cells, ts_from=low, ts_to=high), path)
    return path


@register("stored_time_range", W(CELLS, O.latest_sql(f"(SELECT * FROM cells WHERE ts >= {TS(T_FROM)} AND ts < {TS(T_TO)})")))
def q_stored_time_range(spark, sf_dir):
    """A time range of a stored table: files of batches outside it are not opened."""
    return store.scan_stored(spark, _stored_in_batches(spark, sf_dir, "stored_time_range"), ts_from=T_FROM, ts_to=T_TO)


@register("multi_get_stored", W(CELLS + ",\nk AS (SELECT lpad(CAST(c_custkey AS STRING), 8, '0') AS row_key FROM customer),\n"
                                "l AS (" + O.latest_sql("(SELECT * FROM cells WHERE family = 'ev' AND qualifier = 'click')") + ")",
                                "SELECT k.row_key, l.value FROM k LEFT JOIN l ON k.row_key = l.row_key"))
def q_multi_get_stored(spark, sf_dir):
    """A batch of point reads on a stored table: only files whose key ranges hold some of the keys are opened."""
    keys = fx.read_table(spark, sf_dir, "customer").select(F.lpad(F.col("c_custkey").cast("string"), 8, "0").alias("row_key"))
    return store.multi_get_stored(spark, _stored_in_batches(spark, sf_dir, "multi_get_stored"), keys, "ev", "click")


@register("compact_ranges", W(CELLS, O.latest_sql("cells")))
def q_compact_ranges(spark, sf_dir):
    """Four batches of a stored table, of which the files that overlap more than two deep are compacted."""
    path = _stored_in_batches(spark, sf_dir, "compact_ranges")
    store.compact_ranges(spark, path, depth=2)
    return C.latest(S.read_cells(spark, path))


LATE_TS = dt.datetime(2031, 1, 1)


@register("merge_incremental", W(
    CELLS + f",\nl AS ({O.latest_sql('cells')})",
    f"SELECT row_key, family, qualifier, CASE WHEN ts >= {TS(SPLIT_TS)} THEN {TS(RUN_TS)} ELSE {TS(LATE_TS)} END AS ts, seq, value FROM l"))
def q_merge_incremental(spark, sf_dir):
    """The newer half is synced, then the older half arrives late and is synced: it adds cells, but brings no older value back.
    A third run finds nothing to copy."""
    source, target = fresh_path(spark, "incremental_source"), fresh_path(spark, "incremental_target")
    S.write_cells(_target(spark, sf_dir), source)
    store.sync_new(spark, source, target, RUN_TS)
    S.write_cells(fx.cells(spark, sf_dir).filter(F.col("ts") < C.ts_lit(SPLIT_TS)), source)
    store.sync_new(spark, source, target, LATE_TS)
    store.sync_new(spark, source, target, LATE_TS + dt.timedelta(days=1))
    return C.latest(S.read_cells(spark, target))


def _stored_sync(spark, sf_dir, **kw):
    tpath = fresh_path(spark, "sync_target")
    S.write_cells(_target(spark, sf_dir), tpath)
    store.sync_cells(kw.pop("source"), tpath, run_ts=RUN_TS, family="ev", **{"layout": "bulk", **kw})
    return C.latest(S.read_cells(spark, tpath))


@register("merge_bulk_from_key", _merge_sql(
    TGT, f"(SELECT * FROM {SRC} s WHERE family = 'ev' AND row_key >= '{KEY_FROM}')"))
def q_merge_bulk_from_key(spark, sf_dir):
    return _stored_sync(spark, sf_dir, source=_source(spark, sf_dir), start=KEY_FROM)


@register("merge_put_stored", _merge_sql(TGT, SRC_KEYS))
def q_merge_put_stored(spark, sf_dir):
    """A Put-style merge into a stored table, with the caller's number of tasks."""
    return _stored_sync(spark, sf_dir, source=_source(spark, sf_dir), start=KEY_FROM, stop=KEY_TO, layout="put", num_partitions=4)


@register("merge_bulk_time_range", _merge_sql(
    TGT, f"(SELECT * FROM cells WHERE family = 'ev' AND ts >= {TS(T_FROM)} AND ts < {TS(T_TO)})"))
def q_merge_bulk_time_range(spark, sf_dir):
    return _stored_sync(spark, sf_dir, source=fx.cells(spark, sf_dir), ts_from=T_FROM, ts_to=T_TO)


@register("compact_cells", W(CELLS, O.latest_sql("cells")))
def q_compact_cells(spark, sf_dir):
    """Cells stored in two batches (older and newer half), compacted into a new folder."""
    cells = fx.cells(spark, sf_dir)
    src, dst = fresh_path(spark, "compact_src"), fresh_path(spark, "compact_dst")
    S.write_cells(_target(spark, sf_dir), src)
    S.write_cells(cells.filter(F.col("ts") < C.ts_lit(SPLIT_TS)), src)
    store.compact(spark, src, dst)
    return S.read_cells(spark, dst)


def _bucketed_cells(spark, sf_dir):
    """The cells stored as a bucketed table in two batches (older, newer); buckets follow the input's size."""
    buckets = max(8, 4 * scan_tasks(fx.read_table(spark, sf_dir, "events")))
    name = "wf_cells_" + fresh_path(spark, "b").rsplit("-", 1)[-1]
    path = fresh_path(spark, "bucketed_cells")
    cells = fx.cells(spark, sf_dir)
    B.write_bucketed(cells.filter(F.col("ts") < C.ts_lit(SPLIT_TS)), name, path, buckets)
    B.write_bucketed(_target(spark, sf_dir), name, path, buckets)
    return B.read_bucketed(spark, name)


@register("bucketed_cells_latest", W(CELLS, O.latest_sql("cells")))
def q_bucketed_cells_latest(spark, sf_dir):
    """Version resolution on a bucketed cell table: no shuffle in the plan."""
    return C.latest(_bucketed_cells(spark, sf_dir))


@register("bucketed_cells_to_wide", W(CELLS + ",\nl AS (" + O.latest_sql("cells") + ")",
                                      f"SELECT row_key, {WIDE_SQL} FROM l GROUP BY row_key"))
def q_bucketed_cells_to_wide(spark, sf_dir):
    return C.to_wide(_bucketed_cells(spark, sf_dir), "ev", EV_NAMES, one_scan=True)


DETAIL_SQL_FILTER = "fpdm = fphm AND flbm = ''"
FILTERED = W(O.fixtures_cte("inv_detail"), f"SELECT {O.DETAIL16} FROM inv_detail WHERE {DETAIL_SQL_FILTER}")


@register("csv_append_roundtrip", W(O.fixtures_cte("inv_detail") + f",\nf AS (SELECT {O.DETAIL16} FROM inv_detail "
                                    f"WHERE {DETAIL_SQL_FILTER})", "SELECT * FROM f UNION ALL SELECT * FROM f"))
def q_csv_append_roundtrip(spark, sf_dir):
    path = fresh_path(spark, "csv")
    df = _sql_view_filter(spark, sf_dir)
    S.write_csv(df, path, mode="append")
    S.write_csv(df, path, mode="append")
    schema = T.StructType([T.StructField(c, T.StringType()) for c in DETAIL_COLS])
    return S.read_csv(spark, path, schema)


@register("cell_text_lines", W(CELLS + ",\nl AS (" + O.latest_sql(
    "(SELECT * FROM cells WHERE family = 'ev' AND qualifier = 'click')") + ")",
    "SELECT concat_ws(',', row_key, value) AS line FROM l"))
def q_cell_text_lines(spark, sf_dir):
    path = fresh_path(spark, "text")
    latest = C.scan(fx.cells(spark, sf_dir), families=["ev"], qualifiers=["click"])
    S.write_text_lines(latest, path, ["row_key", "value"])
    return spark.read.text(path).withColumnRenamed("value", "line")


@register("preview_header", W(HK, f"SELECT * FROM hk ORDER BY row_key LIMIT {PREVIEW_N}"))
def q_preview_header(spark, sf_dir):
    return S.preview(_header_keyed(spark, sf_dir), PREVIEW_N, ["row_key"])


# ===================================================== projections (PRJ)

@register("enrich_header", W(O.enriched_cte(), "SELECT * FROM enr"))
def q_enrich_header(spark, sf_dir):
    return loads.enrich_header(_hdr(spark, sf_dir), *_lk(spark, sf_dir))


@register("detail_source_tag", W(O.fixtures_cte("inv_detail"),
                                 f"SELECT * REPLACE ('hive' AS sjly) FROM (SELECT {O.DETAIL16} FROM inv_detail)"))
def q_detail_source_tag(spark, sf_dir):
    return scan_detail(spark, _dtl(spark, sf_dir)).withColumn("sjly", F.lit("hive"))


@register("unpivot_header", W(HK, O.unpivot_sql("hk", O.HEADER24, "fpxx")))
def q_unpivot_header(spark, sf_dir):
    return C.unpivot(_header_keyed(spark, sf_dir), HEADER_STORED_COLS, HEADER_FAMILY)


@register("cells_of_family", W(CELLS, O.latest_sql("(SELECT * FROM cells WHERE family = 'ev')",
                                                   cols="row_key, qualifier, value")))
def q_cells_of_family(spark, sf_dir):
    return C.family_cells(fx.cells(spark, sf_dir), "ev")


@register("cells_to_wide", W(CELLS + ",\nl AS (" + O.latest_sql("cells") + ")",
                             f"SELECT row_key, {WIDE_SQL} FROM l GROUP BY row_key"))
def q_cells_to_wide(spark, sf_dir):
    return C.to_wide(fx.cells(spark, sf_dir), "ev", EV_NAMES)


@register("qualifiers_per_row", W(CELLS, "SELECT DISTINCT row_key, qualifier FROM cells WHERE family = 'ev'"))
def q_qualifiers_per_row(spark, sf_dir):
    return C.qualifiers_per_row(fx.cells(spark, sf_dir), "ev")


@register("qualifiers_for_keys", W(CELLS, "SELECT DISTINCT row_key, qualifier FROM cells WHERE family = 'ev' AND "
                                   "row_key IN (SELECT lpad(CAST(c_custkey AS STRING), 8, '0') FROM customer)"))
def q_qualifiers_for_keys(spark, sf_dir):
    keys = fx.read_table(spark, sf_dir, "customer").select(
        F.lpad(F.col("c_custkey").cast("string"), 8, "0").alias("row_key"))
    return C.qualifiers_for_keys(fx.cells(spark, sf_dir), keys, "ev")


def _sql_view_filter(spark, sf_dir):
    view = scan_detail(spark, _dtl(spark, sf_dir))
    return spark.sql(f"SELECT * FROM {{v}} WHERE {DETAIL_SQL_FILTER}", v=view)


@register("sql_view_filter", FILTERED)
def q_sql_view_filter(spark, sf_dir):
    return _sql_view_filter(spark, sf_dir)


# ========================================================== filters (FLT)

def _hsel(where: str) -> str:
    return W(O.fixtures_cte("inv_header"), f"SELECT {O.HEADER21} FROM inv_header WHERE {where}")


@register("filter_not_blank", _hsel(f"NOT {O.blank('xfmc')} AND NOT {O.blank('xfsbh')}"))
def q_filter_not_blank(spark, sf_dir):
    return scan_header(spark, _hdr(spark, sf_dir)).filter(X.not_blank("xfmc") & X.not_blank("xfsbh"))


@register("filter_garbled", _hsel("xfmc IS NOT NULL AND NOT contains(xfmc, '?')"))
def q_filter_garbled(spark, sf_dir):
    return scan_header(spark, _hdr(spark, sf_dir)).filter(F.col("xfmc").isNotNull() & ~F.col("xfmc").contains("?"))


@register("filter_no_sentinel", _hsel(f"NOT {O.blank_no('xfmc')} AND NOT {O.blank_no('xfsbh')}"))
def q_filter_no_sentinel(spark, sf_dir):
    return scan_header(spark, _hdr(spark, sf_dir)).filter(~X.is_blank_or_no("xfmc") & ~X.is_blank_or_no("xfsbh"))


@register("filter_month_len", W(O.fixtures_cte("inv_detail"),
                                f"SELECT {O.DETAIL16} FROM inv_detail WHERE NOT {O.blank('kpyf')} AND length(kpyf) > 4"))
def q_filter_month_len(spark, sf_dir):
    return scan_detail(spark, _dtl(spark, sf_dir)).filter(X.not_blank("kpyf") & (F.length("kpyf") > 4))


@register("header_resolved", W(O.enriched_cte(), "SELECT * FROM enr WHERE xfqybm <> '-1'"))
def q_header_resolved(spark, sf_dir):
    return loads.enrich_header(_hdr(spark, sf_dir), *_lk(spark, sf_dir)).filter(F.col("xfqybm") != "-1")


@register("header_keyed", W(HK, "SELECT * FROM hk"))
def q_header_keyed(spark, sf_dir):
    return _header_keyed(spark, sf_dir)


@register("detail_no_dash_key", W(DK, "SELECT row_key, fpmxxh, xfqybm FROM dk"))
def q_detail_no_dash_key(spark, sf_dir):
    return _detail_keyed(spark, sf_dir).select("row_key", "fpmxxh", "xfqybm")


@register("header_preview_variant", W(O.header_keyed_cte(YEAR, rule="keep_empty", variant="preview"),
                                      "SELECT * FROM hk"))
def q_header_preview_variant(spark, sf_dir):
    tagged = loads.tag_header(_hdr(spark, sf_dir), *_lk(spark, sf_dir), YEAR, rule="keep_empty", variant="preview")
    return loads.accepted(tagged)


# ============================================================ joins (JON)

def _gated(spark, sf_dir):
    return _hdr(spark, sf_dir).filter(loads.header_gate())


NAME_ONLY = W(O.lookups_cte() + ",\n" + O.fixtures_cte("inv_header"),
              f"SELECT {O.HEADER21}, n.qybm AS name_code FROM inv_header LEFT JOIN nm n ON n.row_key = {O.jt('xfmc')} "
              f"WHERE NOT {O.blank('xfmc')} AND NOT contains(xfmc, '?') AND NOT {O.blank('xfsbh')}")


@register("seller_by_name", NAME_ONLY)
def q_seller_by_name(spark, sf_dir):
    """First lookup only (by trimmed name), through the key-dictionary path with salted hot keys."""
    by_name, _ = _lk(spark, sf_dir)
    g = _gated(spark, sf_dir).withColumn("_k", F.coalesce(X.jtrim("xfmc"), F.lit("")))
    return lookup_columns(g, by_name, {"_k": "name_code"}, max_bytes=0).select(*HEADER_COLS, "name_code")


@register("codes_by_large_lookups", W(O.enriched_cte(), f"SELECT {O.HEADER21}, gfqybm, xfqybm FROM enr"))
def q_codes_by_large_lookups(spark, sf_dir):
    """Both codes with no lookup broadcast: distinct-key dictionaries attached by salted joins."""
    return header_codes(_gated(spark, sf_dir), *_lk(spark, sf_dir), max_bytes=0).select(*HEADER_COLS, "gfqybm", "xfqybm")


@register("seller_fallback", W(O.enriched_cte(), f"SELECT {O.HEADER21}, xfqybm FROM enr"))
def q_seller_fallback(spark, sf_dir):
    return header_codes(_gated(spark, sf_dir), *_lk(spark, sf_dir)).select(*HEADER_COLS, "xfqybm")


@register("buyer_by_name", W(O.enriched_cte(), f"SELECT {O.HEADER21}, gfqybm FROM enr"))
def q_buyer_by_name(spark, sf_dir):
    return header_codes(_gated(spark, sf_dir), *_lk(spark, sf_dir)).select(*HEADER_COLS, "gfqybm")


@register("detail_seller_code", W(DK, f"SELECT {O.DETAIL16}, xfqybm FROM dl"))
def q_detail_seller_code(spark, sf_dir):
    d = scan_detail(spark, _dtl(spark, sf_dir)).filter(loads.detail_gate()).withColumn("sjly", F.lit("hive"))
    return seller_code_by_tax(d, fx.code_by_tax(spark, sf_dir)).select(*DETAIL_COLS, "xfqybm")


@register("seller_variant_keep_empty", W(O.enriched_cte("keep_empty", "preview", LOOKUPS_BLANKED), "SELECT * FROM enr"))
def q_seller_variant_keep_empty(spark, sf_dir):
    by_name, by_tax = _lk(spark, sf_dir)
    return loads.enrich_header(_hdr(spark, sf_dir), _blank_some_codes(by_name), by_tax,
                               rule="keep_empty", variant="preview")


@register("codes_variant_nullable", W(O.enriched_cte("nullable", "preview", LOOKUPS_BLANKED), "SELECT * FROM enr"))
def q_codes_variant_nullable(spark, sf_dir):
    by_name, by_tax = _lk(spark, sf_dir)
    return loads.enrich_header(_hdr(spark, sf_dir), _blank_some_codes(by_name), by_tax,
                               rule="nullable", variant="preview")


@register("unresolved_sellers", W(O.enriched_cte(), "SELECT * FROM enr WHERE xfqybm = '-1'"))
def q_unresolved_sellers(spark, sf_dir):
    tagged = loads.tag_header(_hdr(spark, sf_dir), *_lk(spark, sf_dir), YEAR)
    return tagged.filter(F.col(loads.REJECT) == "unresolved_seller").select(*HEADER_STORED_COLS)


# ===================================================== aggregations (AGG)

@register("count_rows", W(CELLS, "SELECT count(DISTINCT row_key) AS n_rows FROM cells"))
def q_count_rows(spark, sf_dir):
    return C.count_rows(fx.cells(spark, sf_dir))


@register("bucketed_count_rows", W(CELLS, "SELECT count(DISTINCT row_key) AS n_rows FROM cells"))
def q_bucketed_count_rows(spark, sf_dir):
    """Row keys of a bucketed cell table: exact, and no key is exchanged."""
    return C.count_rows(_bucketed_cells(spark, sf_dir))


@register("header_load_counts", W(O.header_keyed_cte(YEAR), "SELECT (SELECT count(*) FROM inv_header) AS n_rows, (SELECT count(*) FROM hk) AS n_accepted"))
def q_header_load_counts(spark, sf_dir):
    """Input and accepted rows of a stored header load, as the load counted them while it wrote; rejected ones are the difference (tested)."""
    got = store.load_header(_hdr(spark, sf_dir), *_lk(spark, sf_dir), YEAR, fresh_path(spark, "load_counts"), counted=True)
    return spark.createDataFrame([(got.rows, got.accepted)], "n_rows bigint, n_accepted bigint")


@register("count_header_rows", W(HK, "SELECT count(*) AS n_rows FROM hk"))
def q_count_header_rows(spark, sf_dir):
    return _header_keyed(spark, sf_dir).agg(F.count(F.lit(1)).alias("n_rows"))


@register("dedupe_detail_keys", W(DK, DK_LWW))
def q_dedupe_detail_keys(spark, sf_dir):
    return store.detail_rows_lww(_detail_keyed(spark, sf_dir)).select("row_key", *DETAIL_COLS, "xfqybm")


@register("partition_profile", W(HK, "SELECT count(*)::BIGINT AS n, true AS every_row_once FROM hk"))
def q_partition_profile(spark, sf_dir):
    """The total of the rows per task (``cells.partition_profile``), as the rows themselves depend on the layout."""
    profile = C.partition_profile(_header_keyed(spark, sf_dir))
    return profile.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"),
                       (F.count(F.lit(1)) == F.count_distinct("partition")).alias("every_row_once"))


@register("key_collisions", W(HK, "SELECT row_key, count(*) AS n, count(DISTINCT fpdm || '|' || fphm) AS n_invoices "
                              "FROM hk GROUP BY row_key HAVING count(DISTINCT fpdm || '|' || fphm) > 1"))
def q_key_collisions(spark, sf_dir):
    """Row keys as the load writes them that two or more invoices share."""
    return M.key_collisions(_header_keyed(spark, sf_dir), ["fpdm", "fphm"])


@register("header_keyed_intended", W(O.header_keyed_cte(YEAR, mode="intended"), "SELECT * FROM hk"))
def q_header_keyed_intended(spark, sf_dir):
    return _header_keyed(spark, sf_dir, mode="intended")


@register("detail_keyed_intended", W(O.detail_keyed_cte(mode="intended"), "SELECT * FROM dk"))
def q_detail_keyed_intended(spark, sf_dir):
    return loads.detail_keyed(_dtl(spark, sf_dir), fx.code_by_tax(spark, sf_dir), mode="intended")


@register("scan_catalogue", W(O.fixtures_cte("inv_detail"), f"SELECT {O.DETAIL16} FROM inv_detail"))
def q_scan_catalogue(spark, sf_dir):
    """The line scan through a catalogue table (stored in the shared work folder, read by name)."""
    path = fresh_path(spark, "catalogue")
    name = "wf_lines_" + path.rsplit("-", 1)[-1]
    _dtl(spark, sf_dir).write.format("parquet").option("path", path).saveAsTable(name)
    return scan_detail(spark, name)


HEADER_OUTCOME = (
    f"CASE WHEN {O.blank('xfmc')} THEN 'blank_seller_name' WHEN contains(xfmc, '?') THEN 'garbled_seller_name' "
    f"WHEN {O.blank('xfsbh')} THEN 'blank_seller_tax_id' WHEN {O.seller('standard')} = '-1' THEN 'unresolved_seller' "
    f"WHEN {O.blank('fpdm')} THEN 'blank_invoice_code' WHEN {O.blank('fphm')} THEN 'blank_invoice_no' "
    f"WHEN {O.year('kpyf', YEAR)} IS NULL THEN 'bad_month' "
    f"WHEN {O.fpbm(O.jt('fpdm'), O.jt('fphm'))} IS NULL THEN 'bad_invoice_no' ELSE 'accepted' END")


@register("header_reject_counts", W(
    O.lookups_cte() + ",\n" + O.fixtures_cte("inv_header") + ",\n"
    "a AS (SELECT h.*, n.qybm AS n_code, t.qybm AS t_code FROM inv_header h "
    f"LEFT JOIN nm n ON n.row_key = {O.jt('h.xfmc')} LEFT JOIN tx t ON t.row_key = {O.jt('h.xfsbh')})",
    f"SELECT outcome, count(*) AS n FROM (SELECT {HEADER_OUTCOME} AS outcome FROM a) GROUP BY outcome"))
def q_header_reject_counts(spark, sf_dir):
    return loads.reject_counts(loads.tag_header(_hdr(spark, sf_dir), *_lk(spark, sf_dir), YEAR))


DETAIL_KEY = f"(xfqybm || {O.year('kpyf', None)} || {O.fpbm(O.jt('fpdm'), O.jt('fphm'))} || {O.jt('fpmxxh')})"
DETAIL_OUTCOME = (
    f"CASE WHEN {O.blank('xf_nsrsbh')} THEN 'blank_seller_tax_id' WHEN {O.blank('fpdm')} THEN 'blank_invoice_code' "
    f"WHEN {O.blank('fphm')} THEN 'blank_invoice_no' WHEN {O.blank('fpmxxh')} THEN 'blank_line_no' "
    f"WHEN {O.blank('kpyf')} OR length(kpyf) <= 4 THEN 'short_month' "
    f"WHEN {O.year('kpyf', None)} IS NULL THEN 'bad_month' "
    f"WHEN {O.fpbm(O.jt('fpdm'), O.jt('fphm'))} IS NULL THEN 'bad_invoice_no' "
    f"WHEN xfqybm = '-1' THEN 'unresolved_seller' WHEN contains({DETAIL_KEY}, '-') THEN 'dash_in_key' "
    "ELSE 'accepted' END")


@register("detail_reject_counts", W(
    O.lookups_cte() + ",\n" + O.fixtures_cte("inv_detail") + ",\n"
    f"a AS (SELECT d.*, COALESCE({O.nb('t.qybm')}, '-1') AS xfqybm FROM inv_detail d "
    f"LEFT JOIN tx t ON t.row_key = {O.jt('d.xf_nsrsbh')})",
    f"SELECT outcome, count(*) AS n FROM (SELECT {DETAIL_OUTCOME} AS outcome FROM a) GROUP BY outcome"))
def q_detail_reject_counts(spark, sf_dir):
    return loads.reject_counts(loads.tag_detail(_dtl(spark, sf_dir), fx.code_by_tax(spark, sf_dir)))


# ============================================================ merges (MRG)

@register("merged_wide", W(CELLS + f",\nsl AS ({O.latest_sql(SRC_KEYS)}),\n"
                           f"sb AS (SELECT row_key, family, qualifier, {TS(RUN_TS)} AS ts, seq, value FROM sl),\n"
                           f"u AS (SELECT row_key, family, qualifier, ts, seq, value FROM {TGT} t UNION ALL SELECT * FROM sb),\n"
                           f"l AS ({O.latest_sql('u')})",
                           f"SELECT row_key, {WIDE_SQL} FROM l GROUP BY row_key"))
def q_merged_wide(spark, sf_dir):
    """The pivot resolves versions itself, so target and source batch are only put together."""
    batch = M.source_batch(_source(spark, sf_dir), RUN_TS, family="ev", start=KEY_FROM, stop=KEY_TO)
    return C.to_wide(_target(spark, sf_dir).unionByName(batch), "ev", EV_NAMES)


# ============================================================ keys (KEY, SCL)

@register("encode_base32", "SELECT o_orderkey, " + O.b32("o_orderkey") + " AS k32, "
          + O.b32("o_orderkey * 1000003 + o_custkey") + " AS k32_wide, "
          + "CASE WHEN o_custkey - o_orderkey >= 0 THEN " + O.b32("o_custkey - o_orderkey") + " END AS k32_checked "
          + "FROM orders")
def q_encode_base32(spark, sf_dir):
    o = fx.read_table(spark, sf_dir, "orders")
    return o.select("o_orderkey", K.base32("o_orderkey").alias("k32"),
                    K.base32(F.col("o_orderkey") * 1000003 + F.col("o_custkey")).alias("k32_wide"),
                    K.base32(F.col("o_custkey") - F.col("o_orderkey"), negatives="reject").alias("k32_checked"))


@register("pack_invoice_no", W(O.fixtures_cte("inv_header"),
                               f"SELECT fpdm, fphm, {O.fpbm(O.jt('fpdm'), O.jt('fphm'))} AS fpbm FROM inv_header "
                               f"WHERE NOT {O.blank('fpdm')} AND NOT {O.blank('fphm')}"))
def q_pack_invoice_no(spark, sf_dir):
    h = scan_header(spark, _hdr(spark, sf_dir)).filter(X.not_blank("fpdm") & X.not_blank("fphm"))
    return h.select("fpdm", "fphm", K.packed_invoice_no(X.jtrim("fpdm"), X.jtrim("fphm")).alias("fpbm"))


@register("pack_invoice_no_intended", W(O.fixtures_cte("inv_header"),
                                        f"SELECT fpdm, fphm, {O.fpbm(O.jt('fpdm'), O.jt('fphm'), 'intended')} AS fpbm "
                                        f"FROM inv_header WHERE NOT {O.blank('fpdm')} AND NOT {O.blank('fphm')}"))
def q_pack_invoice_no_intended(spark, sf_dir):
    h = scan_header(spark, _hdr(spark, sf_dir)).filter(X.not_blank("fpdm") & X.not_blank("fphm"))
    return h.select("fpdm", "fphm", K.packed_invoice_no(X.jtrim("fpdm"), X.jtrim("fphm"), mode="intended").alias("fpbm"))


@register("detail_keyed", W(DK, "SELECT * FROM dk"))
def q_detail_keyed(spark, sf_dir):
    return _detail_keyed(spark, sf_dir)


@register("year_part", W(O.fixtures_cte("inv_header"), f"SELECT kpyf, {O.year('kpyf', YEAR)} AS yy FROM inv_header"))
def q_year_part(spark, sf_dir):
    return scan_header(spark, _hdr(spark, sf_dir)).select("kpyf", K.year_part("kpyf", YEAR).alias("yy"))


STABLE = " || ".join(f"substr('{X.ALPHABET32}', (('0x' || substr(md5(row_key || ':7'), {2 * i + 1}, 2))::INTEGER % 32) + 1, 1)"
                     for i in range(8))


@register("random_token", W(HK, f"SELECT row_key, {STABLE} AS stable_token, 8 AS token_length, true AS token_fits FROM hk"))
def q_random_token(spark, sf_dir):
    """The repeatable token, and of the random one what does not depend on chance: length and alphabet."""
    return (_header_keyed(spark, sf_dir).select("row_key", X.token32(8).alias("token"), X.token32(8, key=F.col("row_key")).alias("stable_token"))
            .select("row_key", "stable_token", F.length("token").alias("token_length"),
                    F.col("token").rlike(f"^[{X.ALPHABET32}]+$").alias("token_fits")))


@register("pseudonymize", W(O.fixtures_cte("inv_header"),
                            f"SELECT fphm, md5(xfmc) AS xfmc_md5, md5(gfmc || '{SALT}') AS gfmc_md5 FROM inv_header"))
def q_pseudonymize(spark, sf_dir):
    h = scan_header(spark, _hdr(spark, sf_dir))
    return h.select("fphm", X.md5_hex("xfmc").alias("xfmc_md5"), X.md5_hex("gfmc", SALT).alias("gfmc_md5"))


FILL_COLS = ["xfmc", "gfmc", "se", "kpjh", "zfsj"]


@register("fill_minus_one", W(O.fixtures_cte("inv_header"),
                              "SELECT fphm, " + ", ".join(f"{O.fill_m1(c)} AS {c}" for c in FILL_COLS) + " FROM inv_header"))
def q_fill_minus_one(spark, sf_dir):
    h = scan_header(spark, _hdr(spark, sf_dir))
    return h.select("fphm", *[X.fill_minus_one(c).alias(c) for c in FILL_COLS])


@register("fill_null_word", W(O.fixtures_cte("inv_header"),
                              "SELECT fphm, " + ", ".join(f"{O.fill_nw(c)} AS {c}" for c in FILL_COLS) + " FROM inv_header"))
def q_fill_null_word(spark, sf_dir):
    h = scan_header(spark, _hdr(spark, sf_dir))
    return h.select("fphm", *[X.fill_null_word(c).alias(c) for c in FILL_COLS])


@register("java_trim", W(O.fixtures_cte("inv_header"), f"SELECT xfmc, {O.jt('xfmc')} AS xfmc_trim FROM inv_header"))
def q_java_trim(spark, sf_dir):
    return scan_header(spark, _hdr(spark, sf_dir)).select("xfmc", X.jtrim("xfmc").alias("xfmc_trim"))
