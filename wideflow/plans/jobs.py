"""Command-line jobs (spark-submit entry points) for the loads, merges and reads.

    python -m wideflow load-header --table T --by-name N --by-tax X --target P --year 16
    python -m wideflow load-detail --table T --by-tax X --target P
    python -m wideflow merge --source S --target P --family F [--start A --stop B | --ts-from .. --ts-to ..]
    python -m wideflow export --table P --family F --columns a,b --where "a = b" --csv OUT
    python -m wideflow qualifiers --table P --family F --out OUT
    python -m wideflow key-collisions --table T --by-name N --by-tax X --year 16 --out OUT
    python -m wideflow count-rows --table P
    python -m wideflow compact --source P [--target Q]

Tables are catalogue names or Parquet paths. Lookups are either (row_key, qybm)
tables or cell tables (``--lookup-cells``: family qyxx, qualifier qybm).
Results go to storage; only counts and explicit ``--show`` previews reach the
driver.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from ..operators import cells as C
from ..operators.lookup import lookup_from_cells
from ..operators.merge import key_collisions
from ..plans import loads
from ..session import release
from ..sinks import files as S
from ..sinks import ranges
from ..sources.tables import open_table, scan_detail, scan_header, scan_tasks, spread
from . import store


def _lookup(spark, table: str, as_cells: bool):
    if as_cells:
        return lookup_from_cells(S.read_cells(spark, table))
    return open_table(spark, table).select("row_key", "qybm")


def _cells(spark, table: str):
    return S.read_cells(spark, table) if "/" in table else spark.table(table)


def _size_shuffles(spark, df, width: int | None) -> None:
    """Shuffle width of a job: as given, or at least the tasks of its input and the cluster's cores."""
    now = int(spark.conf.get("spark.sql.shuffle.partitions"))
    spark.conf.set("spark.sql.shuffle.partitions", width or max(now, scan_tasks(df), spark.sparkContext.defaultParallelism))


def build_parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="wideflow")
    p.add_argument("--shuffle-partitions", type=int, help="default: from the input's size")
    sub = p.add_subparsers(dest="cmd", required=True)

    h = sub.add_parser("load-header", help="invoice headers -> cell table")
    h.add_argument("--table", required=True)
    h.add_argument("--by-name", required=True)
    h.add_argument("--by-tax", required=True)
    h.add_argument("--target", required=True)
    h.add_argument("--rejects")
    h.add_argument("--year", required=True, help="2-digit year for rows without a month")
    h.add_argument("--layout", choices=store.LAYOUTS, default="bulk")
    h.add_argument("--mode", choices=("compat", "intended"), default="compat")
    h.add_argument("--partitions", type=int)
    h.add_argument("--max-records-per-file", type=int)
    h.add_argument("--rows-per-range", type=int, help="aligned layout: rows of a batch beyond which a range is split")
    h.add_argument("--counted", action="store_true", help="stage the rows to count them by outcome where the load would not")
    h.add_argument("--lookup-cells", action="store_true")

    d = sub.add_parser("load-detail", help="invoice lines -> cell table")
    d.add_argument("--table", required=True)
    d.add_argument("--by-tax", required=True)
    d.add_argument("--target", required=True)
    d.add_argument("--rejects")
    d.add_argument("--layout", choices=store.LAYOUTS, default="put")
    d.add_argument("--mode", choices=("compat", "intended"), default="compat")
    d.add_argument("--partitions", type=int)
    d.add_argument("--max-records-per-file", type=int)
    d.add_argument("--rows-per-range", type=int, help="aligned layout: rows of a batch beyond which a range is split")
    d.add_argument("--counted", action="store_true", help="stage the rows to count them by outcome where the load would not")
    d.add_argument("--lookup-cells", action="store_true")

    m = sub.add_parser("merge", help="copy latest source cells into a target table")
    m.add_argument("--source", required=True)
    m.add_argument("--target", required=True)
    m.add_argument("--family")
    m.add_argument("--start")
    m.add_argument("--stop")
    m.add_argument("--ts-from")
    m.add_argument("--ts-to")
    m.add_argument("--ts-policy", choices=("write_time", "source"), default="write_time")
    m.add_argument("--layout", choices=store.LAYOUTS, default="bulk")
    m.add_argument("--partitions", type=int)
    m.add_argument("--max-records-per-file", type=int)
    m.add_argument("--rows-per-range", type=int)

    n = sub.add_parser("sync-new", help="copy what the source table got since the last such run")
    n.add_argument("--source", required=True)
    n.add_argument("--target", required=True)
    n.add_argument("--ts-policy", choices=("write_time", "source"), default="write_time")
    n.add_argument("--partitions", type=int)
    n.add_argument("--max-records-per-file", type=int)

    e = sub.add_parser("export", help="cells -> fixed columns -> SQL filter -> CSV")
    e.add_argument("--table", required=True)
    e.add_argument("--family", required=True)
    e.add_argument("--columns", required=True)
    e.add_argument("--where", default="true")
    e.add_argument("--csv", required=True)
    e.add_argument("--show", type=int, default=0)

    q = sub.add_parser("qualifiers", help="qualifiers present per row of one family")
    q.add_argument("--table", required=True)
    q.add_argument("--family", required=True)
    q.add_argument("--out", required=True)
    q.add_argument("--show", type=int, default=0)

    x = sub.add_parser("key-collisions", help="row keys that several invoices share")
    x.add_argument("--table", required=True)
    x.add_argument("--by-name", required=True)
    x.add_argument("--by-tax", required=True)
    x.add_argument("--year", required=True)
    x.add_argument("--mode", choices=("compat", "intended"), default="compat")
    x.add_argument("--out", required=True)
    x.add_argument("--lookup-cells", action="store_true")

    c = sub.add_parser("count-rows", help="number of row keys")
    c.add_argument("--table", required=True)
    c.add_argument("--estimate", action="store_true", help="from the key sketches of a stored table's files")

    k = sub.add_parser("compact", help="rewrite the latest view, in place or into a new table")
    k.add_argument("--source", required=True)
    k.add_argument("--target")
    k.add_argument("--deeper-than", type=int, help="in place, and only files with keys that more files than this may hold")
    k.add_argument("--partitions", type=int)
    k.add_argument("--max-records-per-file", type=int)
    k.add_argument("--layout", choices=("bulk", "aligned"), default="bulk")
    k.add_argument("--rows-per-range", type=int)
    return p


def _told(counts: store.LoadCounts | None) -> store.LoadCounts | None:
    if counts:
        print(f"Rows: {counts.rows}, accepted: {counts.accepted}, rejected: {sum(counts.rejected.values())}")
        for reason, n in sorted(counts.rejected.items()):
            print(f"  {reason}: {n}")
    return counts


def run(argv: list[str], spark: SparkSession | None = None):
    a = build_parser().parse_args(argv)
    spark = spark or SparkSession.builder.getOrCreate()
    before = spark.conf.get("spark.sql.shuffle.partitions")
    source = getattr(a, "table", None) or a.source
    _size_shuffles(spark, _cells(spark, source) if a.cmd in CELL_JOBS else open_table(spark, source), a.shuffle_partitions)
    try:
        return _run(a, spark)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


#: Jobs whose input is a cell table.
CELL_JOBS = ("merge", "sync-new", "export", "qualifiers", "count-rows", "compact")


def _run(a: argparse.Namespace, spark: SparkSession):
    if a.cmd == "load-header":
        return _told(store.load_header(
                          scan_header(spark, spread(open_table(spark, a.table))),
                          _lookup(spark, a.by_name, a.lookup_cells), _lookup(spark, a.by_tax, a.lookup_cells),
                          a.year, a.target, a.rejects, layout=a.layout, mode=a.mode,
                          num_partitions=a.partitions, max_records_per_file=a.max_records_per_file,
                          rows_per_range=a.rows_per_range, counted=a.counted))
    elif a.cmd == "load-detail":
        return _told(store.load_detail(
                          scan_detail(spark, spread(open_table(spark, a.table))),
                          _lookup(spark, a.by_tax, a.lookup_cells), a.target, a.rejects, layout=a.layout,
                          mode=a.mode, num_partitions=a.partitions, max_records_per_file=a.max_records_per_file,
                          rows_per_range=a.rows_per_range, counted=a.counted))
    elif a.cmd == "merge":
        store.sync_cells(_cells(spark, a.source), a.target, ts_policy=a.ts_policy, family=a.family,
                         start=a.start, stop=a.stop, ts_from=a.ts_from, ts_to=a.ts_to,
                         layout=a.layout, num_partitions=a.partitions,
                         max_records_per_file=a.max_records_per_file, rows_per_range=a.rows_per_range)
    elif a.cmd == "export":
        names = [c.strip() for c in a.columns.split(",")]
        wide = C.to_wide(_cells(spark, a.table), a.family, names)
        out = spark.sql(f"SELECT * FROM {{v}} WHERE {a.where}", v=wide)
        S.write_csv(out, a.csv, mode="append", lossless=False)
        if a.show:
            S.preview(wide, a.show, ["row_key"]).show(a.show, truncate=False)
    elif a.cmd == "qualifiers":
        out = C.qualifiers_per_row(_cells(spark, a.table), a.family)
        out.write.mode("overwrite").parquet(a.out)
        if a.show:
            S.preview(out, a.show, ["row_key", "qualifier"]).show(a.show, truncate=False)
    elif a.cmd == "key-collisions":
        keyed = loads.header_keyed(scan_header(spark, spread(open_table(spark, a.table))), _lookup(spark, a.by_name, a.lookup_cells),
                                   _lookup(spark, a.by_tax, a.lookup_cells), a.year, a.mode)
        key_collisions(keyed, ["fpdm", "fphm"]).write.mode("overwrite").parquet(a.out)
    elif a.cmd == "count-rows":
        n = ranges.estimate_rows(spark, a.table) if a.estimate else C.count_rows(_cells(spark, a.table)).first()["n_rows"]
        print(f"RowCount: {n}" + (" (estimate)" if a.estimate else ""))
        return n
    elif a.cmd == "sync-new":
        return store.sync_new(spark, a.source, a.target, ts_policy=a.ts_policy, num_partitions=a.partitions,
                              max_records_per_file=a.max_records_per_file)
    elif a.cmd == "compact" and a.deeper_than is not None:
        if a.target not in (None, a.source):
            raise ValueError("--deeper-than works in place: it takes no --target")
        return store.compact_ranges(spark, a.source, a.deeper_than, a.partitions, a.max_records_per_file)
    elif a.cmd == "compact":
        store.compact(spark, a.source, a.target, num_partitions=a.partitions,
                      max_records_per_file=a.max_records_per_file, layout=a.layout, rows_per_range=a.rows_per_range)
    return None


def main() -> None:
    spark = SparkSession.builder.getOrCreate()
    try:
        run(sys.argv[1:], spark)
    finally:
        release(spark)  # scratch folders of this run


if __name__ == "__main__":
    main()
