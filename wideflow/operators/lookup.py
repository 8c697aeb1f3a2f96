"""Key-value lookups as joins.

The source jobs did two to six remote point reads per row. Here a lookup is a
left equi-join on a unique right key (``unique_lookup``), planned for each
lookup on its own from its measured size (``lookup_columns``):

* measured small (``measure``): broadcast joins, no shuffle of the wide rows;
* otherwise the distinct keys of the input (of all columns that probe this
  lookup together) are collected with a partial (map-side) aggregate that also
  counts rows per key, resolved against the lookup - unique on both sides, so
  no task is hot - written to the shared work folder, and attached to the wide
  rows: broadcast for each column whose part of that dictionary is measured small,
  else a shuffle join in which hot keys and blank keys are salted (``salt_hot_keys``).

Blank probe keys use the marker '' (never NULL): a trimmed, non-blank key can
never be '', and lookup rows keyed '' are dropped, so the marker cannot match.
Blank keys take no part in the dictionary and are spread over all tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import fresh_path

NO_KEY = ""
DEFAULT_BROADCAST_MAX_BYTES = 32 * 1024 * 1024


def _lookup_rows(lookup: DataFrame, key: str = "row_key", value: str = "qybm") -> DataFrame:
    return lookup.select(key, value).filter(F.col(key).isNotNull() & (F.col(key) != NO_KEY))


def unique_lookup(lookup: DataFrame, key: str = "row_key", value: str = "qybm") -> DataFrame:
    """One row per key; duplicates keep the greatest value (a data error upstream).

    The aggregate's output is hash-partitioned on the key, so a following
    sort-merge join on that key needs no second shuffle of the lookup side.
    """
    return _lookup_rows(lookup, key, value).groupBy(key).agg(F.max(value).alias(value))


def broadcast_max_bytes(spark) -> int:
    v = spark.conf.get("wideflow.broadcastMaxBytes", None)
    return int(v) if v else DEFAULT_BROADCAST_MAX_BYTES


def measure(df: DataFrame, max_bytes: int | None = None, persist: bool = True, path: str | None = None) -> tuple[DataFrame, bool]:
    """Measure a derived table and say whether it may be broadcast.

    The measurement is one aggregate over its rows (bytes of every column plus
    a per-row overhead); the bound is ``wideflow.broadcastMaxBytes``. With
    ``persist`` the rows are written once to the shared work folder (for tables
    that are expensive to recompute, such as a key dictionary of the whole
    input): the join that follows reads them from there and the lineage is cut. The caller may name the folder, to remove it.
    """
    spark = df.sparkSession
    limit = broadcast_max_bytes(spark) if max_bytes is None else max_bytes
    if persist:
        path, schema = path or fresh_path(spark, "dictionary"), df.schema
        df.write.parquet(path)
        df = spark.read.schema(schema).parquet(path)
    width = sum(F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c in df.columns)
    n_rows, n_bytes = df.agg(F.count(F.lit(1)), F.sum(width)).first()
    est = (n_bytes or 0) + n_rows * (16 + 8 * len(df.columns))
    return df, (limit > 0 and est <= limit)


#: HotSpot does not compile methods of more bytes than this.
HUGE_METHOD = ("spark.sql.codegen.hugeMethodLimit", "8000")


def compiled(spark) -> None:
    """Stages of a load fuse cleaning, key building and lookups into one generated method that HotSpot would only interpret;
    with this limit Spark runs such a stage operator by operator, in methods that are compiled. A limit set by the caller stays."""
    if spark.conf.get(HUGE_METHOD[0], None) is None:
        spark.conf.set(*HUGE_METHOD)


def lookup_columns(df: DataFrame, lookup: DataFrame, columns: dict[str, str], max_bytes: int | None = None,
                   probes: DataFrame | None = None) -> DataFrame:
    """``df`` with the looked-up value of each probe column (key column -> new column; NULL if absent).

    ``max_bytes`` overrides the session's bound for broadcasting. ``probes``: a frame with the same probe keys that is cheaper to
    compute than ``df`` (``df`` before an earlier lookup); the key dictionary is made from it.
    """
    compiled(df.sparkSession)
    _, small = measure(_lookup_rows(lookup), max_bytes, persist=False)
    unique = unique_lookup(lookup)
    if small:
        for key, out in columns.items():
            df = probe(unique, df, key, out, broadcast=True)
        return df
    which = F.explode(F.array(*[F.struct(F.col(k).alias("k"), F.lit(i).alias("i")) for i, k in enumerate(columns)]))
    rows = [F.count(F.when(F.col("p.i") == i, 1)).alias(f"_rows{i}") for i in range(len(columns))]
    keys = (df if probes is None else probes).select(which.alias("p")).where(F.col("p.k") != NO_KEY).groupBy(F.col("p.k").alias("row_key")).agg(*rows)
    found, small = measure(keys.join(unique, "row_key"), max_bytes)
    for i, (key, out) in enumerate(columns.items()):
        entry = found.where(F.col(f"_rows{i}") > 0).select(F.col("row_key").alias(key), F.col("qybm").alias(out), F.col(f"_rows{i}").alias("_rows"))
        # a column with few keys is attached without moving the wide rows, whatever the others need
        if small or measure(entry.drop("_rows"), max_bytes, persist=False)[1]:
            df = df.join(F.broadcast(entry.drop("_rows")), key, "left")
        else:
            wide, entry = salt_hot_keys(df, entry, [key], "_rows")
            df = wide.join(entry, on=[key, _SALT], how="left").drop(_SALT)
    return df


DEFAULT_HOT_KEY_MIN_ROWS = 100_000
_SALTS, _SALT = "_salts", "_salt"


def salt_hot_keys(df: DataFrame, resolved: DataFrame, on: list[str], rows_col: str) -> tuple[DataFrame, DataFrame]:
    """Add a ``_salt`` column to both sides of a join on a one-row-per-key dictionary.

    A key is hot when it holds more rows than a fair share per shuffle
    partition (and at least ``wideflow.hotKeyMinRows``). Hot keys are fewer
    than the shuffle partitions - their rows add up to at most all rows - so
    their list is broadcast safely. A hot key's rows get a salt from a hash of
    the whole row (deterministic on retry) in [0, salts); its dictionary entry
    is repeated once per salt; every other key keeps salt 0. A join on
    (key, salt) then spreads a hot key over ``salts`` tasks. Rows with a blank
    key, which match nothing, get any salt.
    """
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    min_rows = int(spark.conf.get("wideflow.hotKeyMinRows", None) or DEFAULT_HOT_KEY_MIN_ROWS)
    total = resolved.agg(F.sum(rows_col)).first()[0] or 0
    share = max(total // max(parts, 1), min_rows, 1)
    hot = (resolved.filter(F.col(rows_col) > share)
           .select(*on, F.ceil(F.col(rows_col) / F.lit(share)).cast("int").alias(_SALTS)))
    blank = F.lit(False)
    for c in on:
        if dict(df.dtypes)[c] == "string":
            blank = blank | (F.col(c) == NO_KEY)
    wide = (df.join(F.broadcast(hot), on=on, how="left")
            .withColumn(_SALT, F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]),
                                      F.when(blank, F.lit(max(parts, 1))).otherwise(F.coalesce(_SALTS, F.lit(1)))).cast("int"))
            .drop(_SALTS))
    dictionary = (resolved.drop(rows_col).join(F.broadcast(hot), on=on, how="left")
                  .withColumn(_SALT, F.explode(F.sequence(F.lit(0), F.coalesce(F.col(_SALTS), F.lit(1)) - 1)))
                  .drop(_SALTS))
    return wide, dictionary


def probe(lookup: DataFrame, keys: DataFrame, key_col: str, out_col: str,
          broadcast: bool = False) -> DataFrame:
    """keys ⟕ lookup on key_col; adds the looked-up value as ``out_col`` (NULL if absent)."""
    lk = lookup.select(F.col("row_key").alias(key_col), F.col("qybm").alias(out_col))
    return keys.join(F.broadcast(lk) if broadcast else lk, on=key_col, how="left")


def lookup_from_cells(cells: DataFrame, family: str = "qyxx", qualifier: str = "qybm") -> DataFrame:
    """A (row_key, qybm) lookup read from a cell table (latest version of one cell per row)."""
    from .cells import select_versions
    return (select_versions(cells, families=[family], qualifiers=[qualifier])
            .groupBy("row_key").agg(F.max(F.struct("ts", "seq", "value")).alias("_w"))
            .select("row_key", F.col("_w.value").alias("qybm")))
