"""Helpers shared by the operators of this package."""

from __future__ import annotations

import os
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wideflow.session import fresh_path

#: The white space of every word rule here (ASCII only), as a regex class body.
SPACE = r"\x20\x09-\x0D"
#: The same six characters, for ``translate`` and ``trim``.
SPACE_CHARS = " \t\n\x0b\x0c\r"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def find_package(df: DataFrame) -> None:
    """Lets Python workers import this package from where the driver did.

    A cluster gets the package with the job (``--py-files``); a session on one machine may
    have been started elsewhere, without this folder on its path.
    """
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = df.sparkSession.sparkContext.environment
    path = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in path:
        env["PYTHONPATH"] = os.pathsep.join([*path, root])


def staged(df: DataFrame, name: str) -> DataFrame:
    """Writes ``df`` to a fresh folder under the shared work folder and rereads it.

    Cuts the lineage with files that every executor can read, so a lost executor
    costs a reread and never a recomputation of what lies before.
    """
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ascii_lower(c: Column) -> Column:
    """A-Z to a-z and nothing else."""
    return F.translate(c, _UPPER, _UPPER.lower())


def text_or_empty(c: str = "text") -> Column:
    return F.coalesce(F.col(c), F.lit(""))


def words(text: Column) -> Column:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a text, in order."""
    inner = F.btrim(text, F.lit(SPACE_CHARS))  # so that the split has no empty ends
    return F.when(inner != "", F.split(inner, f"[{SPACE}]+")).otherwise(F.array().cast("array<string>"))


def computed_once(c: Column) -> Column:
    """``c``, as a column that filters above are not pushed below.

    A filter pushed below a projection repeats the projected expression, and inside a
    lambda even once for each element. The condition is true for every row; all it does is
    to hold the optimizer off.
    """
    return F.when(F.monotonically_increasing_id() >= 0, c)


def small_enough(df: DataFrame, max_rows: int) -> bool:
    """Whether ``df`` has at most ``max_rows`` rows, by reading at most one more than that.

    Callers broadcast a side only behind this check, with a join beyond it that shuffles.
    """
    return df.limit(max_rows + 1).count() <= max_rows


#: A join key of ``join_unique`` needs at least so many rows (and more than a fair share of all for each shuffle partition) to be hot.
HOT_ROWS = 100_000


def join_unique(rows: DataFrame, side: DataFrame, key: str, how: str = "inner", n: int | None = None) -> DataFrame:
    """``rows.join(side, key, how)`` for a ``side`` that has each key once, without sending a hot key's rows to one task.

    Keys that hold more than a fair share of the rows are fewer than the shuffle partitions: their rows of ``side`` are broadcast and
    the rows stay where they are. ``rows`` should lie on disk; ``n`` is a bound of their number, if one is known.
    """
    spark = rows.sparkSession
    n = rows.count() if n is None else n
    share = max(n // max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1), HOT_ROWS)
    if n <= share:
        return rows.join(side, key, how)
    often = rows.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > share).select(key)
    hot = spark.createDataFrame(often.collect(), often.schema)
    if hot.isEmpty():
        return rows.join(side, key, how)
    few = side.join(F.broadcast(hot), key, "left_semi")
    return (rows.join(F.broadcast(hot), key, "left_anti").join(side, key, how)
            .unionByName(rows.join(F.broadcast(hot), key, "left_semi").join(F.broadcast(few), key, how)))


def text_slices(texts: list[str | None], max_chars: int = 2_000_000) -> Iterator[tuple[int, int]]:
    """Index ranges over ``texts`` of about ``max_chars`` characters each (one text at least)."""
    start, held = 0, 0
    for i, t in enumerate(texts):
        held += len(t) if t else 0
        if held >= max_chars:
            yield start, i + 1
            start, held = i + 1, 0
    if start < len(texts):
        yield start, len(texts)
