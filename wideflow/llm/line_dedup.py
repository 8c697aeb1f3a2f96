"""Line de-duplication across documents, by keep bitmaps.

A line's key is the line without ASCII white space at both ends, A-Z lower-cased.
Keys of at least ``min_chars`` code points that occur in two or more documents keep
their lines only in the document with the smallest id (all of them there).

Key hashes (128 bits) are range-partitioned together with the document id, so that the
rows of one very common line spread over several partitions, and sorted within them by
document and position. Each task streams its rows and names the lines that are not
in the first document of their run. A run that began in an earlier partition is told
apart by the first and last run of each partition: two rows per task, whose minima say
which document came first. Texts are not shuffled for the decision; its outcome is one
compressed bitmap for each document that loses lines.

Defined cases: a null or empty text is one empty line; rows with a null id lose no
line and cause no loss; rows that repeat an id are the same document, each row with the
lines of its own text; equal lines within one document are no reason to drop; an empty
table gives no rows; columns other than id and text pass through unread.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from .common import SPACE_CHARS, find_package, staged, text_or_empty

_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
_DROP, _PENDING, _MARK = 0, 1, 2


def _key_rows(min_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, rows = b.column(0).to_pylist(), b.column(1).to_pylist()
            h1, h2, at, row, pos, count = [], [], [], [], [], []
            for i, (doc, r, text) in enumerate(zip(ids, rows, b.column(2).to_pylist(), strict=True)):
                lines = text.split("\n")
                for p, line in enumerate(lines):
                    if len(line) >= min_chars and len(key := line.strip(SPACE_CHARS)) >= min_chars:
                        x, y = struct.unpack("<qq", xxhash.xxh3_128_digest(key.translate(_LOWER).encode()))
                        h1.append(x)
                        h2.append(y)
                        at.append(doc)
                        row.append(r)
                        pos.append(p)
                        count.append(len(lines))
                if len(h1) >= 100_000 or i == len(ids) - 1:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(h1, pa.int64()), pa.array(h2, pa.int64()), pa.array(at, b.column(0).type),
                         pa.array(row, pa.int64()), pa.array(pos, pa.int32()), pa.array(count, pa.int32())],
                        names=["h1", "h2", "id", "row", "pos", "n_lines"])
                    h1, h2, at, row, pos, count = [], [], [], [], [], []
    return run


def _not_first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Streams sorted key rows: lines outside the first document of their run, and the outer runs' marks."""
    head = run = None  # keys of the partition's first and of the current run, with its first id

    def mark(key, first, kind):
        return pa.RecordBatch.from_arrays(
            [pa.array([_MARK], pa.int8()), pa.array([key[0]], pa.int64()), pa.array([key[1]], pa.int64()),
             pa.array([first], kind), pa.nulls(1, pa.int64()), pa.nulls(1, pa.int32()), pa.nulls(1, pa.int32())],
            names=["kind", "h1", "h2", "id", "row", "pos", "n_lines"])

    kind = pa.int64()
    for b in batches:
        if not b.num_rows:
            continue
        kind = b.column(2).type
        h1, h2 = (b.column(c).to_numpy(zero_copy_only=False) for c in (0, 1))
        ids = b.column(2).to_numpy(zero_copy_only=False)
        starts = np.r_[run is None or run[0] != (h1[0], h2[0]), (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])]
        place = np.cumsum(starts)  # 0: the run that the batch before ended with
        firsts = ids[np.flatnonzero(starts)]
        first = np.r_[[run[1] if run else ids[0]], firsts].astype(ids.dtype)[place]
        if head is None:
            head = (h1[0], h2[0])
            yield mark(head, ids[0], kind)
        in_head = (h1 == head[0]) & (h2 == head[1])
        out = np.flatnonzero((ids != first) | in_head)
        run = ((h1[-1], h2[-1]), first[-1])
        if len(out):
            got = b.take(pa.array(out))
            what = np.where(in_head[out], _PENDING, _DROP).astype(np.int8)
            yield pa.RecordBatch.from_arrays([pa.array(what), *got.columns],
                                             names=["kind", "h1", "h2", "id", "row", "pos", "n_lines"])
    if run is not None and run[0] != head:
        yield mark(*run, kind)


def _bitmaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        keep, dropped = [], []
        for n, positions in zip(b.column(2).to_pylist(), b.column(3), strict=True):
            bits = np.ones(n, bool)
            bits[positions.values.to_numpy()] = False
            keep.append(zlib.compress(np.packbits(bits).tobytes()))
            dropped.append(int(n - bits.sum()))
        yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(dropped, pa.int64()), pa.array(keep, pa.binary())],
                                         names=["id", "row", "n_lines", "n_dropped", "keep"])


def keep_bitmaps(docs: DataFrame, id_col: str = "doc_id", text: str = "text", min_chars: int = 10) -> DataFrame:
    """``(id_col, text_hash, n_lines, n_dropped, keep)`` of each document that loses lines.

    ``keep`` is a zlib-compressed bitmap, one bit per line from the first on, padded with
    zero bits; ``text_hash`` (xxhash64) tells rows apart that repeat an id.
    """
    find_package(docs)
    got = (docs.where(F.col(id_col).isNotNull())
           .select(F.col(id_col).alias("id"), F.xxhash64(text_or_empty(text)).alias("row"), text_or_empty(text).alias("t")))
    kind = got.schema["id"].dataType.simpleString()
    # Written once: range partitioning reads its input twice, first to sample it.
    keys = staged(got.mapInArrow(_key_rows(min_chars), f"h1 long, h2 long, id {kind}, row long, pos int, n_lines int"), "line-keys")
    found = staged(keys.repartitionByRange("h1", "h2", "id").sortWithinPartitions("h1", "h2", "id", "row", "pos")
                   .mapInArrow(_not_first, f"kind byte, h1 long, h2 long, id {kind}, row long, pos int, n_lines int"),
                   "line-runs")
    # At most two marks per partition, so this side's size is bounded by their number.
    marks = found.where(F.col("kind") == _MARK).groupBy("h1", "h2").agg(F.min("id").alias("first"))
    pending = (found.where(F.col("kind") == _PENDING).join(F.broadcast(marks), ["h1", "h2"])
               .where(F.col("id") > F.col("first")).select("id", "row", "n_lines", "pos"))
    drops = found.where(F.col("kind") == _DROP).select("id", "row", "n_lines", "pos").unionByName(pending)
    return (drops.groupBy("id", "row", "n_lines").agg(F.collect_set("pos").alias("pos"))
            .mapInArrow(_bitmaps, f"id {kind}, row long, n_lines int, n_dropped long, keep binary")
            .select(F.col("id").alias(id_col), F.col("row").alias("text_hash"), "n_lines", "n_dropped", "keep"))


@F.pandas_udf(StringType())
def _kept_lines(text: pd.Series, keep: pd.Series) -> pd.Series:
    out = []
    for t, k in zip(text, keep, strict=True):
        if t is None or k is None:
            out.append(None)
            continue
        lines = t.split("\n")
        bits = np.unpackbits(np.frombuffer(zlib.decompress(k), np.uint8), count=len(lines))
        out.append("\n".join(x for x, b in zip(lines, bits, strict=True) if b))
    return pd.Series(out, dtype=object)


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """All of ``docs`` with the dropped lines gone from ``text``, and ``_n_lines``, ``_n_dropped`` (long).

    A text that loses no line, null included, stays as it is.
    """
    find_package(docs)
    marks = bitmaps.select(F.col(id_col).alias("_ld_id"), F.col("text_hash").alias("_ld_row"),
                           F.col("n_dropped").alias("_ld_n"), F.col("keep").alias("_ld_keep"))
    joined = docs.join(marks, (F.col(id_col) == F.col("_ld_id"))
                       & (F.xxhash64(text_or_empty(text)) == F.col("_ld_row")), "left")
    hit = F.col("_ld_keep").isNotNull()
    return joined.withColumns({
        "_n_lines": F.size(F.split(text_or_empty(text), "\n")).cast("long"),
        "_n_dropped": F.coalesce(F.col("_ld_n"), F.lit(0)).cast("long"),
        text: F.when(hit, _kept_lines(F.when(hit, F.col(text)), F.col("_ld_keep"))).otherwise(F.col(text)),
    }).drop("_ld_id", "_ld_row", "_ld_n", "_ld_keep")
