"""Token counts by a two-tier lookup of pre-token lengths, without a pre-token shuffle.

A first scan lets each task name its most frequent pre-tokens (a bounded summary);
their token lengths become a compact table that is broadcast. The second scan looks
pre-tokens up there and encodes misses through a cache that the worker keeps. The
table decides only how fast a count is found, never its value.

Defined cases: a null text counts as empty (0 bytes, 0 tokens); a null id and
repeated rows give one row each; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import find_package, text_or_empty, text_slices
from .pretokens import MAX_KEPT_CHARS, PretokenCache, cut, load

#: Pre-tokens that a task counts at a time, and that it names.
COUNTED, NAMED = 200_000, 2_000


def _frequent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    n: Counter = Counter()
    for b in batches:
        texts = b.column(0).to_pylist()
        for i, j in text_slices(texts):
            for t in texts[i:j]:
                if t:
                    n.update(cut(t)[1:])
            if len(n) > COUNTED:
                n = Counter({k: v for k, v in n.items() if v > 1 and len(k) <= MAX_KEPT_CHARS})
                if len(n) > COUNTED:
                    n = Counter(dict(n.most_common(COUNTED // 2)))
    top = [(k, v) for k, v in n.most_common(NAMED) if len(k) <= MAX_KEPT_CHARS]
    yield pa.RecordBatch.from_pydict({"part": pa.array([k for k, _ in top], pa.string()),
                                      "n": pa.array([v for _, v in top], pa.int64())})


def frequent_lengths(docs: DataFrame, tokenizer_path: str, text: str = "text", size: int = 20_000) -> dict[str, int]:
    """Token lengths of the ``size`` pre-tokens that tasks name most (at most NAMED from each)."""
    top = (docs.select(F.col(text).alias("t")).mapInArrow(_frequent, "part string, n long")
           .groupBy("part").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "part").limit(size))
    parts = [r["part"] for r in top.collect()]  # bounded by `size`
    tok, _ = load(tokenizer_path)
    return {p: len(e.ids) for p, e in
            zip(parts, tok.encode_batch([" " + p for p in parts], add_special_tokens=False), strict=True)}


_CACHE: dict = {}


def _cache(path: str, key: int, table) -> PretokenCache:
    if _CACHE.get("key") != (path, key):
        parts, lengths = table.value
        _CACHE.update(key=(path, key), cache=PretokenCache(path, len, dict(zip(parts.split("\0"), lengths, strict=True)) if lengths else None))
    return _CACHE["cache"]


def count_tokens(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text: str = "text",
                 limit: int = 512) -> DataFrame:
    """``(id_col, n_bytes, n_tokens, over_limit)`` of every document's whole text."""
    find_package(docs)
    spark = docs.sparkSession
    lengths = frequent_lengths(docs, tokenizer_path, text)
    # One string and one byte per entry: parts never hold \0 (kept out) nor 256 tokens or more.
    lengths = {k: v for k, v in lengths.items() if "\0" not in k and v < 256}
    sent = spark.sparkContext.broadcast(("\0".join(lengths), bytes(lengths.values())))
    key = sent._jbroadcast.id() if sent._jbroadcast is not None else 0

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = _cache(tokenizer_path, key, sent)
        for b in batches:
            texts, n = b.column(2).to_pylist(), []
            for i, j in text_slices(texts):
                n += cache.texts(texts[i:j], sum)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(n, pa.int64())],
                                             names=["id", "n_bytes", "n_tokens"])

    got = docs.select(F.col(id_col).alias("id"), F.octet_length(text_or_empty(text)).cast("long").alias("n_bytes"),
                      F.col(text).alias("t"))
    kind = got.schema["id"].dataType.simpleString()
    return (got.mapInArrow(count, f"id {kind}, n_bytes long, n_tokens long")
            .select(F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")))
