"""Quality rules: fixed base rules and a log-likelihood ratio of hashed n-grams.

Words and pairs of adjacent words are n-grams; their 64-bit hashes fall into buckets, whose number grows with the root of
the corpus (``bucket_count``). One map-side combined aggregate counts each bucket in all documents and in a trusted part
of them. Where the trusted part would hold ``e`` of a bucket's occurrences if it were like the rest and holds ``own``, the
bucket's weight is log((own + ``PRIOR``) / (e + ``PRIOR``)): near 0 where there is too little to tell, which is how sampling
error enters, far below 0 for what the trusted part lacks. Weights are fixed-point integers. A document's score is the mean weight of its
n-grams. Documents of at least ``-LEAST`` are kept, unless a base rule fails; the threshold is the same at every
size, and nothing depends on order, partitions or other documents' outcome.

Only DataFrame functions are used. Up to ``PACKED_BYTES`` the weights are one packed array that every task gets, two
bytes a bucket. Beyond that they stay distributed: buckets above a ``1 / FREQUENT`` share of all occurrences, fewer than
``FREQUENT`` by that, are broadcast, and the documents' other n-grams meet their weights in a shuffle join, in which no key
holds more than that share. Both ways give the same scores.

Defined cases: a null or empty text, or one without words, has no n-grams, a score of 0 and
fails a base rule; null ids and repeated rows are scored like any other; without trusted
documents all weights and scores are 0 and only base rules decide; an empty table gives no rows; columns
other than the text pass through as they are (beyond ``PACKED_BYTES``, joined by hashes of the row).
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE_CHARS, computed_once, small_enough, staged, text_or_empty, words

#: Buckets for each root of a character of the corpus: about 2 ** 20 for 170 million characters.
BUCKETS_PER_ROOT, LEAST_BUCKETS = 80, 1 << 18
#: Weights are integers of this part of a natural logarithm, in 16 bits.
SCALE, CHUNK = 2048, 4096
#: Occurrences by which a bucket's trusted and expected counts are drawn together, and how far below 0 a kept score may lie.
PRIOR, LEAST = 4.0, 0.15
#: Bytes of weights that each task gets; beyond, at most so many weights are broadcast.
PACKED_BYTES, FREQUENT = 64_000_000, 131_072
#: Up to so many trusted ids are broadcast.
BROADCAST_IDS = 500_000
WINDOW = 8
SYMBOLS = "#*$%&|<>"


def _joined(h: str, apart: int) -> Column:
    """One hash for each two elements so far apart of an array column of hashes."""
    return F.expr(f"transform(slice({h}, 1, greatest(size({h}) - {apart}, 0)), (x, i) -> xxhash64(x, {h}[i + {apart}]))")


def _with_hashes(docs: DataFrame, text: str) -> DataFrame:
    """``docs`` with the hashes of its words and of its pairs of adjacent words."""
    return (docs.withColumn("_q_hashes", F.transform(words(text_or_empty(text)), lambda x: F.xxhash64(x)))
            .withColumn("_q_pairs", _joined("_q_hashes", 1)))


def _covered(at: Column) -> Column:
    """Number of places that windows at the given ascending starts cover."""
    # Each window adds what lies behind the end of the one before.
    return F.aggregate(
        at, F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end")),
        lambda s, i: F.struct((s["n"] + (i + WINDOW) - F.greatest(s["end"], i)).cast("long").alias("n"), (i + WINDOW).cast("int").alias("end")),
        lambda s: s["n"])


def _occurrences(t: Column, characters: str) -> Column:
    """How many of some ASCII characters a text holds."""
    rest = reduce(lambda s, c: F.replace(s, F.lit(c), F.lit("")), characters, t)
    return (F.octet_length(t) - F.octet_length(rest)).cast("long")


def base_features(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``_q_hashes``, ``_q_pairs`` and the counts ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines``, ``n_repeat_words``."""
    t = text_or_empty(text)
    lines = F.filter(F.split(t, "\n"), lambda x: F.btrim(x, F.lit(SPACE_CHARS)) != "")
    d = _with_hashes(docs, text).withColumn("_q_lines", lines)
    # A window's hash is made of those of its halves, and theirs of pairs.
    d = d.withColumn("_q_fours", _joined("_q_pairs", 2)).withColumn("_q_windows", _joined("_q_fours", 4))
    # Windows in the order of their hashes, only where two are equal. They are a column of their own, as a
    # lambda would make the array anew for each element.
    placed = F.sort_array(F.transform("_q_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    d = d.withColumn("_q_placed", computed_once(F.when(F.size(F.array_distinct("_q_windows")) < F.size("_q_windows"), placed)))
    h = F.transform("_q_placed", lambda x: x["h"])
    d = d.withColumn("_q_sorted", h)
    twice = F.filter("_q_placed", lambda x, i: (x["h"] == F.get("_q_sorted", i - 1)) | (x["h"] == F.get("_q_sorted", i + 1)))
    return d.withColumns({
        "n_words": F.size("_q_hashes").cast("long"),
        "word_chars": F.length(t) - _occurrences(t, SPACE_CHARS),
        "n_symbols": _occurrences(t, SYMBOLS),
        "n_dup_lines": (F.size("_q_lines") - F.size(F.array_distinct("_q_lines"))).cast("long"),
        "n_repeat_words": F.coalesce(_covered(F.sort_array(F.transform(twice, lambda x: x["i"]))), F.lit(0).cast("long")),
    }).drop("_q_fours", "_q_windows", "_q_placed", "_q_sorted", "_q_lines")


def bucket_count(docs: DataFrame, text: str = "text") -> int:
    """Buckets for a corpus: in proportion to the root of its characters."""
    characters = docs.agg(F.sum(F.length(text).cast("long"))).first()[0] or 0
    return max(LEAST_BUCKETS, math.ceil(BUCKETS_PER_ROOT * math.sqrt(characters)))


def _bucket(h: Column, buckets: int) -> Column:
    return F.pmod(h, F.lit(buckets).cast("long")).cast("int")


def gram_counts(docs: DataFrame, trusted_ids: DataFrame, buckets: int, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``(g, raw, own)`` of every bucket: how many n-grams all and how many the trusted documents hold there.

    ``trusted_ids`` names the trusted documents by distinct ids in a column like ``id_col``.
    """
    # Beyond a number of trusted ids the texts are shuffled to meet them.
    flags = trusted_ids.select(F.col(id_col), F.lit(1).alias("_q_t")).hint("broadcast" if small_enough(trusted_ids, BROADCAST_IDS) else "merge")
    flagged = docs.select(id_col, text).join(flags, id_col, "left").select(F.coalesce("_q_t", F.lit(0)).alias("t"), text)
    grams = _with_hashes(flagged, text).select("t", F.explode(F.concat("_q_hashes", "_q_pairs")).alias("h"))
    met = grams.select(_bucket(F.col("h"), buckets).alias("g"), F.lit(1).alias("n"), "t")
    every = docs.sparkSession.range(buckets).select(F.col("id").cast("int").alias("g"), F.lit(0).alias("n"), F.lit(0).alias("t"))
    return staged(met.unionByName(every).groupBy("g").agg(F.sum("n").alias("raw"), F.sum("t").alias("own")), "quality-grams")


def ratio_weights(counts: DataFrame, prior: float = PRIOR) -> DataFrame:
    """``(g, raw, w)``: each bucket's log ratio in units of ``1 / SCALE``."""
    n_raw, n_own = (counts.agg(F.coalesce(F.sum(c), F.lit(0)).cast("double")).first()[0] for c in ("raw", "own"))
    expected = F.col("raw") * F.lit(n_own / max(n_raw, 1.0))
    w = F.round(F.log((F.col("own") + prior) / (expected + prior)) * SCALE)
    return counts.select("g", "raw", F.greatest(F.least(w, F.lit(32767.0)), F.lit(-32767.0)).cast("smallint").alias("w"))


def _sums_packed(d: DataFrame, weights: DataFrame, buckets: int) -> DataFrame:
    """``_q_sum`` and ``_q_n``, the weights and number of a document's n-grams, by one array of all weights."""
    chunks = weights.groupBy(F.floor(F.col("g") / CHUNK).alias("c")).agg(F.sort_array(F.collect_list(F.struct("g", "w"))).alias("a"))
    chunks = chunks.select("c", F.transform("a", lambda x: x["w"]).alias("a"))
    packed = staged(chunks.agg(F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("c", "a"))), lambda x: x["a"])).alias("w")), "quality-weights")
    # A subquery's value: one array for all rows.
    d = d.withColumn("_q_weights", packed.select("w").scalar())
    total = F.aggregate(F.concat("_q_hashes", "_q_pairs"), F.lit(0).cast("long"), lambda s, x: s + F.get("_q_weights", _bucket(x, buckets)))
    return d.withColumns({"_q_sum": total, "_q_n": F.size("_q_hashes") + F.size("_q_pairs")}).drop("_q_weights")


def _sums_joined(d: DataFrame, weights: DataFrame, buckets: int, text: str, frequent: int) -> DataFrame:
    """The same by joins of n-grams and weights."""
    weights = staged(weights, "quality-weights")
    often = F.col("raw") * F.lit(frequent) > F.lit(weights.agg(F.coalesce(F.sum("raw"), F.lit(0))).first()[0])
    hot, seldom = F.broadcast(weights.where(often).select("g", "w")), weights.where(~often).select("g", "w")
    # Rows are told apart by 128 bits: of the text, and of all columns, so that copies of a text spread over tasks.
    hashable = [f.name for f in d.schema.fields if "map<" not in f.dataType.simpleString() and not f.name.startswith("_q_")]
    d = d.withColumns({"_q_k1": F.xxhash64(text_or_empty(text)), "_q_k2": F.xxhash64(F.lit(1), *hashable)})
    grams = d.select("_q_k1", "_q_k2", F.explode(F.concat("_q_hashes", "_q_pairs")).alias("h")).select("_q_k1", "_q_k2", _bucket(F.col("h"), buckets).alias("g"))
    met = grams.join(hot, "g").unionByName(grams.join(hot, "g", "left_anti").join(seldom.hint("merge"), "g"))
    # Repeated rows share a key and add equal parts to both.
    sums = met.groupBy("_q_k1", "_q_k2").agg(F.sum("w").alias("_q_sum"), F.count("*").alias("_q_n"))
    return d.join(sums, ["_q_k1", "_q_k2"], "left").drop("_q_k1", "_q_k2")


def judge(docs: DataFrame, counts: DataFrame, buckets: int, text: str = "text", prior: float = PRIOR, least: float = LEAST,
          packed_bytes: int = PACKED_BYTES, frequent: int = FREQUENT) -> DataFrame:
    """All of ``docs`` with the base counts, ``base_failed``, ``score`` and ``kept``, by the table of ``gram_counts``."""
    weights, d = ratio_weights(counts, prior), base_features(docs, text)
    d = _sums_packed(d, weights, buckets) if 2 * buckets <= packed_bytes else _sums_joined(d, weights, buckets, text, frequent)
    score = F.coalesce(F.col("_q_sum") / F.nullif("_q_n", F.lit(0)) / F.lit(float(SCALE)), F.lit(0.0))
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return (d.withColumns({"base_failed": failed, "score": score}).drop("_q_hashes", "_q_pairs", "_q_sum", "_q_n")
            .withColumn("kept", computed_once(~F.col("base_failed") & (F.col("score") >= -least))))


def judge_against(docs: DataFrame, trusted_ids: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``judge`` by the corpus's own counts."""
    buckets = bucket_count(docs, text)
    return judge(docs, gram_counts(docs, trusted_ids, buckets, id_col, text), buckets, text)
