"""The driver queries of this package: ``QUERIES`` and, where SQL can say the same, ``ORACLE``.

Each query applies its operator with production parameters to a whole table and derives the
digest columns of its contract from the operator's result.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table, text_or_empty
from .jaccard import similar_components
from .line_dedup import apply_bitmaps, keep_bitmaps
from .merkle import folded, leaf_digest, proof, prove
from .mixing import mix
from .packing import pack
from .quality import judge_against
from .secrets import BASE_RULES, scan, span_list
from .token_counts import count_tokens
from .toxicity import fit, score
from .vantage import nearest
from .vector_codes import books_digest, compress, with_label_errors
from .warc_zip import read_packages, write_packages
from .word_table_bpe import decode, encode

TOKENIZER, WORD_TOKENIZER = "byte_bpe_50k.json", "word_bpe_49k.json"


def op1_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_components(table(spark, sf_dir, "documents"), words=4, similarity=(85, 100))


def trusted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of the documents that the labels call good."""
    return table(spark, sf_dir, "labels").where("quality = 1 AND doc_id IS NOT NULL").select("doc_id").distinct()


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return judge_against(docs, trusted(spark, sf_dir)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "score")


def op3_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mix(docs).select("doc_id", F.col("_size").alias("size"), F.col("_source_size").alias("source_size"),
                            F.col("_target").alias("target"), (F.col("_copies") * F.col("_size")).alias("taken"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return score(docs, fit(docs, table(spark, sf_dir, "labels").select("doc_id", "toxic")))


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = [r.kind for r in BASE_RULES]
    kinds = F.transform("spans", lambda s: s["kind"])
    count = {f"n_{k}": (F.size(kinds) - F.size(F.array_remove(kinds, k))).cast("long") for k in base}
    return found.select("doc_id", *(c.alias(n) for n, c in count.items()),
                        F.sha2(span_list(F.col("spans"), base), 256).alias("base_sha256"), span_list(F.col("spans")).alias("spans"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = pack(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_packages(write_packages(table(spark, sf_dir, "pages"))).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op8_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return nearest(vectors, vectors.where("vec_id % 20 = 0"), k=20, factor=1.0)


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER), limit=512)


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return apply_bitmaps(docs, keep_bitmaps(docs)).select(
        "doc_id", F.col("_n_lines").alias("n_lines"), F.col("_n_dropped").alias("n_dropped"),
        F.sha2(text_or_empty(), 256).alias("kept_sha256"))


def op11_word_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(WORD_TOKENIZER)
    whole = decode(encode(table(spark, sf_dir, "documents"), path), path)
    return whole.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("text", 256).alias("decoded_sha256"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes, books = compress(table(spark, sf_dir, "embeddings"))
    return with_label_errors(codes).select(F.col("id").alias("vec_id"), F.lower(F.hex("codes")).alias("code"), "error", "label_error",
                                           F.lit(books_digest(books)).alias("codebooks_sha256"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    tampered = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    leaves = docs.select("doc_id", "source", leaf_digest(*fields, F.col("text")).alias("leaf"),
                         F.when(tampered, leaf_digest(*fields, F.translate("text", "\n", ""))).alias("tampered"))
    proven = prove(leaves).select("doc_id", "leaf", "subroot", "root", proof(F.col("path")).alias("proof_sha256"),
                                  folded(F.coalesce("tampered", "leaf"), F.col("path")).alias("folded_root"))
    return proven.withColumn("verified", F.col("folded_root") == F.col("root"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_jaccard": op1_jaccard,
    "op2_quality": op2_quality,
    "op3_source_mix": op3_source_mix,
    "op4_toxicity": op4_toxicity,
    "op5_secrets": op5_secrets,
    "op6_packing": op6_packing,
    "op7_warc": op7_warc,
    "op8_nearest": op8_nearest,
    "op9_token_counts": op9_token_counts,
    "op10_line_dedup": op10_line_dedup,
    "op11_word_bpe": op11_word_bpe,
    "op12_vector_codes": op12_vector_codes,
    "op13_merkle_manifest": op13_merkle_manifest,
}

_SPACE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORDS = r"list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '')"


def _codes_round(n: int) -> str:
    """Assignment ``a{n}`` by codebook ``b{n}``, and the next codebook."""
    return f"""
m{n} AS MATERIALIZED (SELECT r, p, min(list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT * 256 + j) AS m
      FROM x JOIN b{n} USING (p) GROUP BY r, p),
a{n} AS MATERIALIZED (SELECT r, p, m % 256 AS j, m // 256 AS d FROM m{n}),
s{n} AS (SELECT p, j, unnest(x) AS c, generate_subscripts(x, 1) AS i FROM a{n} JOIN x USING (r, p)),
t{n} AS (SELECT p, j, i, sum(c)::BIGINT AS s, count(*) AS n FROM s{n} GROUP BY p, j, i),
f{n} AS (SELECT p, j, list((s - ((s % n) + n) % n) // n ORDER BY i) AS c FROM t{n} GROUP BY p, j),
b{n + 1} AS MATERIALIZED (SELECT p, j, coalesce(f{n}.c, b{n}.c) AS c FROM b{n} LEFT JOIN f{n} USING (p, j))"""


def _hash_field(v: str) -> str:
    return f"CASE WHEN {v} IS NULL THEN '-' ELSE strlen({v}::VARCHAR) || ':' || {v}::VARCHAR END"


def _leaf_sql(text: str) -> str:
    return f"sha256({' || '.join(_hash_field(v) for v in ('doc_id', 'source', 'lang', 'n_chars', text))})"


ORACLE: dict[str, str] = {
    "op1_jaccard": f"""
WITH RECURSIVE d AS (SELECT doc_id, {_WORDS.replace("coalesce(text, '')", f"translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}')")} AS w FROM documents),
h AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
             ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))) END AS s FROM d),
x AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM h),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS shared
      FROM x a JOIN x b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id),
l AS (SELECT a, b FROM p WHERE 100 * shared >= 85 * (na + nb - shared)),
r AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a)
SELECT h.doc_id, len(s)::BIGINT AS n_shingles, (SELECT min(b) FROM r WHERE r.a = h.doc_id) AS component_id FROM h""",
    "op3_source_mix": f"""
WITH d AS (SELECT doc_id, source, len({_WORDS})::BIGINT AS size FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3) + 1 AS w FROM s),
r AS (SELECT *, 3.0::DOUBLE * source_size / w AS full_at FROM w),
l AS (SELECT *, (sum(source_size) OVER () - 3 * coalesce(sum(source_size) OVER o, 0))::DOUBLE
                / (sum(w) OVER () - coalesce(sum(w) OVER o, 0))::DOUBLE AS level
      FROM r WINDOW o AS (ORDER BY full_at, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
g AS (SELECT source, source_size, least(3.0::DOUBLE * source_size,
             (SELECT arg_min(level, full_at) FROM l WHERE level <= full_at) * w) AS target FROM l),
p AS (SELECT d.*, CASE WHEN size > 0 THEN floor(log2(size::DOUBLE) * 4) ELSE -1 END::BIGINT AS c,
             coalesce(doc_id, 0) % (SELECT greatest(1, ceil(sqrt(count(*)) / 32)) FROM documents)::BIGINT AS b FROM d),
q AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY c, b, size, doc_id NULLS FIRST) AS place FROM p),
e AS (SELECT q.doc_id, q.size, g.source_size, g.target, q.place::DOUBLE AS place,
             CASE WHEN g.source_size > 0 THEN g.target / g.source_size ELSE 0 END AS rate,
             ('0x' || substr(md5(coalesce(q.source, '\\N') || ':11'), 1, 8))::BIGINT / 4294967296::DOUBLE AS u
      FROM q JOIN g ON q.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, size, source_size, target,
       (least(3, floor(place * rate + u) - floor((place - 1) * rate + u)) * size)::BIGINT AS taken FROM e""",
    "op7_warc": """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
d AS (SELECT page_id, octet_length(b)::BIGINT AS n, sha256(b) AS h FROM p),
f AS (SELECT h, min(page_id) AS first FROM d WHERE n >= 100 GROUP BY h)
SELECT page_id, n AS payload_bytes, d.h AS payload_digest,
       CASE WHEN first IS NULL OR page_id IS NOT DISTINCT FROM first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN first IS NULL OR page_id IS NOT DISTINCT FROM first THEN NULL ELSE first END AS refers_to
FROM d LEFT JOIN f ON d.h = f.h""",
    "op8_nearest": """
WITH v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
           AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
           AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e) AS score
      FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id AND len(q.e) = len(c.e)),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20""",
    "op10_line_dedup": f"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM d),
k AS (SELECT *, translate(trim(line, {_SPACE}), '{_UPPER}', '{_LOWER}') AS key FROM l),
f AS (SELECT key, min(doc_id) AS first FROM k WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) > 1),
x AS (SELECT k.doc_id, line, pos, f.first IS NOT NULL AND k.doc_id <> f.first AS dropped FROM k LEFT JOIN f ON k.key = f.key)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (WHERE dropped)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM x GROUP BY doc_id""",
    "op12_vector_codes": f"""
WITH e AS (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings WHERE embedding IS NOT NULL
           AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
v AS MATERIALIZED (SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, e) AS r, vec_id, label,
                   list_transform(e, lambda x: floor(1024 * x)::BIGINT) AS q FROM e),
x AS MATERIALIZED (SELECT r, p, q[p * (len(q) // 4) + 1:(p + 1) * (len(q) // 4)] AS x FROM v, (SELECT unnest(range(4)) AS p)),
b0 AS MATERIALIZED (SELECT p, r - 1 AS j, x AS c FROM x WHERE r <= 256),{",".join(_codes_round(n) for n in range(5))},
k AS (SELECT p, j, unnest(c) AS c, generate_subscripts(c, 1) AS i FROM b4),
o AS (SELECT r, string_agg(printf('%02x', j), '' ORDER BY p) AS code, sum(d)::BIGINT AS error FROM a4 GROUP BY r)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
       (SELECT sha256(string_agg(c::VARCHAR, ',' ORDER BY p, j, i)) FROM k) AS codebooks_sha256 FROM o JOIN v USING (r)""",
    "op13_merkle_manifest": f"""
WITH RECURSIVE crc_table AS (SELECT list_transform(range(256), lambda i: list_reduce(range(8),
       lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, i)) AS crc),
d AS MATERIALIZED (SELECT doc_id, source, lang, n_chars, text, row_number() OVER () AS id, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS s,
     {_leaf_sql('text')} AS leaf, doc_id IS NOT NULL AND list_reduce(list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT),
       lambda c, x: xor(c // 256, crc[(xor(c, x) % 256) + 1]), 4294967295) % 2 = 1 AS tampered FROM documents, crc_table),
r AS MATERIALIZED (SELECT id, s, doc_id, leaf, CASE WHEN tampered THEN {_leaf_sql("replace(text, chr(10), '')")} ELSE leaf END AS given,
     row_number() OVER (PARTITION BY s ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY s) AS n FROM d),
t AS (SELECT s, 0 AS l, i, n, leaf AS h FROM r
      UNION ALL SELECT s, l + 1, i // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY i)) FROM t WHERE n > 1 GROUP BY s, l, i // 3, n),
subroots AS (SELECT s, h FROM t WHERE n = 1),
u AS (SELECT 0 AS l, s AS i, (SELECT count(*) FROM subroots) AS n, h FROM subroots
      UNION ALL SELECT l + 1, i // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY i)) FROM u WHERE n > 1 GROUP BY l, i // 3, n),
p AS (SELECT id, s, 0 AS l, i, n, given AS h, '' AS proof FROM r
      UNION ALL SELECT p.id, p.s, p.l + 1, p.i // 3, (p.n + 2) // 3, sha256(string_agg(CASE WHEN t.i = p.i THEN p.h ELSE t.h END, '' ORDER BY t.i)),
                p.proof || coalesce(string_agg(t.h, '' ORDER BY t.i) FILTER (WHERE t.i <> p.i), '')
      FROM p JOIN t ON t.s = p.s AND t.l = p.l AND t.i // 3 = p.i // 3 WHERE p.n > 1 GROUP BY p.id, p.s, p.l, p.i, p.n, p.proof),
q AS (SELECT id, 0 AS l, s AS i, (SELECT count(*) FROM subroots) AS n, h, proof FROM p WHERE n = 1
      UNION ALL SELECT q.id, q.l + 1, q.i // 3, (q.n + 2) // 3, sha256(string_agg(CASE WHEN u.i = q.i THEN q.h ELSE u.h END, '' ORDER BY u.i)),
                q.proof || coalesce(string_agg(u.h, '' ORDER BY u.i) FILTER (WHERE u.i <> q.i), '')
      FROM q JOIN u ON u.l = q.l AND u.i // 3 = q.i // 3 WHERE q.n > 1 GROUP BY q.id, q.l, q.i, q.n, q.proof)
SELECT doc_id, leaf, subroots.h AS subroot, u.h AS root, sha256(q.proof) AS proof_sha256, q.h AS folded_root, q.h = u.h AS verified
FROM r JOIN subroots USING (s) JOIN q ON q.id = r.id AND q.n = 1 JOIN u ON u.n = 1""",
}
