"""A corpus run in stages; each takes and (but for the last) returns the columns of ``documents``."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wideflow.llm.common import SPACE_CHARS, staged, table, text_or_empty
from wideflow.llm.jaccard import similar_components
from wideflow.llm.line_dedup import apply_bitmaps, keep_bitmaps
from wideflow.llm.mixing import mix
from wideflow.llm.packing import pack
from wideflow.llm.quality import judge_against
from wideflow.llm.queries import trusted

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail a base rule or read unlike the trusted ones go."""
    return judge_against(docs, trusted(spark, sf_dir)).where("kept").select(COLUMNS)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated lines go from all documents but the first, and with them a document that held no others; ``n_chars`` follows the text.

    Documents that were without words before stay.
    """
    kept = apply_bitmaps(docs, keep_bitmaps(docs))
    kept = kept.where((F.col("_n_dropped") == 0) | (F.btrim(text_or_empty(), F.lit(SPACE_CHARS)) != ""))
    return kept.withColumn("n_chars", F.when(F.col("_n_dropped") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked by a Jaccard similarity of at least 0.8 on five-word shingles, the smallest id stays.

    Documents without words, which link with nothing, stay; so do rows without an id.
    """
    groups = similar_components(docs, words=5, similarity=(4, 5))
    gone = groups.where("doc_id <> component_id").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mix(docs).where("_copies > 0").withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies")))).select(COLUMNS)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of at most 1024 tokens."""
    return pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("quality_rules", quality_rules), ("line_dedup", line_dedup), ("near_duplicates", near_duplicates),
          ("mix_sources", mix_sources), ("pack_sequences", pack_sequences)]
#: Hashed n-grams, tokens and packing have no SQL form; the stages are tested one by one against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
