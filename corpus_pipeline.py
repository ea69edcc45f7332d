"""Corpus cleaning pipeline: stages over `documents`, each written and read again.

Each stage is called with the table its predecessor left and applies one operator of
``tastemap.llm`` to all of it. Rows are told apart by id and text, or by a number of their own, where ids
may be null or repeated, so a decision about one row never falls on another. Helper columns
get names that the table does not have.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tastemap.llm import bpe, contain, minhash, pii, quality
from tastemap.llm.frames import saved, table


def _free(docs: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``docs`` has it."""
    while name.lower() in map(str.lower, docs.columns):
        name = "_" + name
    return name


def _keyed(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with a column of the id and a hash of the text, and that column's name."""
    key = _free(docs, "_row_key")
    ident = F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))
    return docs.withColumn(key, F.concat_ws(":", ident, F.xxhash64("text").cast("string"), F.length("text").cast("string"))), key


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go; null and empty texts are among them."""
    keyed, key = _keyed(docs)
    bad = quality.judge(keyed, key).filter("not kept").select(key).distinct()
    return keyed.join(bad, key, "left_anti").select(docs.columns)


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates (shingles of five words, similarity 0.8) the row with the smallest id
    stays, one without an id only if none has one. Rows are linked by their texts alone: unlike texts under
    one id both stay, and so does every row without words."""
    row = _free(docs, "_row")
    # numbers of rows, written once: reading the table twice must not number it anew
    numbered = saved(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    found = minhash.near_duplicates(numbered.select(row, "text"), id_col=row).select(F.col(row).alias("r"), F.col("component_id").alias("c"))
    named = saved(found.join(numbered.select(F.col(row).alias("r"), F.col("doc_id").alias("i")), "r"), "near-duplicates")
    first = named.groupBy("c").agg(F.min(F.struct(F.col("i").isNull(), "i", "r"))["r"].alias("first"), F.count("*").alias("n"))
    bad = named.join(first.filter("n > 1"), "c").filter("r <> first").select(F.col("r").alias(row))
    return numbered.join(bad, row, "left_anti").select(docs.columns)


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold at least 80 % of the five-word shingles of a benchmark item go."""
    keyed, key = _keyed(docs)
    bad = contain.leaks(keyed, table(spark, sf_dir, "benchmark"), key).select(key).distinct()
    return keyed.join(bad, key, "left_anti").select(docs.columns)


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind in angle brackets; ``n_chars`` follows the text."""
    out = pii.redact(docs, pii.train(docs))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.col("n_chars")))
    return out.select(docs.columns)


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each text, and the text decoded from them (a null text becomes empty). Columns named
    ``ids``, ``n_tokens`` or ``ids_sha256`` are replaced by the stage's own."""
    tokenizer = bpe.default_tokenizer()
    carry = [c for c in docs.columns if c not in ("text", "ids", "n_tokens", "ids_sha256")]
    return bpe.decode(bpe.encode(docs, tokenizer, carry), tokenizer, keep_ids=True)


STAGES = [("quality_rules", quality_stage), ("near_dedup", dedup_stage), ("decontaminate", decontaminate_stage),
          ("pii", pii_stage), ("bpe", bpe_stage)]

# a trained tagger and a tokenizer are no SQL; tests/llm compares the run with a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), name)
    return docs
