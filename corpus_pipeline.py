"""The corpus pipeline: toxicity, line dedup, SimHash near-dedup, benchmark decontamination, byte-level BPE.

Each stage works on all that its predecessor kept; its result is written as
Parquet in the shared folder and read again as the next one's documents, so a
lost executor never repeats more than one stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weekly_impact.llm import bpe, decontamination, line_dedup, simhash, toxicity
from weekly_impact.llm.common import table, written


def toxic_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity scorer accepts (predicted 0)."""
    scored = toxicity.score_toxicity(docs, table(spark, sf_dir, "labels"))
    return scored.where("predicted = 0").select(*docs.columns)


def lines_once(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that an earlier document holds; n_chars follows the text."""
    deduped = line_dedup.dedup_lines(docs)
    text = F.when(F.col("n_dropped") > 0, F.col("kept")).otherwise(F.col("text"))
    return deduped.withColumn("text", text).withColumn(
        "n_chars", F.when(F.col("n_dropped") > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
    ).select(*docs.columns)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest id.

    Rows without an id all stay.  Rows that share an id but hold texts of
    different groups are different documents, and each group keeps its own;
    of one id's several texts in a group, that with the least hash stays.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    own = ["text_a", "text_b"]
    while {c.lower() for c in docs.columns} & set(own):  # names that no input column has
        own = [f"_{c}" for c in own]
    key = ["doc_id", *own]
    hashed = docs.withColumns({own[0]: F.xxhash64(text), own[1]: F.xxhash64(F.lit(1), text)})
    groups = simhash.near_duplicates(docs).where("kept and doc_id is not null")
    kept = groups.groupBy("doc_id", "group").agg(F.min(F.struct("text_a", "text_b")).alias("t")).select("doc_id", "t.*").distinct()
    known = hashed.where("doc_id is not null").join(kept.toDF(*key), key, "left_semi").dropDuplicates(key)
    return known.select(*docs.columns).unionByName(docs.where("doc_id is null"))


def leaks_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    return decontamination.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, the token ids of the whole text, and whether decoding them gives the text back."""
    path, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    back = bpe.code_documents(docs.select("doc_id", "lang", "source", "text"), path, pattern)
    same = F.col("decoded") == F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return back.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids", same.alias("round_trip"))


STAGES = [
    ("toxicity", toxic_out),
    ("line_dedup", lines_once),
    ("simhash_near_dedup", one_of_each_group),
    ("benchmark_decontamination", leaks_out),
    ("byte_bpe", tokens),
]

# Models, hashing by XXH64 and BPE are beyond SQL; tests compare run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The token table of all documents that come through the stages."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
