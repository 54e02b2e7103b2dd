"""The registered queries of the operators and the pipeline, with DuckDB SQL where SQL can express them."""

from __future__ import annotations

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, chat_format, decontamination, licenses, line_dedup, pii, sharding, simhash, suffix_dedup, toxicity, turn_repair, vector_graph, whitening
from .common import table
from .oracle import ORACLE_SQL

VOCABULARY = "byte_bpe_50k.tiktoken"


def op1_pruned_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_graph.link_vectors(table(spark, sf_dir, "embeddings"), least=0.95)


def op2_feistel_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_rows(table(spark, sf_dir, "documents"), shards=16)


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, pattern = public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN
    return bpe.code_documents(table(spark, sf_dir, "documents").select("doc_id", "text"), path, pattern).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")).cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", *[c for c in licenses.ADDED if c != "detections"])


def op4_mph_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"), min_chars=10).select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op6_minhash_containment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), threshold=0.8, width=5)


def op7_simhash_bk_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), words=3, radius=2).select("doc_id", "fingerprint", "component_id")


def op8_pii_disclosure(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.sanitise_documents(table(spark, sf_dir, "documents"), redacted=False)
    joined = {
        name: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
        for name, spans in (("base", F.filter("spans", lambda s: s["kind"] != "term")), ("all", F.col("spans")))
    }

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(k) for k in pii.KINDS[:4]]
    return found.select("doc_id", *counts, F.sha2(joined["base"].cast("binary"), 256).alias("base_sha256"), joined["all"].alias("spans"))


def op9_toxic_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_toxicity(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels")).select(
        "doc_id", "held_out", "score", "predicted", "evidence")


def op10_deep_shallow(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op11_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turn_repair.repair_damaged(table(spark, sf_dir, "conversations"))


def op12_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(chat_format.probe(spark))
    return chat_format.digest_conversations(chat_format.format_turns(turns), dealt=True)


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten_vectors(table(spark, sf_dir, "embeddings"), count=4)


QUERIES = {
    "op1_pruned_graph": op1_pruned_graph,
    "op2_feistel_shards": op2_feistel_shards,
    "op3_byte_bpe": op3_byte_bpe,
    "op4_mph_line_dedup": op4_mph_line_dedup,
    "op5_license_scan": op5_license_scan,
    "op6_minhash_containment": op6_minhash_containment,
    "op7_simhash_bk_trees": op7_simhash_bk_trees,
    "op8_pii_disclosure": op8_pii_disclosure,
    "op9_toxic_neighbours": op9_toxic_neighbours,
    "op10_deep_shallow": op10_deep_shallow,
    "op11_turn_repair": op11_turn_repair,
    "op12_chat_format": op12_chat_format,
    "op13_whitening": op13_whitening,
    "pipeline": corpus_pipeline.run,
}

__all__ = ["ORACLE_SQL", "QUERIES"]
