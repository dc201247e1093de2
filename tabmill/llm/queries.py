"""Registered queries of the text operators, each over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tabmill.llm import chat_format, hilbert_shards, hnsw, maxent_lm, merkle, nbest_pieces, packing, repeats, robust_rules, secret_scan, simhash, style_tree, va_clusters
from tabmill.llm.shared import table

QUERIES = {}
ORACLES: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op8_simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, folder, "documents"))


@query
def op10_robust_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return robust_rules.verdicts(table(spark, folder, "documents"))


@query
def op6_assignment_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    return secret_scan.scan(table(spark, folder, "documents"))


@query
def op7_dominance_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.packed(table(spark, folder, "documents"))


@query
def op1_hilbert_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return hilbert_shards.sharded(table(spark, folder, "documents"))


@query
def op9_role_machine_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    return chat_format.digests(chat_format.with_probe(table(spark, folder, "conversations")))


ORACLES["op9_role_machine_chat_format"] = chat_format.ORACLE_SQL


@query
def op4_site_style_tree(spark: SparkSession, folder: str) -> DataFrame:
    return style_tree.main_text(table(spark, folder, "pages"))


@query
def op3_hnsw_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return hnsw.near_duplicates(table(spark, folder, "embeddings"))


@query
def op2_hashed_maxent_lm(spark: SparkSession, folder: str) -> DataFrame:
    return maxent_lm.scored(table(spark, folder, "documents"))


@query
def op5_nbest_segmentation(spark: SparkSession, folder: str) -> DataFrame:
    return nbest_pieces.encoded(table(spark, folder, "documents"))


@query
def op11_bitmap_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    found = merkle.manifest(table(spark, folder, "documents"))
    return found.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


ORACLES["op11_bitmap_merkle_manifest"] = merkle.ORACLE_SQL


@query
def op13_va_file_clustering(spark: SparkSession, folder: str) -> DataFrame:
    return va_clusters.clustered(table(spark, folder, "embeddings"))


ORACLES["op13_va_file_clustering"] = va_clusters.ORACLE_SQL


@query
def op12_seed_extend_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return repeats.digests(repeats.without_repeats(table(spark, folder, "documents")))


ORACLES["op12_seed_extend_dedup"] = repeats.ORACLE_SQL
