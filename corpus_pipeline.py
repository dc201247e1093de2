"""Documents to packed training sequences: the stages, and one run of them.

A stage takes all rows that the one before kept and is written as Parquet
before the next one reads it, so a lost executor costs a part of one stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tabmill.llm import packing, robust_rules, secret_scan, simhash
from tabmill.llm.shared import staged, table


# Bytes of a batch that a Python worker holds at once; texts pass through several of them.
BATCH_BYTES = 8 << 20


def _bounded(docs: DataFrame) -> DataFrame:
    docs.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return docs


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the base rules or the robust distance reject."""
    return robust_rules.keep_good(_bounded(docs))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: that of the smallest doc_id."""
    return simhash.keep_one(_bounded(docs))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secret values masked in the text."""
    return secret_scan.hide_secrets(_bounded(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each piece with its place in a sequence."""
    return packing.packed(_bounded(docs))


STAGES = [("quality rules", quality_rules), ("SimHash near-dedup", near_dedup), ("secret scan", secrets), ("best-fit packing", pack)]

# Robust estimates, XXH64 fingerprints, lexing and tokenizing have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name.lower().replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)


QUERIES = {"pipeline": run}
ORACLES: dict[str, str] = {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
