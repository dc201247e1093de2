"""Session set-up, checkpoint folder, staging, and size-checked small tables."""

from __future__ import annotations

import os
import tempfile
import uuid
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# A table is broadcast only when its measured size stays below this.
BROADCAST_BYTES = 64 * 1024 * 1024
# Measured tables up to this size are held as local rows of the plan.
LOCAL_BYTES = 8 * 1024 * 1024

SESSION_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Methods above 8000 bytes of bytecode are never JIT-compiled: wide
    # projections then run many times slower than in split-up form.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def build_session(app_name: str = "tabmill", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def for_wide_plans(spark: SparkSession) -> None:
    """Give a session that was built elsewhere the code size limit of wide projections."""
    key = "spark.sql.codegen.hugeMethodLimit"
    spark.conf.set(key, SESSION_DEFAULTS[key])


def ident(name: str) -> Column:
    """Column by its exact name: expanded keys hold dots, blanks and Cyrillic."""
    return F.col(quoted(name))


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder named by the cluster; a temporary one only in local mode."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(configured)
        return configured
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tabmill-checkpoint-"))
    return spark.sparkContext.getCheckpointDir()


def checkpointed(df: DataFrame) -> DataFrame:
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def staged(df: DataFrame, name: str, folder: str | None = None) -> DataFrame:
    """Write a stage as Parquet in shared storage and scan it again.

    Later passes then read only the columns they need, and a lost executor
    costs a re-read, not a recomputation of the whole chain.
    """
    spark = df.sparkSession
    base = folder or f"{checkpoint_dir(spark)}/stages"
    path = f"{base}/{name}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    return spark.read.parquet(path)


@dataclass
class SizedTable:
    """A computed table with its exact row count and measured size."""

    df: DataFrame
    rows: int
    size: int

    @property
    def small(self) -> bool:
        return self.size <= BROADCAST_BYTES


def _row_bytes(df: DataFrame) -> Column:
    total = F.lit(16 * len(df.columns))
    for name, dtype in df.dtypes:
        if dtype in ("string", "binary"):
            total = total + F.coalesce(F.octet_length(ident(name)), F.lit(0))
        elif dtype.startswith(("array", "map", "struct")):
            total = total + F.coalesce(F.octet_length(F.to_json(F.struct(ident(name)))), F.lit(0))
    return total


def sized(df: DataFrame) -> SizedTable:
    """Compute a table once and measure it.

    Small results become local rows; larger ones are checkpointed.
    """
    held = df.persist()
    try:
        stats = held.agg(F.count(F.lit(1)), F.sum(_row_bytes(df).cast("bigint"))).first()
        rows, size = stats[0], int(stats[1] or 0)
        if size <= LOCAL_BYTES:
            kept = df.sparkSession.createDataFrame(held.toArrow(), schema=df.schema)
        else:
            kept = checkpointed(held)
    finally:
        held.unpersist()
    return SizedTable(kept, rows, size)


def with_package(df: DataFrame) -> DataFrame:
    """`df`, after this package's folder went on the import path of Python workers.

    That serves sessions on machines that share the folder; other clusters
    take the package by --py-files.
    """
    root = str(Path(__file__).resolve().parent.parent)
    environment = df.sparkSession.sparkContext.environment
    paths = [x for x in environment.get("PYTHONPATH", "").split(os.pathsep) if x]
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([root, *paths])
    return df
