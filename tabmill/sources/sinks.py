"""Sinks: delimited export, per-source folders, read-back check, settings."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabmill.runtime import ident
from tabmill.sources.delimited import SOURCE_FILE, missing_cells_to_null


def write_delimited(df: DataFrame, path: str, sep: str = ",", quote_all: bool = False, mode: str = "errorifexists") -> None:
    """Export as delimited text with doubled quotes; the reader uses the same escape."""
    (
        df.write.mode(mode)
        .option("header", True)
        .option("sep", sep)
        .option("quote", '"')
        .option("escape", '"')
        .option("quoteAll", quote_all)
        .option("emptyValue", "")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def write_per_source(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """One folder per source file, in one job; later reads prune by source."""
    df.write.mode(mode).partitionBy(SOURCE_FILE).parquet(path)


def filled_counts(df: DataFrame, parts: Sequence[str]) -> DataFrame:
    """Row count, and non-empty cells of the columns whose name holds a part."""
    names = [c for c in df.columns if any(p in c for p in parts)]
    totals = [F.count(F.lit(1)).alias("rows")]
    for i, name in enumerate(names):
        totals.append(F.count_if(ident(name).isNotNull() & (ident(name).cast("string") != "")).alias(f"n{i}"))
    entries = [F.struct(F.lit(n).alias("column"), F.col(f"n{i}").alias("filled")) for i, n in enumerate(names)]
    empty = F.array().cast("array<struct<column:string,filled:bigint>>")
    return df.agg(*totals).select("rows", F.explode_outer(F.array(*entries) if entries else empty).alias("e")).select(
        "rows", "e.column", "e.filled"
    )


def read_back(spark: SparkSession, path: str, parts: Sequence[str], sep: str = ",") -> tuple[list[str], DataFrame]:
    """Columns of an exported table and the filled counts found when reading it."""
    df = missing_cells_to_null(
        spark.read.option("header", True).option("sep", sep).option("escape", '"').option("multiLine", True).csv(path)
    )
    return df.columns, filled_counts(df, parts)


def write_settings(spark: SparkSession, path: str, model_name: str, settings: Mapping, mode: str = "overwrite") -> bool:
    """Best hyper-parameters with model name and time, as one JSON row."""
    if not settings:
        return False
    row = spark.range(1).select(
        F.lit(model_name).alias("model_name"),
        F.lit(json.dumps(dict(settings), ensure_ascii=False, default=str)).alias("hyperparameters"),
        F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss").alias("timestamp"),
    )
    row.coalesce(1).write.mode(mode).json(path)
    return True
