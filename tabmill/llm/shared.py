"""Table access, staging and small expressions that several text operators use."""

from __future__ import annotations

import os
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabmill.runtime import staged

# Words are runs of anything but ASCII white space. In Python, bytes.split() cuts at the same marks.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"

_ROOT = str(Path(__file__).resolve().parents[2])

__all__ = ["SPACE", "WORD", "crc_of_text", "for_workers", "staged", "table", "text_of", "texts_of"]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def text_of(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def crc_of_text(column: str = "text") -> Column:
    """Unsigned CRC-32 of the UTF-8 bytes; a null text counts as empty."""
    return F.crc32(F.encode(text_of(column), "UTF-8"))


def texts_of(column: pa.Array) -> Iterator[bytes]:
    """UTF-8 bytes of each text; a null text is empty."""
    for value in column.cast(pa.large_binary()):
        yield value.as_py() or b""


def for_workers(df: DataFrame) -> DataFrame:
    """`df`, after the folder of this package went on the import path of Python workers.

    That serves sessions started elsewhere on machines that share the folder;
    a cluster whose executors don't needs the package in --py-files.
    """
    environment = df.sparkSession.sparkContext.environment
    paths = [x for x in environment.get("PYTHONPATH", "").split(os.pathsep) if x]
    if _ROOT not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([_ROOT, *paths])
    return df
