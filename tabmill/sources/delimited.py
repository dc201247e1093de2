"""Delimited-file scans: single files, and folders of files with mixed headers."""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabmill.functions.text import missing_to_null
from tabmill.runtime import ident, with_package

SOURCE_FILE = "source_file"


def text_schema(names: Iterable[str]) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


def _reader(spark: SparkSession, sep: str, multiline: bool):
    return (
        spark.read.option("sep", sep)
        .option("header", True)
        .option("encoding", "UTF-8")
        .option("quote", '"')
        .option("escape", '"')
        .option("mode", "PERMISSIVE")
        .option("multiLine", multiline)
    )


def read_delimited(
    spark: SparkSession,
    path: str | Sequence[str],
    sep: str = ",",
    schema: T.StructType | None = None,
    multiline: bool = False,
) -> DataFrame:
    """Scan delimited text with a header.

    Without a schema every column is text; the missing-value tokens become
    null. `multiline` allows line breaks inside quotes, at the price of one
    task per file.
    """
    reader = _reader(spark, sep, multiline)
    paths = [path] if isinstance(path, str) else list(path)
    if schema is not None:
        return reader.schema(schema).csv(paths)
    return missing_cells_to_null(reader.csv(paths))


def missing_cells_to_null(df: DataFrame) -> DataFrame:
    """Missing-value tokens in text, and NaN in floating columns, become null."""
    out = []
    for name, dtype in df.dtypes:
        c = ident(name)
        if dtype == "string":
            c = missing_to_null(c)
        elif dtype in ("double", "float"):
            c = F.nanvl(c, F.lit(None).cast(dtype))
        out.append(c.alias(name))
    return df.select(out)


def require_columns(df: DataFrame, names: Iterable[str]) -> list[str]:
    """Names that the table lacks; a plan-time check without a job."""
    have = set(df.columns)
    return [name for name in names if name not in have]


@dataclass
class FolderScan:
    """Rows of all usable files, and one report row per file."""

    rows: DataFrame
    report: DataFrame


# Reasons for which a file is left out.
MISSING, UNDECODABLE, TRUNCATED, TOO_WIDE, EMPTY = "missing columns", "undecodable", "truncated", "too many fields", "empty"


def file_headers(spark: SparkSession, folder: str, pattern: str = "*.csv", sep: str = "|") -> DataFrame:
    """(path, header, broken, fields) of each file directly in the folder: its first line, how many lines aren't UTF-8, and the most fields of a line.

    Text is scanned without parsing and reduced to one row per file on the map
    side, so hardly anything is shuffled. A file that breaks off in the middle
    doesn't end the scan.
    """
    lines = spark.read.option("ignoreCorruptFiles", True).text(f"{folder.rstrip('/')}/{pattern}").select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("place"),
        "value",
    )
    first = F.col("start") == 0
    bare = F.regexp_replace("value", '"(?:[^"]|"")*"', "")  # separators inside quotes part no fields
    fields = F.floor((F.octet_length(bare) - F.octet_length(F.replace(bare, F.lit(sep), F.lit("")))) / len(sep.encode())) + 1
    return lines.groupBy("path").agg(
        F.min_by(F.when(first, F.col("value")), F.when(first, F.col("place"))).alias("header"),
        F.count_if(~F.is_valid_utf8("value")).alias("broken"),
        F.max(fields).alias("fields"),
    )


def _whole(data: bytes) -> bool:
    """Whether gzip data can be read to its end, checked piece by piece."""
    at, reader = 0, zlib.decompressobj(31)
    try:
        while at < len(data):
            if reader.eof:  # another member follows
                reader = zlib.decompressobj(31)
            end = min(at + (1 << 20), len(data))
            reader.decompress(data[at:end])
            at = end - len(reader.unused_data)
    except zlib.error:
        return False
    return reader.eof


def _broken_archives(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        bad = [not _whole(x.as_py() or b"") for x in batch.column("content")]
        yield pa.record_batch([batch.column("path").filter(pa.array(bad))], names=["path"])


def broken_archives(spark: SparkSession, folder: str, pattern: str) -> list[str]:
    """Paths of the gzip files of a folder that end early; such files are one task each in any scan."""
    files = spark.read.format("binaryFile").load(f"{folder.rstrip('/')}/{pattern}").where(F.col("path").endswith(".gz"))
    return [r["path"] for r in with_package(files.select("path", "content")).mapInArrow(_broken_archives, "path string").collect()]


def scan_folder(
    spark: SparkSession,
    folder: str,
    required: Sequence[str],
    sep: str = "|",
    same_header: bool = False,
    pattern: str = "*.csv",
    strict: bool = True,
) -> FolderScan:
    """Read every file of a folder, each by its own header, aligned by name.

    Files are grouped by header line and each group is one scan, since a
    single scan of mixed headers would bind columns by position. A file is
    left out as a whole and reported if it lacks a required column, isn't
    UTF-8, is a gzip file that breaks off, has no line, or (`strict`) has a row
    of more fields than its header; the others are read. `same_header` skips
    these passes when all files are known to be sound and to agree.
    """
    glob = f"{folder.rstrip('/')}/{pattern}"
    report, groups, wide = [], {}, set()
    if same_header:
        groups = {tuple(_reader(spark, sep, False).csv(glob).columns): [glob]}
    else:
        cut = set(broken_archives(spark, folder, pattern)) if pattern.endswith(".gz") or pattern.endswith("*") else set()
        seen = set()
        for row in file_headers(spark, folder, pattern, sep).collect():
            seen.add(row["path"])
            fault = TRUNCATED if row["path"] in cut else UNDECODABLE if row["broken"] else EMPTY if row["header"] is None else None
            if fault:
                report.append((row["path"].rsplit("/", 1)[-1], fault, []))
            else:
                header = _split_header(row["header"], sep)
                groups.setdefault(header, []).append(row["path"])
                if strict and row["fields"] > len(header):
                    wide.add(row["path"])
        report += [(p.rsplit("/", 1)[-1], TRUNCATED, []) for p in sorted(cut - seen)]
    scans = []
    for header, paths in sorted(groups.items()):
        missing = [name for name in required if name not in header]
        report += [(p.rsplit("/", 1)[-1], MISSING if missing else TOO_WIDE if p in wide else "read", missing) for p in paths]
        paths = [p for p in paths if p not in wide]
        if missing or not paths:
            continue
        scan = _reader(spark, sep, False).schema(text_schema(header)).csv(paths)
        scans.append(
            missing_cells_to_null(scan.select("*", F.col("_metadata.file_name").alias(SOURCE_FILE)))
        )
    reported = spark.createDataFrame(report, "source_file string, status string, missing array<string>")
    if not scans:
        return FolderScan(spark.createDataFrame([], text_schema([*required, SOURCE_FILE])), reported)
    return FolderScan(union_by_name(scans), reported)


def _split_header(line: str, sep: str) -> tuple[str, ...]:
    names = [name.strip().strip('"') for name in line.lstrip("﻿").split(sep)]
    return tuple(names)


def union_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    """Rows of all frames; a column that a frame lacks is null there."""
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out


def with_source(df: DataFrame, source: str) -> DataFrame:
    return df.withColumn(SOURCE_FILE, F.lit(source))
