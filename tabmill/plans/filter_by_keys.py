"""Keep the rows of a folder of files whose composite key is listed."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabmill.operators import keys as K
from tabmill.plans.config import LISTINGS
from tabmill.sources.delimited import SOURCE_FILE, scan_folder
from tabmill.sources.sinks import write_per_source
from tabmill.runtime import ident, staged


def key_list(df: DataFrame, parts: Sequence[str] = LISTINGS.key_parts, key: str = LISTINGS.key) -> DataFrame:
    """Distinct composite keys of a seller table."""
    return K.distinct_keys(K.with_key(df, parts, key), key)


@dataclass
class FilterResult:
    rows: DataFrame
    files: DataFrame
    key: str = LISTINGS.key

    def per_file(self) -> DataFrame:
        """Matched, distinct and surplus rows per source file, with the file's status."""
        found = K.key_summary(self.rows, self.key, [SOURCE_FILE])
        return self.files.join(F.broadcast(found), SOURCE_FILE, "left").select(
            SOURCE_FILE, "status", "missing",
            *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in ("rows", "distinct_keys", "duplicates")],
        )

    def totals(self) -> DataFrame:
        return K.key_summary(self.rows, self.key)

    def most_repeated(self, n: int = 10) -> DataFrame:
        return K.top_repeated(self.rows, self.key, n)

    def found_keys(self) -> DataFrame:
        return self.rows.select(ident(self.key))


def filter_by_keys(
    spark: SparkSession,
    folder: str,
    keys: DataFrame,
    parts: Sequence[str] = LISTINGS.key_parts,
    key: str = LISTINGS.key,
    sep: str = "|",
    annotated_path: str | None = None,
    work_folder: str | None = None,
) -> FilterResult:
    """Scan, build keys, keep listed rows with their file names; repeats stay.

    `annotated_path` also stores all rows with their key, one folder per file;
    the text is then parsed once and the match reads the stored columns. The
    kept rows are staged once for the reports.
    """
    scan = scan_folder(spark, folder, parts, sep)
    keyed = K.with_key(scan.rows, parts, key)
    if annotated_path:
        write_per_source(keyed, annotated_path)
        keyed = spark.read.schema(keyed.schema).parquet(annotated_path)
    kept = staged(K.keep_listed(keyed, keys, key), "matched", work_folder)
    return FilterResult(kept, scan.report, key)
