"""Composite keys, key lists and match reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabmill.functions.text import composite_key
from tabmill.operators.lookup import sized_join
from tabmill.runtime import ident, sized


def with_key(df: DataFrame, parts: Sequence[str], name: str) -> DataFrame:
    return df.withColumn(name, composite_key([ident(p) for p in parts]))


def distinct_keys(df: DataFrame, name: str) -> DataFrame:
    return df.select(ident(name)).distinct()


def keep_listed(df: DataFrame, keys: DataFrame, name: str) -> DataFrame:
    """Every row, repeats too, whose key is in the first column of `keys`."""
    listed = keys.select(ident(keys.columns[0]).alias(name)).where(ident(name).isNotNull()).distinct()
    return sized_join(df, sized(listed), [name], "left_semi")


def frequency(df: DataFrame, name: str) -> DataFrame:
    return df.groupBy(ident(name)).agg(F.count(F.lit(1)).alias("n"))


def repeated(df: DataFrame, name: str) -> DataFrame:
    return frequency(df, name).where("n > 1")


def top_repeated(df: DataFrame, name: str, n: int = 10) -> DataFrame:
    """The n most repeated keys, ties in key order (top-k, no full sort)."""
    return repeated(df, name).orderBy(F.desc("n"), ident(name)).limit(n)


def key_summary(df: DataFrame, name: str, groups: Sequence[str] = ()) -> DataFrame:
    """Rows, distinct keys and surplus rows, over the table or per group.

    Keys are counted before the distinct count, so a hot key costs one row.
    """
    per_key = df.groupBy(*[ident(g) for g in groups], ident(name)).agg(F.count(F.lit(1)).alias("n"))
    out = per_key.groupBy(*[ident(g) for g in groups]).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.count(ident(name)).alias("distinct_keys")
    )
    return out.withColumn("duplicates", F.col("rows") - F.col("distinct_keys"))


def more_repeated(df: DataFrame, name: str, shown: int = 10) -> DataFrame:
    """Number of repeated keys, and how many of them a top list leaves out."""
    return repeated(df, name).agg(F.count(F.lit(1)).alias("repeated_keys")).withColumn(
        "not_shown", F.greatest(F.col("repeated_keys") - shown, F.lit(0))
    )
