"""Keep-first de-duplication and duplicate counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabmill.runtime import ident


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str] | None = None) -> DataFrame:
    """One row per key: the first by `order`; nulls are one key.

    An aggregate, not a window: copies of a hot key meet already on the map
    side. Ties in the order are settled by the other columns.
    """
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    first = [c for c in (order or []) if c not in keys]
    rank = first + [c for c in rest if c not in first]
    best = F.min(F.struct(*[ident(c) for c in rank])).alias("_best")
    picked = df.groupBy(*[ident(k) for k in keys]).agg(best)
    return picked.select(
        *[ident(c) if c in keys else F.col("_best").getField(c).alias(c) for c in df.columns]
    )


def distinct_features(df: DataFrame, features: Sequence[str], order: Sequence[str] | None = None) -> DataFrame:
    """One row per feature vector whatever the label; the first label stays."""
    return keep_first(df, features, order)


def duplicate_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows, distinct rows and surplus rows; rows with nulls count like others."""
    per_row = df.groupBy(*[ident(c) for c in columns]).agg(F.count(F.lit(1)).alias("n"))
    return per_row.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.count(F.lit(1)).alias("distinct_rows")
    ).withColumn("duplicates", F.col("rows") - F.col("distinct_rows"))


def not_in(df: DataFrame, other: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows whose values in `columns` do not occur in `other`; null equals null.

    The other side is reduced to its distinct vectors and joined on one hash,
    with the columns themselves compared for the rows that meet.
    """
    hashed = F.xxhash64(*[ident(c) for c in columns])
    seen = other.select(*[ident(c) for c in columns]).distinct().withColumn("_hash", hashed)
    left = df.withColumn("_hash", hashed).alias("l")
    right = seen.alias("r")
    same = F.col("l._hash") == F.col("r._hash")
    for c in columns:
        same = same & F.col(f"l.`{c}`").eqNullSafe(F.col(f"r.`{c}`"))
    return left.join(right, same, "left_anti").drop("_hash")

