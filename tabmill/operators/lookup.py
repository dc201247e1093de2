"""Left lookup of a measured table, safe for large tables and hot keys."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabmill.runtime import SizedTable, ident

ROWS = "_rows"
# A key with more than this share of the rows is hot: at most 1 / share such keys exist.
HOT_SHARE = 0.001


def lookup(df: DataFrame, table: SizedTable, keys: Sequence[str], broadcast_bytes: int | None = None) -> DataFrame:
    """Add the columns of `table` to each row by equal keys; null keys find nothing.

    A table under the measured limit is broadcast. A larger one is split by its
    row counts (`_rows`): the few hot keys are broadcast, the others are
    joined by a shuffle in which hot and null rows are spread over all tasks.
    """
    values = [c for c in table.df.columns if c not in keys and c != ROWS]
    small = table.small if broadcast_bytes is None else table.size <= broadcast_bytes
    side = table.df.dropna(subset=list(keys))
    if small:
        return df.join(F.broadcast(side.drop(ROWS)), list(keys), "left").select(
            *[ident(c) for c in df.columns], *[ident(v) for v in values]
        )
    total = table.df.agg(F.sum(ROWS)).first()[0]
    is_hot = F.col(ROWS) > F.lit(max(1.0, total * HOT_SHARE))

    hot = side.where(is_hot).select(
        *[ident(k).alias(f"_hot_{i}") for i, k in enumerate(keys)],
        F.lit(True).alias("_hot"),
        *[ident(v).alias(f"_hot_{v}") for v in values],
    )
    cold = side.where(~is_hot).select(
        *[ident(k).alias(f"_cold_{i}") for i, k in enumerate(keys)],
        F.lit(0).alias("_cold_salt"),
        *[ident(v).alias(f"_cold_{v}") for v in values],
    )
    on_hot = reduce(lambda a, b: a & b, [ident(k) == F.col(f"_hot_{i}") for i, k in enumerate(keys)])
    marked = df.join(F.broadcast(hot), on_hot, "left")
    away = F.col("_hot").isNotNull()
    for k in keys:
        away = away | ident(k).isNull()
    # Each input partition sends its hot and null rows elsewhere, and to the same
    # place again when a lost task is repeated.
    spread = F.spark_partition_id() + 1
    marked = marked.withColumn("_salt", F.when(away, spread).otherwise(F.lit(0)))
    on_cold = reduce(
        lambda a, b: a & b,
        [ident(k) == F.col(f"_cold_{i}") for i, k in enumerate(keys)],
        F.col("_salt") == F.col("_cold_salt"),
    )
    joined = marked.join(cold, on_cold, "left")
    return joined.select(
        *[ident(c) for c in df.columns],
        *[F.coalesce(ident(f"_hot_{v}"), ident(f"_cold_{v}")).alias(v) for v in values],
    )


def sized_join(df: DataFrame, table: SizedTable, keys: Sequence[str], how: str) -> DataFrame:
    """Inner, semi or anti join by name, in which null equals null.

    The table is broadcast only when measured small; otherwise adaptive
    execution splits skewed partitions of the shuffle join.
    """
    side = table.df.select(
        *[ident(k).alias(f"_key_{i}") for i, k in enumerate(keys)],
        *[ident(c) for c in table.df.columns if c not in keys],
    )
    side = F.broadcast(side) if table.small else side
    same = [ident(k).eqNullSafe(F.col(f"_key_{i}")) for i, k in enumerate(keys)]
    joined = df.join(side, same, how)
    return joined.drop(*[f"_key_{i}" for i in range(len(keys))])
