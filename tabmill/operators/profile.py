"""Table profiles. Each report is one aggregate over all columns."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabmill.operators.quantiles import value_counts
from tabmill.runtime import ident


def null_profile(df: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    """Per column: nulls, non-nulls and the null ratio."""
    names = list(names or df.columns)
    totals = [F.count(F.lit(1)).alias("rows")] + [F.count(ident(n)).alias(f"n{i}") for i, n in enumerate(names)]
    entries = [
        F.struct(
            F.lit(n).alias("column_name"),
            (F.col("rows") - F.col(f"n{i}")).alias("nulls"),
            F.col(f"n{i}").alias("non_nulls"),
            F.try_divide(F.col("rows") - F.col(f"n{i}"), F.col("rows")).alias("null_ratio"),
        )
        for i, n in enumerate(names)
    ]
    return df.agg(*totals).select(F.explode(F.array(*entries)).alias("e")).select("e.*")


def total_nulls(df: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    return null_profile(df, names).agg(F.sum("nulls").alias("nulls"))


def sparse_columns(df: DataFrame, threshold: float = 0.7, exempt: Iterable[str] = ()) -> list[str]:
    """Columns with a null ratio strictly above the threshold, but for the exempt ones."""
    kept = set(exempt)
    over = null_profile(df).where(F.col("null_ratio") > threshold).collect()
    found = {r["column_name"] for r in over} - kept
    return [c for c in df.columns if c in found]


def drop_sparse(df: DataFrame, threshold: float = 0.7, exempt: Iterable[str] = ()) -> DataFrame:
    return df.drop(*sparse_columns(df, threshold, exempt))


def length_profile(df: DataFrame, name: str) -> DataFrame:
    """Shortest, longest and mean text, and how many texts are an empty list."""
    size = F.length(ident(name))
    return df.agg(
        F.min(size).cast("bigint").alias("min_length"),
        F.max(size).cast("bigint").alias("max_length"),
        F.avg(size).alias("mean_length"),
        F.count_if(ident(name) == "[]").alias("empty_lists"),
    )


def samples(df: DataFrame, name: str, n: int = 10) -> DataFrame:
    return df.select(ident(name)).where(ident(name).isNotNull()).limit(n)


def distinct_counts(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Exact number of different non-null values per column, in one shuffle."""
    every = df.sparkSession.createDataFrame([(n,) for n in names], "column_name string")
    found = value_counts(df, names).groupBy("column").agg(F.count(F.lit(1)).alias("distinct_values"))
    joined = every.join(found, every["column_name"] == found["column"], "left")
    return joined.select("column_name", F.coalesce("distinct_values", F.lit(0)).alias("distinct_values"))


def target_stats(df: DataFrame, name: str) -> DataFrame:
    return df.agg(
        F.min(ident(name)).alias("min_value"), F.max(ident(name)).alias("max_value"), F.avg(ident(name)).alias("mean_value")
    )


def size_report(df: DataFrame, split: str, features: Sequence[str]) -> DataFrame:
    """Rows and columns per split."""
    return df.groupBy(ident(split)).agg(F.count(F.lit(1)).alias("rows")).withColumn(
        "columns", F.lit(len(features)).cast("bigint")
    )


def new_columns(before: DataFrame, after: DataFrame) -> list[str]:
    """Columns that a step has added; plan-time, no job."""
    have = set(before.columns)
    return [c for c in after.columns if c not in have]
