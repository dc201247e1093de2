"""Regression metrics as aggregates: one pass, no per-row results on the driver."""

from __future__ import annotations

from collections.abc import Sequence
from math import inf

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabmill.functions.text import range_label
from tabmill.runtime import ident

# Bounds of the price ranges, lower bound inclusive.
PRICE_RANGES = (0, 500000, 1000000, 2000000, 5000000, inf)

MIN_RANGE_ROWS = 5


def r2_of(y: Column, p: Column) -> Column:
    spread = F.count(y - p) * F.var_pop(y)
    return 1 - F.try_divide(F.sum((y - p) * (y - p)), F.nullif(spread, F.lit(0.0)))


def error_columns(y: Column, p: Column) -> list[Column]:
    squared = F.avg((y - p) * (y - p))
    return [
        F.count(F.lit(1)).alias("rows"),
        squared.alias("mse"),
        F.sqrt(squared).alias("rmse"),
        F.avg(F.abs(y - p)).alias("mae"),
        r2_of(y, p).alias("r2"),
        mape_of(y, p).alias("mape"),
    ]


def mape_of(y: Column, p: Column) -> Column:
    return F.avg(F.abs(y - p) / F.greatest(y, F.lit(1.0))) * 100


def regression_metrics(df: DataFrame, actual: str, predicted: str, by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*[ident(b) for b in by]).agg(*error_columns(ident(actual), ident(predicted)))


def log_metrics(df: DataFrame, label: str, prediction: str, by: Sequence[str] = ()) -> DataFrame:
    y, p = ident(label), ident(prediction)
    return df.groupBy(*[ident(b) for b in by]).agg(
        F.avg((y - p) * (y - p)).alias("mse_log"), F.avg(F.abs(y - p)).alias("mae_log")
    )


def gaps(metrics: DataFrame, split: str, train: str = "train", test: str = "test") -> DataFrame:
    """Train minus test of each metric, from one metrics row per split."""
    of = lambda part, m: F.max(F.when(ident(split) == part, ident(m)))
    return metrics.agg(
        *[(of(train, m) - of(test, m)).alias(f"{m}_gap") for m in ("r2", "mae", "rmse", "mape")]
    )


def range_index(y: Column, bounds: Sequence[float]) -> Column:
    """Number of the range that holds the value; null outside all ranges."""
    out = None
    for i, (low, high) in enumerate(zip(bounds, bounds[1:])):
        inside = y >= F.lit(float(low)) if high == inf else (y >= F.lit(float(low))) & (y < F.lit(float(high)))
        out = F.when(inside, i) if out is None else out.when(inside, i)
    return out


def range_r2(df: DataFrame, actual: str, predicted: str, bounds: Sequence[float] = PRICE_RANGES) -> DataFrame:
    """R², rows and share of rows per range; empty ranges are listed too.

    R² needs more than five rows and two different values. All ranges come
    from one aggregate with a single result row.
    """
    place, parts, entries = range_index(ident(actual), bounds), [F.count(F.lit(1)).alias("total")], []
    for i, (low, high) in enumerate(zip(bounds, bounds[1:])):
        y, p = F.when(place == i, ident(actual)), F.when(place == i, ident(predicted))
        parts += [F.count(y).alias(f"n{i}"), (F.min(y) < F.max(y)).alias(f"varies{i}"), r2_of(y, p).alias(f"r2_{i}")]
        n = F.col(f"n{i}")
        entries.append(
            F.struct(
                F.lit(i).alias("range_id"),
                F.lit(range_label(low, high)).alias("price_range"),
                F.when((n > MIN_RANGE_ROWS) & F.col(f"varies{i}"), F.col(f"r2_{i}")).alias("r2"),
                n.alias("samples"),
                F.try_divide(n, F.col("total")).alias("weight"),
            )
        )
    return df.agg(*parts).select(F.explode(F.array(*entries)).alias("e")).select("e.*")


def weighted_r2(ranges: DataFrame) -> DataFrame:
    return ranges.agg(F.coalesce(F.sum(F.col("r2") * F.col("weight")), F.lit(0.0)).alias("weighted_r2"))


def overfit_level(gap: Column) -> Column:
    return (
        F.when(gap > 0.15, "strong").when(gap > 0.08, "moderate").when(gap > 0.03, "slight").otherwise("minimal")
    )


def overfit_advice(level: Column) -> Column:
    return (
        F.when(level == "strong", "Regularise more and use a simpler model")
        .when(level == "moderate", "Add regularisation and cross-validate")
        .when(level == "slight", "Acceptable; fine tuning may help")
        .otherwise("Generalises well")
    )


def overfit_report(metrics: DataFrame) -> DataFrame:
    """Level and advice from train_r2 and test_r2 of each metrics row."""
    gap = F.col("train_r2") - F.col("test_r2")
    return metrics.withColumn("r2_gap", gap).withColumn("level", overfit_level(F.col("r2_gap"))).withColumn(
        "advice", overfit_advice(F.col("level"))
    )


def error_histogram(df: DataFrame, actual: str, predicted: str, bins: int = 50) -> DataFrame:
    """Counts of the errors p - y in equal-width bins; empty bins are listed too."""
    errors = df.select((ident(predicted) - ident(actual)).alias("error"))
    low, high = errors.agg(F.min("error"), F.max("error")).first()
    every = df.sparkSession.range(1, bins + 1).select(F.col("id").cast("int").alias("bin"))
    if low is None:
        return every.select("bin", *[F.lit(None).cast("double").alias(c) for c in ("lower", "upper")], F.lit(0).cast("bigint").alias("n"))
    if low == high:
        low, high = low - 0.5, high + 0.5
    width = (high - low) / bins
    place = F.least(F.floor((F.col("error") - F.lit(low)) / F.lit(width)) + 1, F.lit(bins)).cast("int")
    counts = errors.where("error IS NOT NULL").groupBy(place.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    return every.join(F.broadcast(counts), "bin", "left").select(
        "bin",
        (F.lit(low) + (F.col("bin") - 1) * F.lit(width)).alias("lower"),
        (F.lit(low) + F.col("bin") * F.lit(width)).alias("upper"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def rmse_share(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    y, p = ident(actual), ident(predicted)
    rmse = F.sqrt(F.avg((y - p) * (y - p)))
    return df.agg((F.try_divide(rmse, F.avg(y)) * 100).alias("rmse_percent"))


def summary_table(metrics: DataFrame) -> DataFrame:
    """Metrics as display text; what is missing reads N/A."""
    def show(name: str, digits: int, suffix: str = "") -> Column:
        if name not in metrics.columns:
            return F.lit("N/A").alias(name)
        text = F.concat(F.format_number(F.col(name), digits), F.lit(suffix))
        return F.coalesce(text, F.lit("N/A")).alias(name)

    return metrics.select(
        "model",
        show("train_r2", 4),
        show("test_r2", 4),
        show("r2_gap", 4),
        show("test_rmse", 0),
        show("test_mae", 0),
        show("test_mape", 2, "%"),
        show("weighted_r2", 4),
    )


def best_model(metrics: DataFrame, by: str = "test_rmse") -> DataFrame:
    return metrics.where(ident(by).isNotNull()).agg(
        F.min_by("model", F.struct(ident(by), F.col("model"))).alias("model"), F.min(ident(by)).alias(by)
    )
