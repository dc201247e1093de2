"""Null filling by constants, other columns, and table or group statistics."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabmill.operators import quantiles as Q
from tabmill.operators.columns import is_numeric_type, present, replaced
from tabmill.operators.lookup import ROWS, lookup
from tabmill.runtime import ident, sized

UNKNOWN = "Unknown"


def presence_flag(df: DataFrame, name: str, flag: str) -> DataFrame:
    return df.withColumn(flag, ident(name).isNotNull().cast("int"))


def _lit_like(df: DataFrame, name: str, value) -> Column:
    return F.lit(value).cast(df.schema[name].dataType)


def fill_values(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Fill nulls of each column with its value; entries of None change nothing."""
    found = {n: v for n, v in values.items() if n in df.columns and v is not None}
    return replaced(df, {n: F.coalesce(ident(n), _lit_like(df, n, v)) for n, v in found.items()})


def fill_mode(df: DataFrame, names: Sequence[str], fallback: object = UNKNOWN) -> DataFrame:
    """Most frequent value of the table, or the fallback for an all-null column."""
    names = present(df, names)
    found = Q.modes(df, names) if names else {}
    return fill_values(df, {n: fallback if v is None else v for n, v in found.items()})


def _filled_from_groups(df: DataFrame, table, names: Sequence[str], by: Sequence[str]) -> DataFrame:
    renamed = table.df.select(
        *[ident(k) for k in by], ident(ROWS), *[ident(n).alias(f"_fill_{i}") for i, n in enumerate(names)]
    )
    table.df = renamed
    joined = lookup(df, table, by)
    filled = {n: F.coalesce(ident(n), F.col(f"_fill_{i}").cast(df.schema[n].dataType)) for i, n in enumerate(names)}
    return joined.select(*[filled[c].alias(c) if c in filled else ident(c) for c in df.columns])


def fill_group_mode(df: DataFrame, names: Sequence[str], by: Sequence[str], fallback: str = UNKNOWN) -> DataFrame:
    """Most frequent value of the group; the fallback where the group has none."""
    filled = _filled_from_groups(df, sized(Q.group_modes(df, names, by)), names, by)
    return fill_values(filled, dict.fromkeys(names, fallback))


def _fill_group_number(df: DataFrame, table: DataFrame, names: Sequence[str], by: Sequence[str]) -> DataFrame:
    measured = sized(table)
    no_key = [ident(k).isNull() for k in by]
    gaps = measured.df.agg(
        *[F.max((ident(n).isNull() | _any(no_key)).cast("int")).alias(f"g{i}") for i, n in enumerate(names)]
    ).first()
    filled = _filled_from_groups(df, measured, names, by)
    # The table-wide median counts the values already filled by group.
    open_names = [n for i, n in enumerate(names) if gaps[i]]
    return fill_values(filled, Q.medians(filled, open_names))


def _any(conditions: Sequence[Column]) -> Column:
    out = conditions[0]
    for c in conditions[1:]:
        out = out | c
    return out


def fill_group_median(df: DataFrame, names: Sequence[str], by: Sequence[str]) -> DataFrame:
    """Median of the group, then the median of the column as filled so far."""
    return _fill_group_number(df, Q.group_medians(df, names, by), names, by)


def fill_group_mean(df: DataFrame, names: Sequence[str], by: Sequence[str]) -> DataFrame:
    """Mean of the group, then the median of the column as filled so far."""
    means = df.groupBy(*[ident(k) for k in by]).agg(
        F.count(F.lit(1)).alias(ROWS), *[F.avg(ident(n)).alias(n) for n in names]
    )
    return _fill_group_number(df, means, names, by)


def fill_typed(df: DataFrame, names: Sequence[str], by: Sequence[str]) -> DataFrame:
    """Group median for numbers and group mode for text, all columns at once.

    Without the group columns the table's median or mode is used.
    """
    names = present(df, names)
    numbers = [n for n in names if is_numeric_type(df, n)]
    texts = [n for n in names if n not in numbers]
    grouped = all(k in df.columns for k in by)
    if numbers:
        df = fill_group_median(df, numbers, by) if grouped else fill_values(df, Q.medians(df, numbers))
    if texts:
        df = fill_group_mode(df, texts, by) if grouped else fill_mode(df, texts)
    return df


def fill_from(df: DataFrame, names: Sequence[str], other: str) -> DataFrame:
    """Fill from another column of the row; rows stay out where there is none to fill from."""
    names = present(df, names)
    if other not in df.columns:
        return df.dropna(subset=names) if names else df
    return replaced(df, {n: F.coalesce(ident(n), ident(other).cast(df.schema[n].dataType)) for n in names})


def fill_prices(df: DataFrame, price: str, low: str, high: str, others: Sequence[str]) -> DataFrame:
    """Low and high from the price (0.9 and 1.1 of it), zero for counters and differences.

    Without the price column each gap takes its column's median.
    """
    names = present(df, [low, high, *others])
    if price not in df.columns:
        return fill_values(df, Q.medians(df, names))
    rules = {n: F.lit(0.0) for n in present(df, others)}
    if low in names:
        rules[low] = ident(price) * 0.9
    if high in names:
        rules[high] = ident(price) * 1.1
    return replaced(df, {n: F.coalesce(ident(n), c.cast(df.schema[n].dataType)) for n, c in rules.items()})


def fit_fill(df: DataFrame, names: Sequence[str], text_fallback: str = UNKNOWN) -> dict[str, object]:
    """Fill value per column: median for numbers, mode or the fallback for text."""
    names = present(df, names)
    numbers = [n for n in names if is_numeric_type(df, n)]
    texts = [n for n in names if n not in numbers]
    values: dict[str, object] = dict(Q.medians(df, numbers)) if numbers else {}
    if texts:
        values.update({n: text_fallback if v is None else v for n, v in Q.modes(df, texts).items()})
    return values


def fill_fitted(df: DataFrame, names: Sequence[str], text_fallback: str = UNKNOWN) -> DataFrame:
    return fill_values(df, fit_fill(df, names, text_fallback))
