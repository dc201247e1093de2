"""Column selection, schema guards and small row operators."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabmill.functions.text import blank_to_empty, is_number, to_number
from tabmill.runtime import ident


def first_column(df: DataFrame) -> DataFrame:
    return df.select(ident(df.columns[0]))


def present(df: DataFrame, names: Iterable[str]) -> list[str]:
    have = set(df.columns)
    return [n for n in names if n in have]


def drop_present(df: DataFrame, names: Iterable[str]) -> DataFrame:
    return df.drop(*present(df, names))


def by_prefix(df: DataFrame, prefixes: Sequence[str]) -> list[str]:
    return [c for c in df.columns if c.startswith(tuple(prefixes))]


def by_part(df: DataFrame, parts: Sequence[str]) -> list[str]:
    return [c for c in df.columns if any(p in c for p in parts)]


def is_numeric_type(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, T.NumericType)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]


def replaced(df: DataFrame, values: dict[str, Column]) -> DataFrame:
    """One projection that replaces or adds all given columns."""
    return df.withColumns(values) if values else df


def infer_numeric(df: DataFrame, names: Sequence[str]) -> list[str]:
    """Text columns whose every non-null value is a number; one pass for all."""
    texts = [n for n in names if not is_numeric_type(df, n)]
    if not texts:
        return list(names)
    bad = df.agg(*[F.count_if(~is_number(ident(n))).alias(f"n{i}") for i, n in enumerate(texts)]).first()
    other = {n for i, n in enumerate(texts) if bad[i] > 0}
    return [n for n in names if n not in other]


def numeric_report(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Per column: is it numeric, and its largest number; one pass for all."""
    totals = []
    for i, n in enumerate(names):
        totals += [
            F.count_if(~is_number(ident(n))).alias(f"bad{i}"),
            F.max(to_number(ident(n))).alias(f"max{i}"),
        ]
    entries = [
        F.struct(
            F.lit(n).alias("column_name"),
            (F.col(f"bad{i}") == 0).cast("int").alias("is_numeric"),
            F.when(F.col(f"bad{i}") == 0, F.col(f"max{i}")).alias("max_value"),
        )
        for i, n in enumerate(names)
    ]
    return df.agg(*totals).select(F.explode(F.array(*entries)).alias("e")).select("e.*")


def blanks_to_empty(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return replaced(df, {n: blank_to_empty(ident(n)) for n in present(df, names)})


def keep_not_null(df: DataFrame, names: Sequence[str]) -> DataFrame:
    found = present(df, names)
    return df.dropna(subset=found) if found else df


def first_rows(df: DataFrame, n: int, order: Sequence[Column | str]) -> DataFrame:
    """First n rows in a stated order (top-k, no full sort)."""
    return df.orderBy(*order).limit(n)


def split_target(df: DataFrame, target: str) -> tuple[list[str], str]:
    """Feature names and the target name; a missing target is an error."""
    if target not in df.columns:
        raise ValueError(f"target column {target!r} is not in the table")
    return [c for c in df.columns if c != target], target
