"""Dict-like and list-like text columns to plain columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabmill.functions.nested import (
    dict_is_blank,
    dict_map,
    dict_text,
    find_urls,
    json_map,
    list_count,
    list_first,
    parse_list,
)
from tabmill.runtime import ident

# More keys than this are not columns; the job stops with an error instead of cutting.
MAX_KEYS = 2000


def with_map(df: DataFrame, name: str) -> DataFrame:
    """Add `_map`, step by step, so that each text is trimmed and parsed once."""
    text = df.withColumn("_text", dict_text(ident(name)))
    parsed = text.withColumn("_json", json_map(F.col("_text")))
    return parsed.withColumn("_map", dict_map(F.col("_text"), F.col("_json"))).drop("_text", "_json")


def dict_keys(df: DataFrame, name: str, max_keys: int = MAX_KEYS) -> list[str]:
    """Sorted union of the keys over the whole table; too many are an error."""
    keys = with_map(df.select(ident(name)), name).select(F.explode(F.map_keys("_map")).alias("k")).distinct()
    found = [r["k"] for r in keys.limit(max_keys + 1).collect()]
    if len(found) > max_keys:
        raise ValueError(f"column {name!r} holds more than {max_keys} different keys")
    return sorted(found)


def expand_dict(df: DataFrame, name: str, keys: list[str] | None = None, max_keys: int = MAX_KEYS) -> DataFrame:
    """One text column `{name}_{key}` per key; a key that is missing gives null."""
    if name not in df.columns:
        return df
    keys = dict_keys(df, name, max_keys) if keys is None else keys
    clash = [k for k in keys if f"{name}_{k}" in df.columns]
    if clash:
        raise ValueError(f"expanded columns exist already: {clash}")
    return with_map(df, name).select(
        *[ident(c) for c in df.columns],
        *[F.try_element_at("_map", F.lit(k)).alias(f"{name}_{k}") for k in keys],
    )


def dict_statistics(df: DataFrame, name: str) -> DataFrame:
    """Rows parsed, rows that could not be read, and blank rows."""
    marked = with_map(df.select(ident(name)), name).select(
        dict_is_blank(ident(name)).alias("blank"), F.col("_map").isNotNull().alias("ok")
    )
    return marked.agg(
        F.count_if(F.col("ok")).alias("parsed"),
        F.count_if(~F.col("blank") & ~F.col("ok")).alias("failed"),
        F.count_if(F.col("blank")).alias("blank"),
    )


def dict_failures(df: DataFrame, name: str, n: int = 10) -> DataFrame:
    return with_map(df, name).where(~dict_is_blank(ident(name)) & F.col("_map").isNull()).drop("_map").limit(n)


def expand_list(df: DataFrame, name: str, url_search: bool = False) -> DataFrame:
    """Columns `{name}_count` and `{name}_first`.

    With `url_search`, text that gives no item is searched for web addresses.
    """
    if name not in df.columns:
        return df
    items = parse_list(ident(name))
    listed = df.withColumn("_items", items)
    if url_search:
        found = F.when(F.size("_items") == 0, find_urls(ident(name))).otherwise(F.col("_items"))
        listed = listed.withColumn("_items", found)
    return listed.select(
        *[ident(c) for c in df.columns],
        list_count(F.col("_items")).alias(f"{name}_count"),
        list_first(F.col("_items")).alias(f"{name}_first"),
    )


def list_without_first(df: DataFrame, name: str) -> DataFrame:
    """Rows whose list text is filled but whose first item is empty."""
    raw, first = ident(name), ident(f"{name}_first")
    return df.where(raw.isNotNull() & ~raw.isin("", "[]") & (first.isNull() | (first == "")))
