"""Registered queries over the shared tables, each beside its plain SQL form."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabmill.runtime import checkpoint_dir

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """New folder in the shared work area for a query that writes files."""
    return f"{checkpoint_dir(spark)}/exports/{name}-{uuid.uuid4().hex[:12]}"


def without(c: Column | str, key: str, every: int, at: int = 0) -> Column:
    """The column with nulls put in by a rule: the tables themselves have none."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(F.col(key) % every != at, c)


def rounded(*names: str, digits: int = 6) -> list[Column]:
    return [F.round(F.col(n).cast("double"), digits).alias(n) for n in names]
