"""Repeatable train/test splits that do not depend on partitioning: by hash bucket, or of exact size."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from tabmill.operators.binning import coded, fit_quantile_edges
from tabmill.runtime import ident

SPLIT = "split"
TRAIN, TEST = "train", "test"
_BUCKETS = 100


def bucket(keys: Sequence[Column], seed: int = 42) -> Column:
    """0..99 from a digest of the key; equal in every run and engine."""
    text = F.concat_ws("|", *[F.coalesce(k.cast("string"), F.lit("nan")) for k in keys], F.lit(str(seed)))
    head = F.substring(F.md5(text), 1, 8)
    return F.pmod(F.conv(head, 16, 10).cast("bigint"), F.lit(_BUCKETS)).cast("int")


def random_split(df: DataFrame, keys: Sequence[str], test_share: float = 0.2, seed: int = 42) -> DataFrame:
    is_test = bucket([ident(k) for k in keys], seed) < int(round(test_share * _BUCKETS))
    return df.withColumn(SPLIT, F.when(is_test, TEST).otherwise(TRAIN))


def stratified_split(
    df: DataFrame, keys: Sequence[str], target: str, strata: int = 4, test_share: float = 0.2, seed: int = 42
) -> DataFrame:
    """The same share of every target quantile; `stratum` is the quantile number."""
    edges = fit_quantile_edges(df, [target], strata)[target]
    marked = df.withColumn("stratum", coded(df, target, edges))
    drawn = bucket([*[ident(k) for k in keys], F.coalesce(F.col("stratum"), F.lit(-1))], seed)
    is_test = drawn < int(round(test_share * _BUCKETS))
    return marked.withColumn(SPLIT, F.when(is_test, TEST).otherwise(TRAIN))


_DIGIT = 12  # bits of the hash that one counting pass narrows down
_HASH = 60


def key_hash(keys: Sequence[Column], seed: int = 42) -> Column:
    """0 to 2^60 - 1 from a digest of the key; equal in every run and engine."""
    text = F.concat_ws("|", *[F.coalesce(k.cast("string"), F.lit("nan")) for k in keys], F.lit(str(seed)))
    return F.conv(F.substring(F.md5(text), 1, _HASH // 4), 16, 10).cast("bigint")


def part_sizes(rows: Mapping, test_share: float) -> dict:
    """Rows of each stratum that go to the test part: `share` of all rows, rounded up, dealt by the largest remainders.

    Equal remainders are dealt in the order of the strata.
    """
    total = sum(rows.values())
    wanted = min(total, ceil(round(test_share * total, 9)))
    exact = {s: n * wanted / total if total else 0.0 for s, n in rows.items()}
    out = {s: int(x) for s, x in exact.items()}
    order = sorted(rows, key=lambda s: (out[s] - exact[s], s is None, s or 0))
    for s in order[: wanted - sum(out.values())]:
        out[s] += 1
    return out


def _limits(hashed: DataFrame, wanted: Mapping) -> dict:
    """The hash of the k-th smallest row of each stratum, from counts by digit: five passes, no sort.

    The driver gets 4096 counts for each stratum and pass.
    """
    state = {s: (0, k) for s, k in wanted.items() if k > 0}
    for shift in range(_HASH - _DIGIT, -1, -_DIGIT):
        if not state:
            break
        inside = F.lit(False)
        for s, (prefix, _) in state.items():
            inside = inside | (F.col("stratum").eqNullSafe(F.lit(s)) & (F.shiftright("_h", shift + _DIGIT) == prefix))
        digit = F.shiftright("_h", shift).bitwiseAND(F.lit((1 << _DIGIT) - 1))
        counts: dict = {}
        for r in hashed.where(inside).groupBy("stratum", digit.alias("digit")).agg(F.count(F.lit(1)).alias("n")).collect():
            counts.setdefault(r["stratum"], {})[r["digit"]] = r["n"]
        for s, (prefix, k) in list(state.items()):
            for d in sorted(counts[s]):
                if k <= counts[s][d]:
                    state[s] = (prefix << _DIGIT | d, k)
                    break
                k -= counts[s][d]
    return {s: prefix for s, (prefix, _) in state.items()}


def _cut(marked: DataFrame, keys: Sequence[str], test_share: float, seed: int) -> DataFrame:
    hashed = marked.withColumn("_h", key_hash([ident(k) for k in keys], seed))
    slim = hashed.select("stratum", "_h").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        rows = {r["stratum"]: r["n"] for r in slim.groupBy("stratum").agg(F.count(F.lit(1)).alias("n")).collect()}
        limits = _limits(slim, part_sizes(rows, test_share))
    finally:
        slim.unpersist()
    is_test = F.lit(False)
    for s, limit in limits.items():
        is_test = is_test | (F.col("stratum").eqNullSafe(F.lit(s)) & (F.col("_h") <= limit))
    return hashed.withColumn(SPLIT, F.when(is_test, TEST).otherwise(TRAIN)).drop("_h")


def exact_split(df: DataFrame, keys: Sequence[str], test_share: float = 0.2, seed: int = 42) -> DataFrame:
    """The rows of the smallest key hashes are the test part, `share` of all rows rounded up.

    Rows of one key stay together: where keys repeat, the part may be larger by
    the copies of its last key.
    """
    name = next(n for n in (f"stratum{'_' * k}" for k in range(99)) if n not in df.columns)
    held = df.withColumnRenamed("stratum", name) if "stratum" in df.columns else df
    out = _cut(held.withColumn("stratum", F.lit(0)), keys, test_share, seed).drop("stratum")
    return out.withColumnRenamed(name, "stratum") if "stratum" in df.columns else out


def exact_stratified_split(
    df: DataFrame, keys: Sequence[str], target: str, strata: int = 4, test_share: float = 0.2, seed: int = 42
) -> DataFrame:
    """The same in every target quantile; `stratum` is the quantile number, rows without a target are one stratum."""
    edges = fit_quantile_edges(df, [target], strata)[target]
    return _cut(df.withColumn("stratum", coded(df, target, edges)), keys, test_share, seed)


def parts(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    return df.where(F.col(SPLIT) == TRAIN).drop(SPLIT), df.where(F.col(SPLIT) == TEST).drop(SPLIT)
