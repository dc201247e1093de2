"""Exact quantiles and modes that hold for groups of any size.

`percentile` keeps every distinct value of a group in one buffer. It is used
only where the number of distinct values is known to be small. For the rest
the wanted ranks are enclosed by quantile sketches, pass by pass, until few
distinct values are left between the bounds; the counts are exact all along,
so the result is exact too.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Mapping, Sequence
from itertools import accumulate
from math import floor, isnan

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tabmill.operators.lookup import ROWS, sized_join
from tabmill.runtime import ident, sized, staged

# Most distinct values, over all columns, that one aggregation task may hold.
DISTINCT_LIMIT = 2_000_000
# The same for tables that don't fit one such task at all: partial sets of all tasks meet in the one.
TASK_VALUES = 50_000
# Columns of one aggregate: one over very many isn't compiled, and takes longer than all parts of it.
COLUMNS_AT_ONCE = 12
# Ranges that counted values are dealt to, so that each holds few of the wanted ranks.
RANGES = 128
_GRID = [i / 128 for i in range(129)]
_ACCURACY = 4000
_MAX_ROUNDS = 12


def quantiles(
    df: DataFrame,
    probs: Mapping[str, Sequence[float]],
    distinct_limit: int = DISTINCT_LIMIT,
) -> dict[str, list[float | None]]:
    """Exact linear quantiles of several columns over the whole table.

    A small table takes one pass. Otherwise passes over a dozen columns measure them;
    those with few distinct values take one more pass together, the values of
    the others are counted and ranked by ranges. Nulls are skipped.
    """
    names = list(probs)
    if not names:
        return {}
    rows = df.count()
    limit = distinct_limit
    if rows * len(names) <= distinct_limit:
        distinct = dict.fromkeys(names, rows)
    else:
        limit = min(distinct_limit, TASK_VALUES)
        seen = []
        for at in range(0, len(names), COLUMNS_AT_ONCE):
            seen += df.agg(*[F.approx_count_distinct(ident(n)).alias(n) for n in names[at : at + COLUMNS_AT_ONCE]]).first()
        distinct = {n: seen[i] for i, n in enumerate(names)}
    out: dict[str, list[float | None]] = {}
    for batch in _batches([n for n in names if distinct[n] <= limit], distinct, limit):
        row = df.agg(*[_percentiles(ident(n), probs[n]).alias(f"p{i}") for i, n in enumerate(batch)]).first()
        out.update({n: list(row[i]) if row[i] is not None else [None] * len(probs[n]) for i, n in enumerate(batch)})
    large = [n for n in names if distinct[n] > limit]
    if large:
        out.update(_ranked(df, {n: probs[n] for n in large}))
    return out


def _ranked(df: DataFrame, probs: Mapping[str, Sequence[float]]) -> dict[str, list[float | None]]:
    """Quantiles of columns with any number of distinct values and any number of wanted ranks.

    Values are counted before the shuffle, then dealt to ranges in their order;
    the wanted ranks are looked up within their ranges. No task holds more than
    a range, and the driver gets a count for each range and two values for each rank.
    """
    counts = _unpivot(df, list(probs), ()).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    # At rest, as the number of a range must stay the same.
    dealt = staged(counts.repartitionByRange(RANGES, "column", "value").withColumn("range", F.spark_partition_id()), "quantile-values")
    ranges: dict[str, list] = {}
    for r in dealt.groupBy("column", "range").agg(F.sum("n").alias("n"), F.min("value").alias("least")).collect():
        ranges.setdefault(r["column"], []).append(((isnan(r["least"]), r["least"]), r["range"], r["n"]))
    wanted: dict[tuple[str, int], set[int]] = {}
    places: dict[tuple[str, int], list] = {}
    for name, found in ranges.items():
        found.sort(key=lambda x: x[0])
        rows = sum(n for *_, n in found)
        first = [0, *accumulate(n for *_, n in found)]
        for j, p in enumerate(probs[name]):
            position = (rows - 1) * float(p)
            rank = floor(position)
            pair = []
            for want in (rank, min(rank + 1, rows - 1)):
                k = bisect_right(first, want) - 1
                at = (name, found[k][1], want - first[k])
                wanted.setdefault(at[:2], set()).add(at[2])
                pair.append(at)
            places[name, j] = [*pair, position - rank]
    if not wanted:
        return {n: [None] * len(ps) for n, ps in probs.items()}
    asked = df.sparkSession.createDataFrame([(*at, sorted(ranks)) for at, ranks in wanted.items()], "column string, range int, ranks array<long>")
    last = F.sum("n").over(Window.partitionBy("column", "range").orderBy("value").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    numbered = dealt.join(F.broadcast(asked), ["column", "range"]).withColumn("last", last)
    hit = F.filter("ranks", lambda r: (r < F.col("last")) & (r >= F.col("last") - F.col("n")))
    value = {}
    for r in numbered.select("column", "range", "value", hit.alias("hit")).where(F.size("hit") > 0).collect():
        value.update({(r["column"], r["range"], rank): r["value"] for rank in r["hit"]})
    out: dict[str, list[float | None]] = {n: [None] * len(ps) for n, ps in probs.items()}
    for (name, j), (low, high, part) in places.items():
        a, b = value[low], value[high]
        out[name][j] = a if a == b else (1 - part) * a + part * b
    return out


def medians(df: DataFrame, names: Sequence[str], distinct_limit: int = DISTINCT_LIMIT) -> dict[str, float | None]:
    found = quantiles(df, {n: [0.5] for n in names}, distinct_limit)
    return {n: found[n][0] for n in names}


def group_medians(
    df: DataFrame, names: Sequence[str], by: Sequence[str], distinct_limit: int = DISTINCT_LIMIT
) -> DataFrame:
    """Exact median of each column per group, with the group's row count.

    A group with too many rows for one buffer is taken out and narrowed down
    instead. There are at most rows / limit such groups.
    """
    keys = [ident(k) for k in by]
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(ROWS))
    hot = sized(counts.where(F.col(ROWS) * len(names) > distinct_limit).select(*keys))
    plain = [F.percentile(ident(n), 0.5).alias(n) for n in names]
    if hot.rows == 0:
        return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(ROWS), *plain)
    calm = sized_join(df, hot, by, "left_anti").groupBy(*keys).agg(F.count(F.lit(1)).alias(ROWS), *plain)
    hot_rows = sized_join(df, hot, by, "left_semi")
    found = _narrowed(_unpivot(hot_rows, names, by), list(by), {n: [0.5] for n in names}, distinct_limit)
    wide = found.groupBy(*keys).agg(
        *[F.max(F.when(F.col("column") == n, F.col("quantile"))).alias(n) for n in names]
    )
    counts = hot_rows.groupBy(*keys).agg(F.count(F.lit(1)).alias(ROWS))
    same = [F.col("a." + k).eqNullSafe(F.col("b." + k)) for k in by]
    merged = counts.alias("a").join(wide.alias("b"), same, "left").select(
        *[F.col("a." + k) for k in by], F.col("a." + ROWS), *[F.col(f"b.`{n}`") for n in names]
    )
    return calm.unionByName(merged)


def _batches(names: Sequence[str], weight: Mapping[str, int], limit: int) -> list[list[str]]:
    out: list[list[str]] = []
    load = 0
    for n in names:
        if not out or load + weight[n] > limit:
            out.append([])
            load = 0
        out[-1].append(n)
        load += weight[n]
    return out


def _percentiles(c: Column, probs: Sequence[float]) -> Column:
    return F.percentile(c.cast("double"), F.array(*[F.lit(float(p)) for p in probs]))


def _unpivot(df: DataFrame, names: Sequence[str], by: Sequence[str]) -> DataFrame:
    cells = F.array(*[F.struct(F.lit(n).alias("column"), ident(n).cast("double").alias("value")) for n in names])
    return (
        df.select(*[ident(k) for k in by], F.explode(cells).alias("_cell"))
        .select(*[ident(k) for k in by], "_cell.column", "_cell.value")
        .where(F.col("value").isNotNull())
    )


def _narrowed(long: DataFrame, by: list[str], probs: Mapping[str, Sequence[float]], limit: int) -> DataFrame:
    """(group, column, slot, quantile) for a long table of group, column, value."""
    keys = [*by, "column"]
    target = [*keys, "slot"]
    slots = F.array(
        *[
            F.struct(F.lit(n).alias("_of"), F.lit(j).alias("slot"), F.lit(float(p)).alias("prob"))
            for n, ps in probs.items()
            for j, p in enumerate(ps)
        ]
    )
    position = (F.col("n") - 1) * F.col("prob")
    bounds = (
        long.groupBy(*keys)
        .agg(F.count("value").alias("n"), F.min("value").alias("lo"), F.max("value").alias("hi"))
        .select("*", F.explode(slots).alias("_s"))
        .where(F.col("_s._of") == F.col("column"))
        .select(*keys, "n", "lo", "hi", "_s.slot", "_s.prob")
        .select(
            *target, "n", "prob", "lo", "hi",
            F.floor(position).alias("rank"),
            F.least(F.floor(position) + 1, F.col("n") - 1).alias("next_rank"),
        )
    )
    state = sized(bounds)
    inside = F.when(F.col("value").between(F.col("lo"), F.col("hi")), F.col("value"))
    for _ in range(_MAX_ROUNDS):
        probed = (
            sized_join(long, state, keys, "inner")
            .groupBy(*target, "n", "prob", "rank", "next_rank", "lo", "hi")
            .agg(
                F.count_if(F.col("value") < F.col("lo")).alias("below"),
                F.count(inside).alias("within"),
                F.approx_count_distinct(inside).alias("distinct"),
                F.percentile_approx(inside, _GRID, _ACCURACY).alias("grid"),
            )
        )
        probed = sized(probed).df
        open_targets = F.col("distinct") > limit
        if probed.where(open_targets).limit(1).count() == 0:
            break
        share = lambda r: (F.col(r) - F.col("below")) / F.col("within") * (len(_GRID) - 1)
        low_cell = F.greatest(F.floor(share("rank")) - 1, F.lit(0)).cast("int")
        high_cell = F.least(F.ceil(share("next_rank")) + 2, F.lit(len(_GRID) - 1)).cast("int")
        state = sized(_checked_bounds(long, probed, keys, target, open_targets, low_cell, high_cell))
    return _rank_values(long, probed, keys, target)


def _checked_bounds(long, probed, keys, target, open_targets, low_cell, high_cell) -> DataFrame:
    """Tighter bounds, kept only where exact counts prove that they hold the ranks."""
    tight = probed.select(
        *target, "n", "prob", "rank", "next_rank", "lo", "hi",
        F.when(open_targets, F.get("grid", low_cell)).otherwise(F.col("lo")).alias("new_lo"),
        F.when(open_targets, F.get("grid", high_cell)).otherwise(F.col("hi")).alias("new_hi"),
    )
    counted = (
        sized_join(long, sized(tight), keys, "inner")
        .groupBy(*tight.columns)
        .agg(
            F.count_if(F.col("value") < F.col("new_lo")).alias("under"),
            F.count_if(F.col("value") <= F.col("new_hi")).alias("up_to"),
        )
    )
    return counted.select(
        *target, "n", "prob", "rank", "next_rank",
        F.when(F.col("under") <= F.col("rank"), F.col("new_lo")).otherwise(F.col("lo")).alias("lo"),
        F.when(F.col("up_to") > F.col("next_rank"), F.col("new_hi")).otherwise(F.col("hi")).alias("hi"),
    )


def _rank_values(long: DataFrame, probed: DataFrame, keys: list[str], target: list[str]) -> DataFrame:
    state = sized(probed.drop("grid", "distinct", "within"))
    near = (
        sized_join(long, state, keys, "inner")
        .where(F.col("value").between(F.col("lo"), F.col("hi")))
        .groupBy(*target, "n", "prob", "rank", "next_rank", "below", "value")
        .agg(F.count(F.lit(1)).alias("copies"))
    )
    upto = F.sum("copies").over(
        Window.partitionBy(*target).orderBy("value").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    ranked = near.withColumn("last", F.col("below") + upto - 1).withColumn(
        "first", F.col("last") - F.col("copies") + 1
    )
    holds = lambda r: F.col(r).between(F.col("first"), F.col("last"))
    part = (F.col("n") - 1) * F.col("prob") - F.col("rank")
    return (
        ranked.where(holds("rank") | holds("next_rank"))
        .groupBy(*target)
        .agg(
            F.max(F.when(holds("rank"), F.col("value"))).alias("_low"),
            F.max(F.when(holds("next_rank"), F.col("value"))).alias("_high"),
            F.first(part).alias("_part"),
        )
        .select(
            *target,
            F.when(F.col("_low") == F.col("_high"), F.col("_low"))
            .otherwise((1 - F.col("_part")) * F.col("_low") + F.col("_part") * F.col("_high"))
            .alias("quantile"),
        )
    )


def value_counts(df: DataFrame, names: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """(group, column, value, n) of all columns in one shuffle, counted before it.

    Values are text; nulls are left out.
    """
    cells = F.array(*[F.struct(F.lit(n).alias("column"), ident(n).cast("string").alias("value")) for n in names])
    return (
        df.select(*[ident(k) for k in by], F.explode(cells).alias("_cell"))
        .select(*[ident(k) for k in by], "_cell.column", "_cell.value")
        .where(F.col("value").isNotNull())
        .groupBy(*[ident(k) for k in by], "column", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def _number_counts(df: DataFrame, names: Sequence[str], by: Sequence[str]) -> DataFrame:
    long = _unpivot(df, names, by)
    return long.groupBy(*[ident(k) for k in by], "column", "value").agg(F.count(F.lit(1)).alias("n"))


def _most_frequent(pairs: DataFrame, by: Sequence[str]) -> DataFrame:
    """Most frequent value per group and column, the smallest one on a tie."""
    best = F.min(F.struct((-F.col("n")).alias("order"), F.col("value"))).alias("best")
    return pairs.groupBy(*[ident(k) for k in by], "column").agg(best).select(
        *[ident(k) for k in by], "column", F.col("best.value").alias("value")
    )


def modes(df: DataFrame, names: Sequence[str]) -> dict[str, object]:
    """Most frequent value of each column over the table; None for all-null columns."""
    numbers = [f.name for f in df.schema if f.name in set(names) and isinstance(f.dataType, T.NumericType)]
    texts = [n for n in names if n not in numbers]
    out: dict[str, object] = dict.fromkeys(names)
    if texts:
        out.update({r["column"]: r["value"] for r in _most_frequent(value_counts(df, texts), ()).collect()})
    if numbers:
        out.update({r["column"]: r["value"] for r in _most_frequent(_number_counts(df, numbers, ()), ()).collect()})
    return out


def group_modes(df: DataFrame, names: Sequence[str], by: Sequence[str]) -> DataFrame:
    """Most frequent text value of each column per group, with the row count.

    Counting (group, value) pairs first keeps hot groups out of single tasks.
    """
    best = _most_frequent(value_counts(df, names, by), by)
    rows = df.groupBy(*[ident(k) for k in by]).agg(F.count(F.lit(1)).alias(ROWS))
    everything = best.select(*[ident(k) for k in by], "column", "value", F.lit(0).cast("bigint").alias("n")).unionByName(
        rows.select(
            *[ident(k) for k in by],
            F.lit(None).cast("string").alias("column"),
            F.lit(None).cast("string").alias("value"),
            F.col(ROWS).alias("n"),
        )
    )
    return everything.groupBy(*[ident(k) for k in by]).agg(
        F.sum("n").alias(ROWS),
        *[F.max(F.when(F.col("column") == n, F.col("value"))).alias(n) for n in names],
    )
