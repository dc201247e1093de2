"""Shards along a Hilbert curve over quantised metadata.

Each dimension is cut at its quantiles into at most 2^BITS bins. The bins of a
row name a cell, the cell's place on the Hilbert curve gives its order, and the
order is cut into runs of equal rows: shards whose rows lie close together in
all dimensions, so that readers skip most of them by the ranges of any one.

Only DataFrame expressions are used. The curve is walked once for each cell,
not for each row: there are at most 2^(BITS * dimensions) cells, which bounds
what is broadcast. Rows are ranked within a cell in parts of at most about
RANK_ROWS rows, so a cell with most of the rows is shared by many tasks. Texts
are measured where they are read and never shuffled.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabmill.llm.shared import crc_of_text, staged, text_of

BITS = 4
SHARDS = 16
RANK_ROWS = 50_000
ACCURACY = 10_000
DIMENSIONS = ("lang", "source", "n_chars")
_PREFIX = 6  # bytes of a string that its order is taken from, after what all values share


def _text_like(docs: DataFrame, column: str) -> bool:
    return dict(docs.dtypes)[column] in ("string", "binary")


def quantised(docs: DataFrame, dimensions: tuple[str, ...] = DIMENSIONS, bits: int = BITS) -> list[Column]:
    """A bin from 0 to 2^bits - 1 for each dimension, in the order of its values; nulls are in bin 0.

    Two small passes over the dimensions alone: the ends of the strings, to
    skip the bytes that all share, then the quantiles, of which the driver gets
    2^bits - 1 a dimension.
    """
    strings = [c for c in dimensions if _text_like(docs, c)]
    shared = {}
    if strings:
        ends = docs.agg(*[f(F.col(f"`{c}`").cast("string")).alias(f"{end}{i}") for i, c in enumerate(strings) for end, f in (("a", F.min), ("b", F.max))]).first()
        for i, c in enumerate(strings):
            a, b = (ends[f"{e}{i}"] or "" for e in "ab")
            shared[c] = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))

    def number(c: str) -> Column:
        if c not in shared:
            return F.col(f"`{c}`").cast("double")
        rest = F.encode(F.substring(F.col(f"`{c}`").cast("string"), shared[c] + 1, _PREFIX), "UTF-8")
        return F.conv(F.rpad(F.substring(F.hex(rest), 1, 2 * _PREFIX), 2 * _PREFIX, "0"), 16, 10).cast("double")

    n = 1 << bits
    asked = docs.agg(*[F.percentile_approx(number(c), [k / n for k in range(1, n)], ACCURACY).alias(f"q{i}") for i, c in enumerate(dimensions)]).first()
    bins = []
    for i, c in enumerate(dimensions):
        # A value that holds several quantiles has one bin.
        cuts = sorted(set(asked[f"q{i}"] or []))
        above = [F.when(number(c) > cut, 1).otherwise(0) for cut in cuts]
        bins.append(F.coalesce(reduce(lambda a, b: a + b, above, F.lit(0)), F.lit(0)).cast("int"))
    return bins


def hilbert_index(coordinates: list[Column], bits: int = BITS) -> Column:
    """Place on the Hilbert curve of a cell, by Skilling's transposition, as a fold over the bits."""
    d = len(coordinates)
    get = lambda x, i: F.get(x, F.lit(i))
    set_ = lambda x, values: F.array(*[values.get(i, get(x, i)) for i in range(d)])

    def undo(x: Column, q: Column) -> Column:
        p = q - 1
        for i in range(d):
            swap = get(x, 0).bitwiseXOR(get(x, i)).bitwiseAND(p)
            turned = set_(x, {0: get(x, 0).bitwiseXOR(p)})
            swapped = set_(x, {0: get(x, 0).bitwiseXOR(swap), i: get(x, i).bitwiseXOR(swap)}) if i else x
            x = F.when(get(x, i).bitwiseAND(q) != 0, turned).otherwise(swapped)
            x = F.transform(F.array(x), lambda y: y)[0]
        return x

    steps = F.array(*[F.lit(1 << b) for b in range(bits - 1, 0, -1)]) if bits > 1 else F.array().cast("array<int>")
    x = F.aggregate(steps, F.array(*[c.cast("int") for c in coordinates]), undo)

    def gray(x: Column) -> Column:
        values = [get(x, 0)]
        for i in range(1, d):
            values.append(get(x, i).bitwiseXOR(values[-1]))
        last = values[-1]
        flip = F.aggregate(steps, F.lit(0), lambda t, q: F.when(last.bitwiseAND(q) != 0, t.bitwiseXOR(q - 1)).otherwise(t))
        out = F.lit(0).cast("long")
        for b in range(bits - 1, -1, -1):
            for v in values:
                bit = F.call_function("shiftright", v.bitwiseXOR(flip), F.lit(b)).bitwiseAND(F.lit(1))
                out = out * 2 + bit
        return out

    return F.transform(F.array(x), gray)[0]


def placed(docs: DataFrame, dimensions: tuple[str, ...] = DIMENSIONS, shards: int = SHARDS, bits: int = BITS, rank_rows: int = RANK_ROWS) -> DataFrame:
    """(row, doc_id, size, text_crc32, hilbert, shard, slot): the place of each row of `docs`, and `row` its number.

    `row` is the row's place in `docs`, which must be a table at rest if it is
    to be joined back.
    """
    bins = quantised(docs, dimensions, bits)
    cell = reduce(lambda a, b: a * (1 << bits) + b, bins, F.lit(0).cast("long"))
    rows = staged(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text_of()) + 1).cast("long").alias("size"), crc_of_text().alias("text_crc32"),
        cell.alias("cell"), F.monotonically_increasing_id().alias("row")), "cells")

    # From here on at most 2^(bits * dimensions) rows, and parts of a cell.
    mask = (1 << bits) - 1
    coordinates = [F.call_function("shiftright", F.col("cell"), F.lit(bits * (len(dimensions) - 1 - i))).bitwiseAND(F.lit(mask)) for i in range(len(dimensions))]
    cells = rows.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).withColumn("hilbert", hilbert_index(coordinates, bits))
    upto = Window.orderBy("hilbert").rowsBetween(Window.unboundedPreceding, -1)
    cells = staged(cells.withColumns({"before": F.coalesce(F.sum("n").over(upto), F.lit(0)), "total": F.sum("n").over(Window.partitionBy()), "parts": F.ceil(F.col("n") / rank_rows).cast("long")}), "curve")

    part = F.pmod(F.xxhash64("row"), F.col("parts"))
    dealt = rows.join(F.broadcast(cells.drop("n")), "cell").withColumn("part", part)
    sizes = dealt.groupBy("cell", "part").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("cell").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("cell", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("start"))
    rank = F.row_number().over(Window.partitionBy("cell", "part").orderBy("text_crc32", "size", "doc_id", "row")) - 1
    ranked = dealt.withColumn("rank", rank).join(starts, ["cell", "part"])
    position = F.col("before") + F.col("start") + F.col("rank")
    cut = ranked.withColumn("position", position).withColumn("shard", F.expr(f"(position * {shards}) div total").cast("int"))
    slot = F.col("position") - F.expr(f"(shard * total + {shards - 1}) div {shards}")
    return cut.select("row", "doc_id", "size", "text_crc32", "hilbert", "shard", slot.cast("long").alias("slot"))


def sharded(docs: DataFrame, dimensions: tuple[str, ...] = DIMENSIONS, shards: int = SHARDS, bits: int = BITS, rank_rows: int = RANK_ROWS) -> DataFrame:
    """One row for each row of `docs` (doc_id, text and the dimensions): its shard and place in it.

    Law: rows. The number of rows of any two shards differs by one at most.
    Columns: doc_id, size, text_crc32, law, shard, slot, grown_shard (null),
    hilbert (place of the cell on the curve).

    Cases: a null text has size 1 and the sum of the empty text; null
    dimensions are in the first bin; within a part of a cell equal texts stand
    together; repeated rows get a slot each; fewer rows than shards leave shards
    empty; an empty table gives no rows; further columns are ignored.
    """
    return placed(docs, dimensions, shards, bits, rank_rows).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "hilbert")


def write_shards(docs: DataFrame, path: str, dimensions: tuple[str, ...] = DIMENSIONS, shards: int = SHARDS, files: int = 1, bits: int = BITS) -> None:
    """All columns of `docs`, a table at rest, as Parquet under path/shard=N, each file a run of the curve.

    `files` is the number of files a shard is cut into. The texts are shuffled
    once, to where they are written. A column named shard is left out.
    """
    row, slot = (next(n for n in (f"{'_' * k}{name}" for k in range(1, 99)) if n not in docs.columns) for name in ("row", "slot"))
    where = placed(docs, dimensions, shards, bits).select(F.col("row").alias(row), "shard", F.col("slot").alias(slot))
    rows = docs.drop("shard").withColumn(row, F.monotonically_increasing_id()).join(where, row).drop(row)
    cut = rows.repartitionByRange(max(1, shards * files), "shard", slot).sortWithinPartitions("shard", slot)
    cut.drop(slot).write.partitionBy("shard").parquet(path)


def zone_map(written: DataFrame, dimensions: tuple[str, ...] = DIMENSIONS) -> DataFrame:
    """(shard, rows, least and most of each dimension): what a reader needs to skip shards."""
    ends = [f(F.col(f"`{c}`")).alias(f"{c}_{end}") for c in dimensions for end, f in (("least", F.min), ("most", F.max))]
    return written.groupBy("shard").agg(F.count(F.lit(1)).alias("rows"), *ends)
