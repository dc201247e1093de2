"""Binned store: features as bytes, written once and read by every tree model.

A numeric feature has at most 254 bins between edges (`x <= edge` is left of
it), a category a bin for each of its 253 most frequent values, in their order,
and one for all others. The last bin of a feature is that of missing values, so nulls need no
median. A row of the store is a block of rows of the table: labels, key hashes
and the bins of each feature one after the other, as bytes.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabmill.operators.quantiles import quantiles
from tabmill.runtime import ident, staged, with_package

BINS = 254  # of values; one more is that of missing ones
BLOCK_ROWS = 16384
# A column with no more values than this (by sketch) has an edge between any two of them.
FEW_VALUES = 200


@dataclass(frozen=True)
class Feature:
    """Edges of a numeric feature, or the values of a categorical one by their bin."""

    name: str
    edges: tuple[float, ...] = ()
    values: tuple[str, ...] | None = None

    @property
    def size(self) -> int:
        """Number of bins, that of missing values included."""
        return (len(self.edges) + 1 if self.values is None else len(self.values) + 1) + 1

    @property
    def missing(self) -> int:
        return self.size - 1

    def bins(self, column: pa.Array) -> np.ndarray:
        if self.values is None:
            x = column.to_numpy(zero_copy_only=False).astype(np.float64)
            return np.where(np.isnan(x), self.missing, np.searchsorted(np.array(self.edges), x, side="left")).astype(np.uint8)
        number = {v: i for i, v in enumerate(self.values)}
        other = len(self.values)
        return np.array([self.missing if v is None else number.get(v, other) for v in column.to_pylist()], np.uint8)

    def bin_column(self) -> Column:
        """The bin as an expression, for scoring without Python."""
        c = ident(self.name)
        if self.values is None:
            x = F.nanvl(c.cast("double"), F.lit(None).cast("double"))
            edges = F.array(*map(F.lit, self.edges)) if self.edges else F.array().cast("array<double>")
            return F.when(x.isNull(), self.missing).otherwise(F.size(F.filter(edges, lambda e: e < x)))
        known = F.array(*map(F.lit, self.values)) if self.values else F.array().cast("array<string>")
        at = F.array_position(known, c.cast("string"))
        return F.when(c.isNull(), self.missing).when(at > 0, at - 1).otherwise(len(self.values)).cast("int")


@dataclass(frozen=True)
class Bins:
    features: tuple[Feature, ...]

    @property
    def sizes(self) -> list[int]:
        return [f.size for f in self.features]

    @property
    def names(self) -> list[str]:
        return [f.name for f in self.features]

    def columns(self) -> list[Column]:
        """Features as they are binned: doubles and texts."""
        return [(ident(f.name).cast("double") if f.values is None else ident(f.name).cast("string")).alias(f"x{i}") for i, f in enumerate(self.features)]

    def matrix(self, columns: Sequence[pa.Array]) -> np.ndarray:
        """Feature x row."""
        return np.stack([f.bins(c) for f, c in zip(self.features, columns)]) if self.features else np.empty((0, 0), np.uint8)

    def to_json(self) -> str:
        return json.dumps([[f.name, list(f.edges), None if f.values is None else list(f.values)] for f in self.features])

    @staticmethod
    def from_json(text: str) -> Bins:
        return Bins(tuple(Feature(n, tuple(e), None if v is None else tuple(v)) for n, e, v in json.loads(text)))


def fit_bins(df: DataFrame, numeric: Sequence[str], categories: Sequence[str] = (), bins: int = BINS) -> Bins:
    """Edges from exact quantiles, or from all values of a column that has few; the most frequent categories by name.

    The driver gets `bins` numbers or values for each feature at most.
    """
    found: dict[str, Feature] = {}
    if numeric:
        x = {n: F.nanvl(ident(n).cast("double"), F.lit(None).cast("double")) for n in numeric}
        guess = df.agg(*[F.approx_count_distinct(x[n]).alias(f"n{i}") for i, n in enumerate(numeric)]).first()
        few = [n for i, n in enumerate(numeric) if guess[f"n{i}"] <= min(FEW_VALUES, bins)]
        sets = df.agg(*[F.array_sort(F.collect_set(x[n])).alias(f"v{i}") for i, n in enumerate(few)]).first() if few else []
        for n, values in zip(few, sets):
            if len(values) <= bins:
                found[n] = Feature(n, tuple((a + b) / 2 for a, b in zip(values, values[1:])))
        many = [n for n in numeric if n not in found]
        cuts = quantiles(df.select(*[x[n].alias(n) for n in many]), {n: [i / bins for i in range(1, bins)] for n in many}) if many else {}
        for n in many:
            found[n] = Feature(n, tuple(sorted({c for c in cuts[n] if c is not None})))
    for n in categories:
        counts = df.where(ident(n).isNotNull()).groupBy(ident(n).cast("string").alias("value")).agg(F.count(F.lit(1)).alias("n"))
        top = counts.orderBy(F.desc("n"), "value").limit(bins - 1).collect()
        found[n] = Feature(n, (), tuple(sorted(r["value"] for r in top)))
    return Bins(tuple(found[n] for n in [*numeric, *categories]))


STORE = "split string, rows int, label binary, hash binary, bins binary"


def _blocks(spec: Bins):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[tuple[np.ndarray, np.ndarray, np.ndarray]]] = {}

        def flush(split: str, least: int) -> Iterator[pa.RecordBatch]:
            parts = held.get(split, [])
            if sum(len(p[0]) for p in parts) < max(1, least):
                return
            label, hashes, matrix = (np.concatenate([p[i] for p in parts], axis=-1) for i in range(3))
            held[split] = []
            for at in range(0, len(label), BLOCK_ROWS):
                cut = slice(at, at + BLOCK_ROWS)
                cells = [split], [len(label[cut])], [label[cut].tobytes()], [hashes[cut].tobytes()], [np.ascontiguousarray(matrix[:, cut]).tobytes()]
                yield pa.record_batch([pa.array(c, t) for c, t in zip(cells, (pa.string(), pa.int32(), pa.binary(), pa.binary(), pa.binary()))], names=["split", "rows", "label", "hash", "bins"])

        for batch in batches:
            if not batch.num_rows:
                continue
            split = batch.column(0).to_numpy(zero_copy_only=False)
            label = batch.column(1).to_numpy(zero_copy_only=False).astype("<f8")
            hashes = batch.column(2).to_numpy(zero_copy_only=False).astype("<i8")
            matrix = spec.matrix(batch.columns[3:])
            for name in sorted(set(split.tolist())):
                mine = split == name
                held.setdefault(name, []).append((label[mine], hashes[mine], matrix[:, mine]))
                yield from flush(name, BLOCK_ROWS)
        for name in sorted(held):
            yield from flush(name, 1)

    return run


def binned(df: DataFrame, spec: Bins, label: str, keys: Sequence[str], split: Column, folder: str | None = None) -> DataFrame:
    """The store of a table: rows without a label go; `split` names the part of a row, `keys` give its hash."""
    rows = df.where(ident(label).isNotNull()).select(split.cast("string").alias("split"), ident(label).cast("double").alias("label"), F.xxhash64(*[ident(k) for k in keys]).alias("hash"), *spec.columns())
    return staged(with_package(rows).mapInArrow(_blocks(spec), STORE), "binned", folder)


def opened(row: dict, features: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(label, hash, bins) of a block; bins are feature x row."""
    return np.frombuffer(row["label"], "<f8"), np.frombuffer(row["hash"], "<i8").view(np.uint64), np.frombuffer(row["bins"], np.uint8).reshape(features, row["rows"])


def ordered_statistics(df: DataFrame, category: str, label: str, keys: Sequence[str], prior: float, weight: float = 1.0, seed: int = 42, name: str | None = None) -> DataFrame:
    """`df` with a number for a category: the mean label of the rows of the same category that come before in hash order.

    No row sees its own label or that of a row behind it. Each category's rows
    are summed by 4096 ranges of the hash first, so a window holds one range of
    one category. Ties in the hash stand in the order of the label.
    """
    name = name or f"{category}_stat"
    key = F.xxhash64(*[ident(k) for k in keys], F.lit(seed))
    marked = df.withColumns({"_cat": ident(category).cast("string"), "_y": ident(label).cast("double"), "_h": key, "_r": F.shiftright(key, 52)})
    sums = marked.groupBy("_cat", "_r").agg(F.sum("_y").alias("_s"), F.count("_y").alias("_n"))
    upto = Window.partitionBy("_cat").orderBy("_r").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(F.col("_cat").alias("_c"), F.col("_r").alias("_q"), F.sum("_s").over(upto).alias("_s0"), F.sum("_n").over(upto).alias("_n0"))
    within = Window.partitionBy("_cat", "_r").orderBy("_h", "_y").rowsBetween(Window.unboundedPreceding, -1)
    inner = marked.withColumns({"_s1": F.sum("_y").over(within), "_n1": F.count("_y").over(within)})
    joined = inner.join(sums, F.col("_cat").eqNullSafe(F.col("_c")) & (F.col("_r") == F.col("_q")))
    total = lambda a, b: F.coalesce(F.col(a), F.lit(0.0)) + F.coalesce(F.col(b), F.lit(0.0))
    return joined.select(*[ident(c) for c in df.columns], ((total("_s0", "_s1") + prior * weight) / (total("_n0", "_n1") + weight)).alias(name))


def category_table(train: DataFrame, category: str, label: str, prior: float, weight: float = 1.0) -> DataFrame:
    """(value, stat): the same number from all rows of `train`, for rows that aren't trained on."""
    sums = train.groupBy(ident(category).cast("string").alias("value")).agg(F.sum(ident(label).cast("double")).alias("s"), F.count(ident(label)).alias("n"))
    return sums.select("value", ((F.coalesce("s", F.lit(0.0)) + prior * weight) / (F.col("n") + weight)).alias("stat"))


def with_category(df: DataFrame, category: str, table: DataFrame, prior: float, name: str | None = None) -> DataFrame:
    """`df` with the number of its category; an unseen one has the prior."""
    found = df.join(table.select(F.col("value").alias("_c"), F.col("stat").alias("_s")), ident(category).cast("string").eqNullSafe(F.col("_c")), "left")
    return found.select(*[ident(c) for c in df.columns], F.coalesce("_s", F.lit(prior)).alias(name or f"{category}_stat"))
