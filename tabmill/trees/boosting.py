"""Gradient boosting over the binned store: best-first trees, and symmetric ones."""

from __future__ import annotations

import json
import threading
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field
from math import floor, log2

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.storagelevel import StorageLevel

from tabmill.runtime import ident, staged, with_package
from tabmill.trees.growth import TRAIN, Fit, Held, Part, Rules, Tree, in_fold, leafwise, symmetric
from tabmill.trees.store import Bins, opened, with_category

PREDICTION = "prediction"
# Trees that a pass evaluates anew; behind each such run the predictions are written to the store.
WRITTEN_EVERY = 10
# Bytes of a batch of blocks between Spark and Python.
BATCH_BYTES = 8 << 20
# Rows of a train part, in bytes while they are fitted, that one task fits a model on.
HELD_BYTES = 32 << 20


@dataclass
class Store:
    """A written binned table and the bins that made it."""

    df: DataFrame
    bins: Bins
    _lock: threading.Lock = field(default_factory=threading.Lock, repr=False, compare=False)
    _holders: int = 0
    _limits: tuple | None = None

    def limits(self, held: DataFrame) -> tuple[int | None, float | None, float | None]:
        """Rows of the train part, and the ends of their labels; found once."""
        with self._lock:
            if self._limits is None:
                found = with_package(held).mapInArrow(_limits, "n long, least double, most double").agg(F.sum("n"), F.min("least"), F.max("most")).first()
                self._limits = tuple(found)
        return self._limits

    def rules(self, categories: Sequence[str] = (), used: Sequence[str] | None = None, **options) -> Rules:
        at = {n: i for i, n in enumerate(self.bins.names)}
        return Rules(tuple(self.bins.sizes), frozenset(at[c] for c in categories), used=None if used is None else tuple(at[n] for n in used), **options)

    def part(self, split: str = TRAIN) -> DataFrame:
        """Blocks of one part, in as many tasks as there are cores: each task sends one histogram for a node.

        A task's rows grow with the table, so a batch between Spark and Python is bounded by its bytes.
        """
        self.df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
        return self.df.where(F.col("split") == split).coalesce(self.df.sparkSession.sparkContext.defaultParallelism)

    @contextmanager
    def held(self) -> Iterator[DataFrame]:
        """The train part in memory, shared by all models that are fitted at the time; the last one lets it go."""
        df = self.part().select("rows", "label", "hash", "bins")
        with self._lock:
            self._holders += 1
            if self._holders == 1:
                df.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            yield df
        finally:
            with self._lock:
                self._holders -= 1
                if not self._holders:
                    df.unpersist()


@dataclass
class Boosted:
    """start plus rate times the trees. Scores tables by their features, or the store by its bins."""

    bins: Bins
    start: float
    rate: float
    trees: list[Tree] = field(default_factory=list)
    errors: list[tuple[float, float | None]] = field(default_factory=list)  # mean squared error before each tree: trained rows, held-out rows

    def values(self, bins: np.ndarray) -> np.ndarray:
        out = np.full(bins.shape[1], self.start)
        for tree in self.trees:
            out += self.rate * tree.predict(bins)
        return out

    def split_features(self) -> set[int]:
        """Features that some tree splits; a table needs no others to be scored."""
        return {f for t in self.trees for f in t.feature[t.child[:, 0] != np.arange(len(t.child))].tolist()}

    def scored(self, store: Store) -> DataFrame:
        """(split, label, prediction) of every row of the store."""
        features, values = len(self.bins.features), self.values

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for row in batch.to_pylist():
                    y, _, bins = opened(row, features)
                    yield pa.record_batch([pa.array([row["split"]] * len(y), pa.string()), pa.array(y), pa.array(values(bins))], names=["split", "label", PREDICTION])

        return with_package(store.df).mapInArrow(run, f"split string, label double, {PREDICTION} double")

    def fold_error(self, store: Store, fold: tuple[int, int], seed: int = 42) -> float:
        """Mean squared error over the train rows of a fold, summed on a grid of 2^-30."""
        features, values = len(self.bins.features), self.values

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for row in batch.to_pylist():
                    y, hashes, bins = opened(row, features)
                    mine = in_fold(hashes, fold, seed)
                    off = y[mine] - values(bins[:, mine])
                    yield pa.record_batch([pa.array([int(np.rint(off * off * (1 << 30)).sum())]), pa.array([int(mine.sum())])], names=["error", "n"])

        total, n = with_package(store.part()).mapInArrow(run, "error long, n long").agg(F.sum(F.col("error").cast("decimal(38,0)")), F.sum("n")).first()
        return float(total) / (1 << 30) / n if n else float("inf")

    def transform(self, df: DataFrame) -> DataFrame:
        """`df` with the prediction; its features are binned on the way, missing and unseen values too."""
        tried = self.split_features()
        inputs = [c if i in tried else F.lit(None).cast("string" if f.values is not None else "double").alias(f"x{i}") for i, (f, c) in enumerate(zip(self.bins.features, self.bins.columns()))]
        given, n = df.columns, len(df.columns)
        model = self

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows:
                    found = model.values(model.bins.matrix(batch.columns[n:]))
                    yield pa.record_batch([*batch.columns[:n], pa.array(found)], names=[*given, PREDICTION])

        wide = df.select(*[ident(c) for c in given], *inputs)
        return with_package(wide).mapInArrow(run, T.StructType([*df.schema.fields, T.StructField(PREDICTION, T.DoubleType())]))

    def expression(self) -> Column:
        """The prediction of a model of symmetric trees as an expression: a leaf is found by the bits of its splits."""
        sizes = self.bins.sizes
        table = []
        for tree in self.trees:
            features, masks, first = [], [], 0
            while tree.child[first, 0] != first:
                f = int(tree.feature[first])
                features.append(f)
                masks.append(tree.left_bins(first)[: sizes[f]].tolist())
                first = 2 * first + 1
            table.append((features, masks, tree.value[first:].tolist()))
        tried = self.split_features()
        row = F.array(*[f.bin_column().cast("int") if i in tried else F.lit(0) for i, f in enumerate(self.bins.features)])
        kind = "array<struct<features:array<int>,masks:array<array<boolean>>,values:array<double>>>"
        trees = F.from_json(F.lit(json.dumps([{"features": a, "masks": b, "values": c} for a, b, c in table])), kind)

        def leaf(tree: Column, bins: Column) -> Column:
            bits = F.aggregate(
                F.arrays_zip(tree["features"], tree["masks"]), F.lit(0),
                lambda at, s: at * 2 + F.get(s["masks"], F.get(bins, s["features"])).cast("int"))
            return F.get(tree["values"], bits)

        # One binned row for all trees.
        return F.transform(F.array(row), lambda bins: F.aggregate(trees, F.lit(self.start), lambda total, t: total + self.rate * leaf(t, bins)))[0]

    def to_json(self) -> str:
        return json.dumps({"bins": self.bins.to_json(), "start": self.start, "rate": self.rate, "trees": [t.to_dict() for t in self.trees]})

    @staticmethod
    def from_json(text: str) -> Boosted:
        d = json.loads(text)
        return Boosted(Bins.from_json(d["bins"]), d["start"], d["rate"], [Tree.from_dict(t) for t in d["trees"]])

    def save(self, spark, path: str) -> None:
        spark.createDataFrame([(self.to_json(),)], "value string").coalesce(1).write.mode("overwrite").text(path)

    @staticmethod
    def load(spark, path: str) -> Boosted:
        return Boosted.from_json(spark.read.text(path, wholetext=True).first()[0].rstrip("\n"))


@dataclass
class CategoryColumn:
    """A column of category numbers: its name, the category it comes from, and (value, stat) of the train part."""

    name: str
    category: str
    prior: float
    table: DataFrame


@dataclass
class EncodedModel:
    """A model over features of which some are numbers that stand for categories."""

    model: Boosted
    columns: list[CategoryColumn]

    def scored(self, store: Store) -> DataFrame:
        return self.model.scored(store)

    def fold_error(self, store: Store, fold: tuple[int, int], seed: int = 42) -> float:
        return self.model.fold_error(store, fold, seed)

    def transform(self, df: DataFrame) -> DataFrame:
        wide = df
        for c in self.columns:
            wide = with_category(wide, c.category, c.table, c.prior, c.name)
        return self.model.transform(wide).select(*[ident(c) for c in df.columns], PREDICTION)

    def save(self, spark, path: str) -> None:
        self.model.save(spark, f"{path}/model")
        spark.createDataFrame([(c.name, c.category, c.prior) for c in self.columns], "name string, category string, prior double").coalesce(1).write.mode("overwrite").json(f"{path}/columns")
        for i, c in enumerate(sorted(self.columns, key=lambda c: c.name)):
            c.table.write.mode("overwrite").parquet(f"{path}/values-{i}")

    @staticmethod
    def load(spark, path: str) -> EncodedModel:
        rows = spark.read.schema("name string, category string, prior double").json(f"{path}/columns").orderBy("name").collect()
        return EncodedModel(Boosted.load(spark, f"{path}/model"), [CategoryColumn(r["name"], r["category"], r["prior"], spark.read.parquet(f"{path}/values-{i}")) for i, r in enumerate(rows)])


def _limits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for data in batch.column("label").to_pylist():
            y = np.frombuffer(data, "<f8")
            if len(y):
                yield pa.record_batch([pa.array([len(y)]), pa.array([y.min()]), pa.array([y.max()])], names=["n", "least", "most"])


def residual_grid(n: int, reach: float) -> float:
    """Steps of the grid for a unit of the label: a power of two that lets the sums of n residuals fit, with room to spare."""
    reach = max(reach, 1e-200) if reach else 1.0
    return 2.0 ** floor(min(37 - log2(reach), 60 - log2(max(n, 1)) - log2(reach)))


def _with_base(fit: Fit):
    features = len(fit.rules.sizes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                base = np.frombuffer(row["base"], "<f8") if row.get("base") is not None else None
                found = fit.predict(opened(row, features)[2], base)
                cells = [row["rows"]], [row["label"]], [row["hash"]], [row["bins"]], [found.astype("<f8").tobytes()]
                yield pa.record_batch([pa.array(c, t) for c, t in zip(cells, (pa.int32(), *[pa.binary()] * 4))], names=["rows", "label", "hash", "bins", "base"])

    return run


Grower = Callable[[Part | Held, Fit, np.ndarray], Tree]


def boosted(
    store: Store, rules: Rules, grow: Grower, rounds: int, rate: float = 0.1, holdout: int = 0, patience: int = 10, tolerance: float = 1e-7,
    fold: tuple[int, int] | None = None, folder: str | None = None, seed: int = 42, held_bytes: int = 0,
) -> Boosted:
    """Squared-error boosting from the mean of the train part.

    With `holdout` (rows of 1000, by hash of the row key) training ends when
    none of the last `patience` trees took more than `tolerance` off the mean
    squared error of the rows held out. With `fold` the rows of that fold are
    held out, and the last of the model's errors is that of all its trees. A
    part without rows gives a model without trees that predicts zero.

    A part of at most `held_bytes` is fitted by one task, a larger one by passes
    over all tasks; the trees are the same, as sums are integers.
    """
    with store.held() as df:
        found = store.limits(df)
        model = Boosted(store.bins, 0.0, rate)
        if not found[0]:
            return model
        n, least, most = found
        fit = Fit(rules, 0.0, rate, residual_grid(n, max(abs(least), abs(most))), holdout=holdout, fold=fold, seed=seed, slots={0: 0})
        if n * (len(rules.sizes) + 56) <= held_bytes:
            made = with_package(df).coalesce(1).mapInArrow(_fitted_here(fit, grow, (n, least, most), rounds, patience, tolerance), "model string").first()
            d = json.loads(made["model"])
            return Boosted(store.bins, d["start"], rate, [Tree.from_dict(t) for t in d["trees"]], [tuple(e) for e in d["errors"]])
        part = _Passes(df, folder)
        try:
            _fit_rounds(model, part, fit, grow, found, rounds, patience, tolerance)
        finally:
            part.close()
        return model


class _Passes(Part):
    """Rows over many tasks; behind every ten trees the predictions are written."""

    def __init__(self, df: DataFrame, folder: str | None) -> None:
        super().__init__(df, df.sparkSession.sparkContext.defaultParallelism)
        self.folder, self.written = folder, None

    def add(self, fit: Fit) -> None:
        if len(fit.trees) < WRITTEN_EVERY:
            return
        fit.growing, fit.slots = None, {}
        table = staged(with_package(self.df).mapInArrow(_with_base(fit), "rows int, label binary, hash binary, bins binary, base binary"), "boosting-base", self.folder)
        self.close()
        self.df = self.written = table.coalesce(self.tasks).persist(StorageLevel.MEMORY_AND_DISK)
        fit.trees = []

    def close(self) -> None:
        if self.written is not None:
            self.written.unpersist()


def _fitted_here(fit: Fit, grow: Grower, limits: tuple[int, float, float], rounds: int, patience: int, tolerance: float):
    features = len(fit.rules.sizes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = [opened(row, features) for batch in batches for row in batch.to_pylist()]
        if blocks:
            model = Boosted(Bins(()), 0.0, fit.rate)
            _fit_rounds(model, Held(*(np.concatenate(x, axis=-1) for x in zip(*blocks))), fit, grow, limits, rounds, patience, tolerance)
            out = json.dumps({"start": model.start, "trees": [t.to_dict() for t in model.trees], "errors": model.errors})
            yield pa.record_batch([pa.array([out], pa.string())], names=["model"])

    return run


def _fit_rounds(model: Boosted, part: _Passes | Held, fit: Fit, grow: Grower, limits: tuple[int, float, float], rounds: int, patience: int, tolerance: float) -> None:
    rows, least, most = limits
    total, n = fit.rules.totals(part.scan(fit)[0][0])
    model.start = fit.start = total / fit.scale / n if n else 0.0
    fit.scale = residual_grid(rows, 2 * max(abs(least - fit.start), abs(most - fit.start)))
    for _ in range(rounds):
        fit.growing, fit.slots = None, {0: 0}
        hists, errors = part.scan(fit)
        model.errors.append(_means(errors))
        if fit.holdout and _stopped([e[1] for e in model.errors], patience, tolerance):
            break
        tree = grow(part, fit, hists[0])
        model.trees.append(tree)
        fit.trees.append(tree)
        part.add(fit)
    if fit.fold is not None:
        fit.growing, fit.slots = None, {}
        model.errors.append(_means(part.scan(fit)[1]))


def _means(errors: tuple[int, int, int, int]) -> tuple[float | None, float | None]:
    return tuple(None if not count else e / (1 << 20) / count for e, count in (errors[:2], errors[2:]))


def _stopped(errors: list[float | None], patience: int, tolerance: float) -> bool:
    known = [e for e in errors if e is not None]
    return len(known) > patience and all(e > known[-patience - 1] - tolerance for e in known[-patience:])


def leafwise_boosting(store: Store, rounds: int = 200, rate: float = 0.1, leaves: int = 63, depth: int | None = 10, min_rows: int = 20, l2: float = 0.0, categories: Sequence[str] = (), used: Sequence[str] | None = None, holdout: int = 0, fold: tuple[int, int] | None = None, folder: str | None = None) -> Boosted:
    """Best-first trees. Categories are split by sets of values, in the order of their mean residual."""
    rules = store.rules(categories, used, min_rows=min_rows, l2=l2)
    return boosted(store, rules, lambda part, fit, root: leafwise(part, fit, leaves, depth, root)[0], rounds, rate, holdout, fold=fold, folder=folder, held_bytes=HELD_BYTES)


def gradient_boosting(store: Store, rounds: int = 100, rate: float = 0.1, depth: int = 3, min_split: int = 2, used: Sequence[str] | None = None, fold: tuple[int, int] | None = None, folder: str | None = None) -> Boosted:
    """Trees of one depth: with room for all leaves, best-first growth splits every node that can be split."""
    rules = store.rules((), used, min_rows=1, min_split=min_split)
    return boosted(store, rules, lambda part, fit, root: leafwise(part, fit, 1 << depth, depth, root)[0], rounds, rate, fold=fold, folder=folder, held_bytes=HELD_BYTES)


# Fixed value: rows from which on a tenth is held out and training may end early.
EARLY_ROWS = 10_000


def histogram_boosting(store: Store, rounds: int = 200, rate: float = 0.1, leaves: int = 31, depth: int | None = 10, min_rows: int = 20, used: Sequence[str] | None = None, early: bool | None = None, fold: tuple[int, int] | None = None, folder: str | None = None) -> Boosted:
    """Best-first trees of 31 leaves; missing values learn their side; early stopping above 10,000 rows unless told otherwise."""
    if early is None:
        early = (store.part().agg(F.sum("rows")).first()[0] or 0) > EARLY_ROWS
    return leafwise_boosting(store, rounds, rate, leaves, depth, min_rows, used=used, holdout=100 if early else 0, fold=fold, folder=folder)


def symmetric_boosting(store: Store, rounds: int = 200, rate: float = 0.1, depth: int = 8, l2: float = 3.0, used: Sequence[str] | None = None, fold: tuple[int, int] | None = None, folder: str | None = None) -> Boosted:
    """One split for each level of a tree; leaves are Newton steps with `l2` added to their rows."""
    rules = store.rules((), used, min_rows=0, l2=l2)
    return boosted(store, rules, lambda part, fit, root: symmetric(part, fit, depth, root), rounds, rate, fold=fold, folder=folder, held_bytes=HELD_BYTES)
