"""Split, compare, tune and choose regression models on the log price."""

from __future__ import annotations

import threading
import time
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from math import isfinite

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from tabmill.operators import metrics as M
from tabmill.operators.columns import keep_not_null, numeric_columns, split_target, text_columns
from tabmill.operators.dedup import distinct_features, not_in
from tabmill.operators.encode import apply_labels, fit_labels
from tabmill.operators.impute import fit_fill, fill_values
from tabmill.operators.quantiles import medians
from tabmill.operators.split import SPLIT, TEST, TRAIN, exact_split, exact_stratified_split, parts
from tabmill.plans import tune
from tabmill.plans.models import LABEL, PREDICTION, ModelSpec, TreeSpec, assembled, label_shape
from tabmill.runtime import staged
from tabmill.trees.boosting import Boosted, CategoryColumn, EncodedModel, Store
from tabmill.trees.store import binned, category_table, fit_bins, ordered_statistics, with_category


@dataclass
class TrainingData:
    """Train and test rows; features are numbers (with their medians) and, if kept as they are, categories."""

    train: DataFrame
    test: DataFrame
    features: list[str]
    fill: dict[str, float | None]
    keys: list[str] = field(default_factory=list)
    categories: list[str] = field(default_factory=list)
    folder: str | None = None
    _store: Store | None = None
    _columns: list[CategoryColumn] = field(default_factory=list)

    @property
    def numbers(self) -> list[str]:
        return [f for f in self.features if f not in self.categories]

    @property
    def plain(self) -> list[str]:
        return [*self.numbers, *self.categories]

    @property
    def statistics(self) -> list[str]:
        """Columns of the store that hold a number for each category."""
        return [c.name for c in self._columns]

    def store(self) -> Store:
        """Both parts binned, written once for all models; the edges come from the train part."""
        if self._store is None:
            train, test = self.train, self.test
            prior = train.agg(F.avg(LABEL)).first()[0] or 0.0
            for c in self.categories:
                name = next(n for n in (f"{c}_stat{'_' * k}" for k in range(99)) if n not in self.train.columns)
                table = staged(category_table(self.train, c, LABEL, prior), "category-values", self.folder)
                train = ordered_statistics(train, c, LABEL, self.keys, prior, name=name)
                test = with_category(test, c, table, prior, name)
                self._columns.append(CategoryColumn(name, c, prior, table))
            if self.categories:
                train = staged(train, "train-categories", self.folder)
            spec = fit_bins(train, [*self.numbers, *self.statistics], self.categories)
            both = train.withColumn(SPLIT, F.lit(TRAIN)).unionByName(test.withColumn(SPLIT, F.lit(TEST)))
            self._store = Store(binned(both, spec, LABEL, self.keys, F.col(SPLIT), self.folder), spec)
        return self._store

    def encoded(self, model: Boosted) -> Boosted | EncodedModel:
        """A model over category numbers, with what new rows need to get theirs."""
        return EncodedModel(model, self._columns) if self._columns else model


@dataclass
class Comparison:
    """Metrics of all models, one row each, and the fitted models by name."""

    metrics: DataFrame
    rows: list[dict]
    models: dict[str, object]
    settings: dict[str, dict] = field(default_factory=dict)
    failures: dict[str, str] = field(default_factory=dict)

    @property
    def best(self) -> str:
        return min(self.rows, key=lambda r: r["test_rmse"])["model"]

    def whole(self) -> Comparison:
        """This comparison, if all of its models were trained and tuned; one that failed is an error, not a missing row."""
        if self.failures:
            raise RuntimeError(f"models failed: {self.failures}")
        return self


def prepare(
    df: DataFrame,
    target: str,
    keys: Sequence[str],
    stratified: bool = True,
    deduplicate: bool = True,
    folder: str | None = None,
    seed: int = 42,
    native: bool = False,
) -> TrainingData:
    """Matrix to train and test tables without shared feature rows.

    Rows without a target go; text columns become ordinal numbers; nulls take
    table medians. With `native` texts stay categories and nulls stay nulls,
    which only tree models take. Copies inside each part are dropped, then test rows whose
    features occur in train. The matrix is written once before the passes that
    split it, and the two parts once more; every model rereads these.
    """
    features, target = split_target(df, target)
    features = [f for f in features if f not in keys]
    df = staged(keep_not_null(df, [target]), "matrix", folder)
    categories = [n for n in text_columns(df) if n in features] if native else []
    if not native:
        df = fill_values(df, fit_fill(df, features, "unknown"))
    for name in [n for n in text_columns(df) if n in features and not native]:
        labelled = apply_labels(df, name, fit_labels(df, name))
        df = labelled.drop(name).withColumnRenamed(f"{name}_label", name)
    split = exact_stratified_split(df, keys, target, seed=seed).drop("stratum") if stratified else exact_split(df, keys, seed=seed)
    train, test = parts(split.withColumnRenamed(target, LABEL))
    if deduplicate:
        train = distinct_features(train, features, keys)
        test = distinct_features(test, features, keys)
        train = staged(train, "train", folder)
        test = not_in(test, train, features)
    else:
        train = staged(train, "train", folder)
    test = staged(test, "test", folder)
    numbers = [n for n in numeric_columns(train) if n in features]
    return TrainingData(train, test, [*numbers, *categories], {} if native else medians(train, numbers), list(keys), categories, folder)


def _predicted(model: PipelineModel, data: TrainingData) -> DataFrame:
    both = data.train.withColumn(SPLIT, F.lit(TRAIN)).unionByName(data.test.withColumn(SPLIT, F.lit(TEST)))
    return model.transform(both)


def _evaluated(predictions: DataFrame) -> dict:
    """All metrics of both parts from one pass over the predictions."""
    scored = predictions.select(SPLIT, LABEL, PREDICTION, F.expm1(LABEL).alias("y"), F.expm1(PREDICTION).alias("p"))
    ranged = scored.withColumn("range_id", F.coalesce(M.range_index(F.col("y"), M.PRICE_RANGES), F.lit(-1)))
    y, p = F.col("y"), F.col("p")
    found = (
        ranged.rollup(SPLIT, "range_id")
        .agg(
            *M.error_columns(y, p),
            F.avg(F.pow(F.col(LABEL) - F.col(PREDICTION), 2)).alias("mse_log"),
            F.avg(F.abs(F.col(LABEL) - F.col(PREDICTION))).alias("mae_log"),
            F.min(y).alias("lo"),
            F.max(y).alias("hi"),
        )
        .where(F.col(SPLIT).isNotNull())
        .collect()
    )
    whole = {r[SPLIT]: r for r in found if r["range_id"] is None}
    train, test = whole[TRAIN], whole[TEST]
    if any(r["rmse"] is None or not isfinite(r["rmse"]) for r in (train, test)):
        raise ValueError(f"its errors are no finite numbers: train {train['rmse']}, test {test['rmse']}")
    out = {f"train_{m}": train[m] for m in ("r2", "mae", "rmse", "mape", "mse")}
    out |= {f"test_{m}": test[m] for m in ("r2", "mae", "rmse", "mape", "mse")}
    out |= {"mse_log": test["mse_log"], "mae_log": test["mae_log"]}
    for m in ("r2", "mae", "rmse", "mape"):
        a, b = out[f"train_{m}"], out[f"test_{m}"]
        out[f"{m}_gap"] = None if a is None or b is None else a - b
    weighted = 0.0
    for r in found:
        in_range = r[SPLIT] == TEST and r["range_id"] is not None and r["range_id"] >= 0
        if in_range and r["rows"] > M.MIN_RANGE_ROWS and r["lo"] < r["hi"] and r["r2"] is not None:
            weighted += r["r2"] * r["rows"] / test["rows"]
    out["weighted_r2"] = weighted
    return out


def _fitted(spec: ModelSpec | TreeSpec, data: TrainingData, held: TrainingData, shape) -> tuple[object, dict]:
    if isinstance(spec, TreeSpec):
        model = spec.fit(data, **spec.settings)
        return model, _evaluated(model.scored(data.store()))
    model = assembled(data.fill, data.features, spec.build(shape), spec.scaled).fit(held.train)
    return model, _evaluated(_predicted(model, held))


class _Attempt(threading.Thread):
    """One model's fit and metrics in a thread of its own; its jobs have a tag and a scheduler pool."""

    def __init__(self, spec: ModelSpec | TreeSpec, data: TrainingData, held: TrainingData, shape) -> None:
        super().__init__(daemon=True)
        self.spec, self.arguments, self.tag = spec, (spec, data, held, shape), f"model-{uuid.uuid4().hex}"
        self.context = data.train.sparkSession.sparkContext
        self.begun, self.seconds = time.monotonic(), 0.0
        self.model, self.row, self.error, self.stopped = None, None, None, None

    def run(self) -> None:
        self.context.addJobTag(self.tag)
        self.context.setLocalProperty("spark.scheduler.pool", self.tag)
        try:
            self.model, self.row = _fitted(*self.arguments)
        except Exception as error:  # noqa: BLE001 - a failing model must not end the comparison
            self.error = str(error)
        self.seconds = time.monotonic() - self.begun

    def cancel(self, limit: float) -> None:
        """End its jobs; the thread then ends with their error, or is left behind if it runs none."""
        self.stopped = f"stopped after {limit:g} s"
        self.context.cancelJobsWithTag(self.tag)


def _attempts(specs: Sequence[ModelSpec | TreeSpec], start: Callable[[ModelSpec | TreeSpec], _Attempt], parallelism: int, limit: float | None) -> list[_Attempt]:
    """All specs tried, some at a time, in the order given."""
    waiting, running, done = list(specs), [], {}
    while waiting or running:
        while waiting and len(running) < parallelism:
            running.append(start(waiting.pop(0)))
            running[-1].start()
        for attempt in list(running):
            attempt.join(0.05)
            late = attempt.is_alive() and limit is not None and time.monotonic() - attempt.begun > limit
            if late:
                attempt.cancel(limit)
            if late or not attempt.is_alive():
                running.remove(attempt)
                done[attempt.spec.name] = attempt
    return [done[s.name] for s in specs]


def compare(data: TrainingData, specs: Sequence[ModelSpec | TreeSpec], parallelism: int = 1, limit: float | None = None) -> Comparison:
    """Fit and measure each model on the same cached tables, tree models on the binned store.

    `parallelism` models run side by side, each in a scheduler pool of its own;
    they share the cores evenly where the cluster schedules by FAIR.
    A model that fails, or takes longer than `limit` seconds, is reported and
    passed over, its jobs are cancelled and the others go on; none at all is an
    error. So is one whose errors are no finite numbers. Who needs all models
    asks for the `whole` comparison. Names of the models must differ.
    """
    spark = data.train.sparkSession
    shape = label_shape(data.train)
    held = TrainingData(
        data.train.persist(StorageLevel.MEMORY_AND_DISK), data.test.persist(StorageLevel.MEMORY_AND_DISK),
        data.features, data.fill,
    )
    try:
        if any(isinstance(s, TreeSpec) for s in specs):
            data.store()
        attempts = _attempts(specs, lambda s: _Attempt(s, data, held, shape), parallelism, limit)
    finally:
        held.train.unpersist()
        held.test.unpersist()
    failures = {a.spec.name: a.stopped or a.error for a in attempts if a.stopped or a.error is not None}
    good = [a for a in attempts if a.spec.name not in failures]
    if not good:
        raise ValueError(f"no model could be trained: {failures}")
    rows = [{"model": a.spec.name, **a.row, "seconds": a.seconds} for a in good]
    return Comparison(metrics_table(spark, rows), rows, {a.spec.name: a.model for a in good}, failures=failures)


def metrics_table(spark, rows: Sequence[Mapping]) -> DataFrame:
    names = [n for n in rows[0] if n != "model"]
    schema = "model string, " + ", ".join(f"{n} double" for n in names)
    cells = [(r["model"], *[None if r.get(n) is None else float(r[n]) for n in names]) for r in rows]
    return spark.createDataFrame(cells, schema)


def tune_model(
    data: TrainingData,
    spec: ModelSpec | TreeSpec,
    settings: Sequence[Mapping],
    folds: int,
    parallelism: int = 2,
) -> tuple[object, dict, dict]:
    """Cross-validated search: best model, its settings, and its metrics row."""
    start = time.monotonic()
    if isinstance(spec, TreeSpec):
        chosen, _ = tune.tree_search(data, spec, settings, folds, parallelism)
        model, row = _fitted(spec.with_settings(chosen), data, data, None)
        return model, chosen, {"model": f"{spec.name} (tuned)", **row, "seconds": time.monotonic() - start}
    pipeline = assembled(data.fill, data.features, spec.build(label_shape(data.train)), spec.scaled)
    searched = tune.cross_validator(pipeline, settings, folds, parallelism).fit(data.train)
    chosen, _ = tune.best_settings(searched, settings)
    row = {"model": f"{spec.name} (tuned)", **_evaluated(_predicted(searched.bestModel, data)), "seconds": time.monotonic() - start}
    return searched.bestModel, chosen, row


def compare_and_tune(
    data: TrainingData,
    specs: Sequence[ModelSpec | TreeSpec],
    searches: Mapping[str, Sequence[Mapping]],
    folds: int,
    parallelism: int = 2,
) -> Comparison:
    """Compare, then tune the best model where it has a search; keep both rows.

    If tuning fails the untuned model stays and the failure is reported.
    """
    found = compare(data, specs)
    best = found.best
    if best not in searches:
        return found
    spec = next(s for s in specs if s.name == best)
    try:
        model, chosen, row = tune_model(data, spec, searches[best], folds, parallelism)
    except Exception as error:  # noqa: BLE001
        found.failures[f"{best} (tuned)"] = str(error)
        return found
    rows = [*found.rows, row]
    return Comparison(
        metrics_table(data.train.sparkSession, rows),
        rows,
        {**found.models, row["model"]: model},
        {row["model"]: chosen},
        found.failures,
    )
