"""Grid and random search by cross-validation on the log-scale squared error."""

from __future__ import annotations

import random
from collections.abc import Mapping, Sequence
from itertools import product
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, Pipeline
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.param import Param
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel

from tabmill.plans.models import LABEL, PREDICTION, TreeSpec

Grid = Mapping[str, Sequence]

# Search grids; no depth means unlimited.
FOREST_GRID: Grid = {"trees": [100, 200], "depth": [10, 20, None], "min_split": [2, 5], "min_rows": [1, 2]}
BOOSTING_GRID: Grid = {"rounds": [100, 200], "rate": [0.05, 0.1], "depth": [3, 5], "min_split": [2, 5]}

# Grids of the random searches and their number of draws.
RANDOM_GRIDS: dict[str, tuple[Grid, int]] = {
    "Leaf-wise Boosting": ({"rounds": [100, 200, 300], "rate": [0.05, 0.1, 0.15], "leaves": [31, 63, 127], "depth": [8, 10, 12]}, 10),
    "Symmetric Boosting": ({"rounds": [200, 300, 400], "rate": [0.05, 0.1, 0.15], "depth": [6, 8, 10], "l2": [1, 3, 5]}, 8),
    "Histogram Boosting": ({"rounds": [200, 300, 400], "rate": [0.05, 0.1, 0.15], "depth": [8, 10, 12], "min_rows": [10, 20, 30]}, 8),
    "Random Forest": ({"trees": [100, 150, 200], "depth": [10, 15, 20], "min_split": [15, 20, 25], "share": [0.4, 0.5, 0.6]}, 8),
}

SMALL_GRIDS: dict[str, Grid] = {"Random Forest": FOREST_GRID, "Gradient Boosting": BOOSTING_GRID}


def combinations(grid: Grid) -> list[dict]:
    return [dict(zip(grid, values)) for values in product(*grid.values())]


def drawn(grid: Grid, n: int, seed: int = 42) -> list[dict]:
    """n different combinations, or all of them when there are fewer."""
    every = combinations(grid)
    return random.Random(seed).sample(every, min(n, len(every)))


def _param_maps(estimator: Estimator, settings: Sequence[Mapping]) -> list[dict[Param, object]]:
    return [{estimator.getParam(k): v for k, v in s.items()} for s in settings]


def cross_validator(
    pipeline: Pipeline, settings: Sequence[Mapping], folds: int, parallelism: int = 2, seed: int = 42
) -> CrossValidator:
    estimator = pipeline.getStages()[-1]
    return CrossValidator(
        estimator=pipeline,
        estimatorParamMaps=_param_maps(estimator, settings),
        evaluator=RegressionEvaluator(labelCol=LABEL, predictionCol=PREDICTION, metricName="mse"),
        numFolds=folds,
        parallelism=parallelism,
        seed=seed,
    )


def best_settings(model: CrossValidatorModel, settings: Sequence[Mapping]) -> tuple[dict, float]:
    """Setting with the smallest mean error over the folds, and that error."""
    return _least(model.avgMetrics, settings)


def _least(scores: Sequence[float], settings: Sequence[Mapping]) -> tuple[dict, float]:
    i = min(range(len(scores)), key=scores.__getitem__)
    return dict(settings[i]), scores[i]


def tree_search(data, spec: TreeSpec, settings: Sequence[Mapping], folds: int, parallelism: int = 1) -> tuple[dict, float]:
    """The same for a tree model: folds are by hash of the row key, and every fit reads the one binned store.

    `parallelism` fits run side by side. One that fails ends the search with its error.
    """
    store = data.store()

    def error(case: tuple[Mapping, int]) -> float:
        chosen, fold = spec.with_settings(case[0]), (case[1], folds)
        return chosen.fit(data, fold=fold, **chosen.settings).fold_error(store, fold)

    with store.held(), ThreadPool(max(1, parallelism)) as pool:
        errors = pool.map(inheritable_thread_target(data.train.sparkSession)(error), [(s, i) for s in settings for i in range(folds)], 1)
    return _least([sum(errors[k * folds : (k + 1) * folds]) / folds for k in range(len(settings))], settings)
