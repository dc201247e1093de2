"""Regression models: linear ones as MLlib pipelines with their saved state, trees over the binned store."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from math import sqrt

from pyspark.ml import Estimator, Pipeline
from pyspark.ml.feature import SQLTransformer, StandardScaler, VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabmill.runtime import ident, quoted
from tabmill.trees.boosting import gradient_boosting, histogram_boosting, leafwise_boosting, symmetric_boosting
from tabmill.trees.forest import random_forest

LABEL, FEATURES, PREDICTION = "label", "features", "prediction"


@dataclass(frozen=True)
class LabelShape:
    """Row count and population deviation of the label: penalties are stated against them."""

    rows: int
    deviation: float


def label_shape(train: DataFrame, label: str = LABEL) -> LabelShape:
    row = train.agg(F.count(ident(label)), F.stddev_pop(ident(label))).first()
    return LabelShape(row[0], row[1] or 1.0)


def least_squares() -> LinearRegression:
    return LinearRegression(featuresCol=FEATURES, labelCol=LABEL, regParam=0.0)


def ridge(shape: LabelShape, alpha: float = 1.0) -> LinearRegression:
    """Squared error plus alpha times the squared weights of population-scaled features.

    MLlib divides the error by 2n and the penalty by the label's population
    deviation, and its scaler uses the sample deviation: hence the factors.
    """
    n = shape.rows
    penalty = alpha * shape.deviation / n * (n - 1) / n
    return LinearRegression(
        featuresCol=FEATURES, labelCol=LABEL, elasticNetParam=0.0, regParam=penalty, standardization=False
    )


def lasso(shape: LabelShape, alpha: float = 1.0, max_iter: int = 200) -> LinearRegression:
    n = shape.rows
    return LinearRegression(
        featuresCol=FEATURES, labelCol=LABEL, elasticNetParam=1.0, regParam=alpha * sqrt((n - 1) / n),
        standardization=False, maxIter=max_iter, tol=1e-9,
    )


@dataclass(frozen=True)
class ModelSpec:
    """A named estimator; linear ones take standardised features."""

    name: str
    build: Callable[[LabelShape], Estimator]
    scaled: bool = False


@dataclass(frozen=True)
class TreeSpec:
    """A named tree model over the binned store; `fit` takes the prepared data and the settings that differ."""

    name: str
    fit: Callable[..., object]
    settings: Mapping[str, object]

    def with_settings(self, settings: Mapping[str, object]) -> TreeSpec:
        return TreeSpec(self.name, self.fit, {**self.settings, **settings})


def small_models(trees: int = 100) -> list[ModelSpec | TreeSpec]:
    """Linear models on filled and scaled features, and plain ensembles over the binned store."""
    return [
        ModelSpec("Linear Regression", lambda s: least_squares(), True),
        ModelSpec("Ridge", lambda s: ridge(s), True),
        ModelSpec("Lasso", lambda s: lasso(s), True),
        TreeSpec("Random Forest", fit_forest, {"trees": trees}),
        TreeSpec("Gradient Boosting", fit_gradient, {"rounds": trees}),
    ]


def large_models(rounds: int = 200, trees: int = 100) -> list[TreeSpec]:
    """Boosting variants and a bounded forest over one binned store.

    Leaf-wise trees split categories by sets of values, symmetric ones see
    their ordered target statistics, the others take categories as numbers in
    the order of their names.
    """
    return [
        TreeSpec("Histogram Boosting", fit_histogram, {"rounds": rounds, "rate": 0.1, "leaves": 31, "depth": 10, "min_rows": 20}),
        TreeSpec("Leaf-wise Boosting", fit_leafwise, {"rounds": rounds, "rate": 0.1, "leaves": 63, "depth": 10, "min_rows": 20}),
        TreeSpec("Symmetric Boosting", fit_symmetric, {"rounds": rounds, "rate": 0.1, "depth": 8, "l2": 3.0}),
        TreeSpec("Random Forest", fit_forest, {"trees": trees, "depth": 15, "min_split": 20, "min_rows": 10, "share": 0.5}),
    ]


def fit_histogram(data, fold: tuple[int, int] | None = None, **settings):
    return histogram_boosting(data.store(), used=data.plain, fold=fold, **({"early": False} if fold else {}), **settings)


def fit_leafwise(data, fold: tuple[int, int] | None = None, **settings):
    return leafwise_boosting(data.store(), categories=data.categories, used=data.plain, fold=fold, **settings)


def fit_symmetric(data, fold: tuple[int, int] | None = None, **settings):
    store = data.store()
    return data.encoded(symmetric_boosting(store, used=[*data.numbers, *data.statistics], fold=fold, **settings))


def fit_gradient(data, fold: tuple[int, int] | None = None, **settings):
    return gradient_boosting(data.store(), used=data.plain, fold=fold, **settings)


def fit_forest(data, fold: tuple[int, int] | None = None, **settings):
    return random_forest(data.store(), used=data.plain, fold=fold, **settings)


def assembled(fill: Mapping[str, float], features: Sequence[str], estimator: Estimator, scaled: bool) -> Pipeline:
    """Fill, assemble, scale and model in one pipeline.

    The exact train medians sit in the first stage, so they are saved and
    loaded with the model.
    """
    inputs = [f"_x{i}" for i in range(len(features))]
    cells = ", ".join(
        f"coalesce(CAST({quoted(n)} AS DOUBLE), {float(fill.get(n) or 0.0)!r}D) AS {x}" for n, x in zip(features, inputs)
    )
    stages = [
        SQLTransformer(statement=f"SELECT *, {cells} FROM __THIS__"),
        VectorAssembler(inputCols=inputs, outputCol="_raw" if scaled else FEATURES),
    ]
    if scaled:
        stages.append(StandardScaler(inputCol="_raw", outputCol=FEATURES, withMean=True, withStd=True))
    return Pipeline(stages=[*stages, estimator])
