"""Batch scoring with a fitted model, on the price scale."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabmill.plans.models import PREDICTION
from tabmill.runtime import ident
from tabmill.trees.boosting import Boosted, EncodedModel

# Fixed value: half width of the price band as a share of the price.
BAND = 0.15


Model = PipelineModel | Boosted | EncodedModel
_KINDS = {"pipeline": PipelineModel, "trees": Boosted, "encoded": EncodedModel}


def save_model(model: Model, path: str) -> None:
    """The model under `path`/model, its kind beside it."""
    spark = SparkSession.getActiveSession()
    kind = next(k for k, c in _KINDS.items() if isinstance(model, c))
    if isinstance(model, PipelineModel):
        model.write().overwrite().save(f"{path}/model")
    else:
        model.save(spark, f"{path}/model")
    spark.createDataFrame([(kind,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/kind")


def load_model(path: str) -> Model:
    spark = SparkSession.getActiveSession()
    kind = _KINDS[spark.read.text(f"{path}/kind").first()[0]]
    return PipelineModel.load(f"{path}/model") if kind is PipelineModel else kind.load(spark, f"{path}/model")


def _whole(c):
    return F.bround(c, 0).cast("bigint")


def price_band(df: DataFrame, log_price: str = PREDICTION) -> DataFrame:
    """Price, band and limits from the log-scale prediction, in whole units."""
    price = F.expm1(ident(log_price))
    return df.select(
        *[ident(c) for c in df.columns if c != log_price],
        ident(log_price).alias("price_log"),
        _whole(price).alias("price"),
        _whole(price * BAND).alias("confidence_interval"),
        _whole(price - price * BAND).alias("price_min"),
        _whole(price + price * BAND).alias("price_max"),
    )


def score_batch(model: Model, df: DataFrame) -> DataFrame:
    """Score whole tables; the model fills nulls with its own train medians."""
    scored = model.transform(df)
    return price_band(scored.select(*[ident(c) for c in df.columns], PREDICTION))


def with_error(scored: DataFrame, actual: str) -> DataFrame:
    return scored.withColumn("abs_error", F.abs(F.col("price") - ident(actual)))
