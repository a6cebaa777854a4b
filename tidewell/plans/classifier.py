"""Text classifier: hashed term counts and logistic regression, trained and scored by Spark."""

from __future__ import annotations

import time
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF, RegexTokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.operators.evaluate import evaluation
from tidewell.session import shared_folder


def stages(text: str = "text", label: str = "label", features: int = 1 << 16, epochs: int = 10) -> Pipeline:
    return Pipeline(stages=[
        RegexTokenizer(inputCol=text, outputCol="__words", pattern=r"[\s\p{Punct}]+"),
        HashingTF(inputCol="__words", outputCol="__counts", numFeatures=features),
        LogisticRegression(featuresCol="__counts", labelCol=label, maxIter=epochs, regParam=0.01),
    ])


@dataclass(frozen=True)
class Trained:
    """A stored pipeline model and its objective after each pass over the data."""

    path: str
    history: tuple[float, ...]

    @property
    def model(self) -> PipelineModel:
        return PipelineModel.load(self.path)


def train(df: DataFrame, text: str = "text", label: str = "label", path: str | None = None, **options: int) -> Trained:
    """Fit and store. Scoring loads the stored model: a fitted one drags its training session along."""
    spark = df.sparkSession
    fitted = stages(text, label, **options).fit(df.withColumn(label, F.col(label).cast("double")))
    place = path or shared_folder(spark, "classifier")
    fitted.write().overwrite().save(place)
    return Trained(place, tuple(fitted.stages[-1].summary.objectiveHistory))


def score(model: PipelineModel, df: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Logits and predicted class of each row."""
    return model.transform(df).select(
        *keep,
        vector_to_array("rawPrediction").alias("logits"),
        F.col("prediction").cast("int").alias("prediction"),
    )


def training_stats(spark: SparkSession, trained: Trained) -> DataFrame:
    """One row per pass over the data with the objective after it."""
    return spark.createDataFrame(list(enumerate(trained.history)), "epoch int, loss double")


def test(model: PipelineModel, df: DataFrame, key: str, label: str = "label", size: int = 32) -> dict[str, float]:
    """Average loss, average accuracy and seconds taken."""
    start = time.monotonic()
    row = evaluation(score(model, df, [key, label]), [key], "logits", label, size).first()
    return {
        "avg_loss": row["avg_loss"], "avg_accuracy": row["avg_accuracy"], "elapsed": time.monotonic() - start}
