"""Classifier evaluation from logits and labels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.functions import vectors
from tidewell.operators.text import with_batches


def scored(df: DataFrame, logits: str, label: str) -> DataFrame:
    """Add the predicted class, whether it is right, and the cross-entropy of each row."""
    predicted = df.withColumn("prediction", vectors.argmax(F.col(logits)))
    return predicted.withColumns({
        "correct": (F.col("prediction") == F.col(label)).cast("int"),
        "loss": vectors.cross_entropy(vectors.doubles(F.col(logits)), F.col(label)),
    })


def accuracy(df: DataFrame, prediction: str, label: str) -> DataFrame:
    right = (F.col(prediction) == F.col(label)).cast("double")
    return df.agg(F.count(F.lit(1)).alias("rows"), F.avg(right).alias("accuracy"))


def batch_means(df: DataFrame, order: Sequence[str], values: Sequence[str], size: int = 32) -> DataFrame:
    """Mean over batches of the mean in each batch, which is not the row mean when the last is short."""
    batches = with_batches(df, order, size).groupBy("batch").agg(*[F.avg(v).alias(v) for v in values])
    return batches.agg(F.count(F.lit(1)).alias("batches"), *[F.avg(v).alias(f"avg_{v}") for v in values])


def evaluation(df: DataFrame, order: Sequence[str], logits: str, label: str, size: int = 32) -> DataFrame:
    """One row: number of batches, average loss and average accuracy."""
    means = batch_means(scored(df, logits, label), order, ["loss", "correct"], size)
    return means.withColumnRenamed("avg_correct", "avg_accuracy")


def sequence_nll(df: DataFrame, key: str, probability: str) -> DataFrame:
    """Mean negative log-likelihood of each document over its positions."""
    return df.groupBy(key).agg(
        F.avg(-F.log(F.col(probability))).alias("nll"), F.count(F.lit(1)).alias("positions"))
