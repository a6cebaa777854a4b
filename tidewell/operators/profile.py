"""Table profiles: shape, types, nulls and summary statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.operators.ordering import quoted
from tidewell.operators.quantiles import group_quantiles


def head(df: DataFrame, key: str | Sequence[str], n: int | None = 5) -> DataFrame:
    """The first `n` rows in key order, or all rows for None."""
    ordered = df.orderBy(*([key] if isinstance(key, str) else key))
    return df if n is None else ordered.limit(n)


def table_shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("rows")).withColumn("columns", F.lit(len(df.columns)))


def table_info(df: DataFrame) -> DataFrame:
    """Type and number of non-null values of each column, from one aggregate."""
    counts = df.agg(F.count(F.lit(1)).alias("__rows"), *[F.count(F.col(quoted(c))).alias(f"__c{i}") for i, c in enumerate(df.columns)])
    rows = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(name).alias("column"),
            F.lit(kind).alias("dtype"),
            F.col(f"__c{i}").alias("non_null"),
            (F.col("__rows") - F.col(f"__c{i}")).alias("nulls"),
        )
        for i, (name, kind) in enumerate(df.dtypes)
    ]
    return counts.select(F.inline(F.array(*rows)))


def null_counts(df: DataFrame) -> DataFrame:
    return table_info(df).select("column", "nulls")


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """count, mean, sample standard deviation, min, exact quartiles and max, one row per column."""
    pairs = F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(quoted(c)).cast("double").alias("value")) for c in columns
    ])
    values = df.select(F.inline(pairs))
    measures = [
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    ]
    quartiles = {"q25": 0.25, "q50": 0.5, "q75": 0.75}
    stats = group_quantiles(values, ["column"], "value", quartiles, measures)
    return stats.withColumnRenamed("n", "count").select(
        "column", "count", "mean", "std", "min", "q25", "q50", "q75", "max"
    )
