"""Enrichment and distributions of one measure: the numbers behind the usual exploration plots."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.operators.ordering import with_position
from tidewell.operators.quantiles import group_quantiles
from tidewell.session import settled

QUARTILES = {"q1": 0.25, "median": 0.5, "q3": 0.75}


def enrich(fact: DataFrame, dimension: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Left join. Spark broadcasts the dimension by its size and splits skewed keys otherwise."""
    return fact.join(dimension, on=on, how="left")


def lookup(refs: DataFrame, known: DataFrame, on: str) -> DataFrame:
    """Exact match of each reference, with `found` telling the missing ones apart."""
    marked = known.select(on).distinct().withColumn("__hit", F.lit(True))
    return refs.join(marked, on, "left").withColumn("found", F.col("__hit").isNotNull()).drop("__hit")


def category_codes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Add `<column>_code`: place of the value among the sorted distinct values, -1 for null."""
    for name in columns:
        code = f"{name}_code"
        values = df.select(F.col(name).alias("__value")).filter(F.col(name).isNotNull()).distinct()
        coded = settled(with_position(values, ["__value"], name=code), "categories")
        df = df.join(coded, F.col(name) == F.col("__value"), "left").drop("__value")
        df = df.withColumn(code, F.coalesce(F.col(code), F.lit(-1)).cast("int"))
    return df


def daily_totals(df: DataFrame, date: str, value: str, out: str = "total") -> DataFrame:
    return df.groupBy(F.to_date(date).alias("date")).agg(F.sum(value).alias(out))


def _extent(df: DataFrame, value: str) -> Column:
    return df.agg(
        F.struct(
            F.min(value).cast("double").alias("low"),
            F.max(value).cast("double").alias("high"),
            F.count(value).alias("n"),
            F.stddev_samp(value).alias("std"),
        )
    ).scalar()


def histogram(df: DataFrame, value: str, bins: int = 50) -> DataFrame:
    """Equal-width bins over [min, max] with the last bin closed; empty bins are listed too."""
    extent = _extent(df, value)
    flat = extent["low"] == extent["high"]
    low = F.when(flat, extent["low"] - 0.5).otherwise(extent["low"])
    width = F.when(flat, F.lit(1.0)).otherwise(extent["high"] - extent["low"])
    place = F.floor((F.col(value) - low) / width * bins).cast("int")
    counts = (
        df.filter(F.col(value).isNotNull())
        .groupBy(F.least(place, F.lit(bins - 1)).alias("bin"))
        .agg(F.count(F.lit(1)).alias("count"))
    )
    grid = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return grid.join(counts, "bin", "left").select(
        "bin",
        (low + width * F.col("bin") / bins).alias("low"),
        (low + width * (F.col("bin") + 1) / bins).alias("high"),
        F.coalesce("count", F.lit(0)).alias("count"),
    )


# Boxes to a bandwidth, terms of a box's expansion, and how far it reaches, in bandwidths: beyond, a kernel is below 3e-18 of its peak. Within,
# (x / 8)^10 / 10! * exp(-x^2 / 2) is below 2e-13, so a density is off by less than 1e-10 of the peak for any data.
BOXES, MOMENTS, REACH = 4, 10, 9


def _moments(d: Column) -> list[Column]:
    """Sums over the values of a box of exp(-d^2 / 2) d^k / k!, where d is the distance from its middle."""
    kernel, out = F.exp(-0.5 * d * d), []
    squares = [d]
    while 1 << len(squares) < MOMENTS:
        squares.append(squares[-1] * squares[-1])
    for k in range(MOMENTS):
        term = kernel
        for i, square in enumerate(squares):
            term = term * square if k >> i & 1 else term
        out.append(F.sum(term / math.factorial(k)).alias(f"m{k}"))
    return out


def density(df: DataFrame, value: str, points: int = 200) -> DataFrame:
    """Gaussian kernel density on an even grid over [min, max], bandwidth std * n^(-1/5).

    Fewer than two different values have no density, and the result no rows.

    A fast Gauss transform: the values of a box, a quarter of a bandwidth wide, are reduced to `MOMENTS` sums, in one pass and before any shuffle, so
    the cost of a row does not depend on the number of points. Each box then adds its expansion to the points within `REACH` bandwidths.
    """
    known = df.where(F.col(value).isNotNull()).select(F.col(value).cast("double").alias("v"))
    n, low, high, std = known.agg(F.count("v"), F.min("v"), F.max("v"), F.stddev_samp("v")).first()
    if not std:
        return df.sparkSession.createDataFrame([], "point int, x double, density double")
    step, bandwidth = (high - low) / (points - 1), std * n**-0.2
    placed = known.select(((F.col("v") - low) / bandwidth).alias("v")).withColumn("box", F.floor(F.col("v") * BOXES))
    middle, width = (F.col("box") + 0.5) / BOXES, step / bandwidth
    boxes = placed.groupBy("box").agg(*_moments(F.col("v") - middle))
    first = F.greatest(F.ceil((middle - REACH) / width), F.lit(0)).cast("int")
    last = F.least(F.floor((middle + REACH) / width), F.lit(points - 1)).cast("int")
    # Boxes between two points that are further apart than a box reaches meet none.
    near = boxes.where(first <= last).withColumn("point", F.explode(F.sequence(first, last)))
    x = F.col("point") * width - middle
    series = F.col(f"m{MOMENTS - 1}")
    for k in range(MOMENTS - 2, -1, -1):
        series = series * x + F.col(f"m{k}")
    sums = near.select("point", (F.exp(-0.5 * x * x) * series).alias("part")).groupBy("point").agg(F.sum("part").alias("__sum"))
    grid = df.sparkSession.range(points).select(F.col("id").cast("int").alias("point"))
    scale = n * bandwidth * math.sqrt(2 * math.pi)
    return grid.join(sums, "point", "left").select(
        "point", (F.lit(low) + F.lit(step) * F.col("point")).alias("x"), (F.coalesce("__sum", F.lit(0.0)) / scale).alias("density"))


def _fences(df: DataFrame, group: Sequence[str], value: str) -> DataFrame:
    stats = group_quantiles(df, group, value, QUARTILES)
    reach = (F.col("q3") - F.col("q1")) * 1.5
    return stats.withColumn("__floor", F.col("q1") - reach).withColumn("__ceiling", F.col("q3") + reach)


def _with_fences(df: DataFrame, group: Sequence[str], value: str) -> DataFrame:
    fences = settled(_fences(df, group, value), "fences")
    keys = {g: f"__f{i}" for i, g in enumerate(group)}
    for g, key in keys.items():
        fences = fences.withColumnRenamed(g, key)
    same = [F.col(g).eqNullSafe(F.col(key)) for g, key in keys.items()]
    return df.filter(F.col(value).isNotNull()).join(fences, same).drop(*keys.values())


def box_stats(df: DataFrame, group: Sequence[str], value: str) -> DataFrame:
    """Quartiles, whiskers at the furthest points within 1.5 IQR, and the number of outliers."""
    # Written once: the sizes, the quartiles and the whiskers are three passes over it.
    joined = _with_fences(settled(df.select(*group, value), "measured"), group, value)
    inside = F.col(value).between(F.col("__floor"), F.col("__ceiling"))
    return joined.groupBy(*group).agg(
        F.first("n").alias("n"),
        *[F.first(q).alias(q) for q in QUARTILES],
        F.min(F.when(inside, F.col(value))).alias("whisker_low"),
        F.max(F.when(inside, F.col(value))).alias("whisker_high"),
        F.count_if(~inside).alias("outliers"),
    )


def box_outliers(df: DataFrame, group: Sequence[str], value: str) -> DataFrame:
    """Rows beyond the whiskers of their group."""
    joined = _with_fences(df, group, value)
    beyond = ~F.col(value).between(F.col("__floor"), F.col("__ceiling"))
    return joined.filter(beyond).select(*df.columns)


def rank_by_median(df: DataFrame, group: str, value: str, member: str) -> DataFrame:
    """Groups from the highest median down, with their number of distinct members."""
    medians = group_quantiles(df, [group], value, {"median": 0.5})
    members = df.groupBy(group).agg(F.count_distinct(member).alias("members")).withColumnRenamed(group, "__group")
    joined = medians.join(members, F.col(group).eqNullSafe(F.col("__group"))).withColumn("__down", -F.col("median"))
    ranked = with_position(joined, ["__down", group], name="rank")
    return ranked.withColumn("rank", F.col("rank") + 1).select(group, "median", "n", "members", "rank")
