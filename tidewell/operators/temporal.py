"""Causal operators over ordered series, with weights as inputs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.functions import vectors
from tidewell.operators.ordering import over_frames, with_position

Kernel = Sequence[Sequence[Sequence[float]]]


def causal_conv(
    df: DataFrame,
    series: Sequence[str],
    order: Sequence[str],
    x: str,
    kernel: Kernel,
    dilation: int = 1,
    bias: Sequence[float] | None = None,
    out: str = "conv",
) -> DataFrame:
    """Dilated convolution that looks only backwards; before the start of a series are zeros.

    `x` is an array of channels and `kernel[tap][channel][filter]` has its newest tap last.
    """
    taps, channels, filters = len(kernel), len(kernel[0]), len(kernel[0][0])
    zeros = F.array(*[F.lit(0.0)] * channels)
    # One weight row per filter over the concatenated taps.
    matrix = vectors.weights([
        [kernel[j][c][f] for j in range(taps) for c in range(channels)] for f in range(filters)
    ])

    def convolved(frame, window):
        steps = [(taps - 1 - j) * dilation for j in range(taps)]
        lagged = [F.coalesce(F.lag(x, s).over(window), zeros) if s else F.col(x) for s in steps]
        frame = frame.withColumns({f"__tap{j}": tap for j, tap in enumerate(lagged)})
        value = vectors.linear(F.concat(*[F.col(f"__tap{j}") for j in range(taps)]), matrix)
        if bias is not None:
            value = vectors.add(value, F.array(*[F.lit(float(b)) for b in bias]))
        return frame.withColumn(out, value).drop(*[f"__tap{j}" for j in range(taps)])

    return over_frames(df, order, series, convolved, back=(taps - 1) * dilation)


def strided(df: DataFrame, series: Sequence[str], order: Sequence[str], stride: int) -> DataFrame:
    """Every `stride`-th step of each series, from the first one on."""
    placed = with_position(df, order, series, "__step")
    return placed.filter(F.col("__step") % stride == 0).drop("__step")


def temporal_block(
    df: DataFrame,
    series: Sequence[str],
    order: Sequence[str],
    x: str,
    kernel: Kernel,
    dilation: int = 1,
    bias: Sequence[float] | None = None,
    resample: Sequence[Sequence[float]] | None = None,
    resample_bias: Sequence[float] | None = None,
    activation: str = "relu",
    out: str = "block",
) -> DataFrame:
    """relu(act(conv(x)) + x): the activation is the convolution's, the sum always ends in ReLU. `resample` and its bias map x to the filters where
    their numbers differ."""
    channels, filters = len(kernel[0]), len(kernel[0][0])
    if resample is None and channels != filters:
        raise ValueError("channels and filters differ: give resample weights")
    convolved = causal_conv(df, series, order, x, kernel, dilation, bias, "__conv")
    kept = F.col(x) if resample is None else vectors.affine(F.col(x), resample, resample_bias)
    block = vectors.relu(vectors.add(vectors.activated(F.col("__conv"), activation), kept))
    return convolved.withColumn(out, block).drop("__conv")


def sequence_windows(
    df: DataFrame,
    series: Sequence[str],
    order: Sequence[str],
    features: Sequence[str],
    target: str,
    steps: int,
    ahead: int = 1,
) -> DataFrame:
    """The last `steps` feature rows of each row as `sequence`, with the target `ahead` rows later.

    Only complete windows that have a target are kept.
    """
    def collected(frame, window):
        span = window.rowsBetween(-(steps - 1), 0)
        row = F.array(*[F.col(f).cast("double") for f in features])
        return frame.withColumns({
            "sequence": F.collect_list(row).over(span),
            "target": F.lead(target, ahead).over(window),
            "__has_target": F.lead(F.lit(1), ahead).over(window),
        })

    windows = over_frames(df, order, series, collected, back=steps - 1, ahead=ahead)
    complete = (F.size("sequence") == steps) & F.col("__has_target").isNotNull()
    return windows.filter(complete).drop("__has_target")


def leakage(before: DataFrame, after: DataFrame, keys: Sequence[str], value: str, earlier: Column) -> DataFrame:
    """Largest change of an array column over the rows that must not have changed."""
    left = before.filter(earlier).select(*keys, F.col(value).alias("__a"))
    right = after.select(*keys, F.col(value).alias("__b"))
    gap = F.array_max(F.zip_with("__a", "__b", lambda a, b: F.abs(a - b)))
    return left.join(right, list(keys)).agg(F.max(gap).alias("max_change"), F.count(F.lit(1)).alias("rows"))
