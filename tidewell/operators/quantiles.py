"""Exact quantiles per group, with linear interpolation, in bounded memory."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewell.operators.ordering import hot_groups, quoted, split_hot
from tidewell.session import settled

# Bits of a key that one pass over the rows decides.
DIGIT_BITS = 16


def group_quantiles(
    df: DataFrame,
    group: Sequence[str],
    value: str,
    probs: dict[str, float],
    extra: Sequence[Column] = (),
) -> DataFrame:
    """One row per group with its row count `n` and one column per named quantile.

    `extra` are further named aggregates over the same rows, computed in the same pass from the
    group columns and the measure, which they see as `value`. Nulls are left out.

    Groups within the per-task row limit take the built-in `percentile`, which keeps a table of the
    values of a group. The ranks of larger groups are found by counting digits of order-preserving keys.
    """
    group = list(group)
    rows = df.select(*map(quoted, group), F.col(quoted(value)).cast("double").alias("value")).filter(F.col("value").isNotNull())
    found = hot_groups(rows, group)
    if found is None:
        return _counted(rows, group, probs, extra)
    hot, _ = found
    if not group:
        return _ranked(rows, group, probs, extra)
    large, small = split_hot(rows, hot, group)
    return _ranked(large, group, probs, extra).unionByName(_counted(small, group, probs, extra))


def _counted(df: DataFrame, group: list[str], probs: dict[str, float], extra: Sequence[Column]) -> DataFrame:
    # One call for all quantiles: each call would keep its own table of values.
    found = df.groupBy(*map(quoted, group)).agg(
        F.count(F.lit(1)).alias("n"),
        F.percentile("value", F.array(*[F.lit(float(p)) for p in probs.values()])).alias("__q"),
        *extra,
    )
    picked = [F.col("__q")[i].alias(name) for i, name in enumerate(probs)]
    others = [c for c in found.columns if c not in (*group, "n", "__q")]
    return found.select(*map(quoted, group), "n", *picked, *map(quoted, others))


def _ranked(df: DataFrame, group: list[str], probs: dict[str, float], extra: Sequence[Column]) -> DataFrame:
    """Quantiles of large groups by selection: four passes count the values by the next 16 bits of their keys, among those that may still have a rank.

    Rows are neither sorted nor written, and a pass shuffles at most 65,536 counts per group, rank and task.
    """
    keys = [f"__g{i}" for i in range(len(group))]
    named = [F.col(quoted(g)).alias(k) for g, k in zip(group, keys, strict=True)]
    sizes = df.groupBy(*map(quoted, group)).agg(F.count(F.lit(1)).alias("n"), *extra)
    others = [c for c in sizes.columns if c not in (*group, "n")]
    # As many groups as have more rows than one task may hold.
    sizes = settled(sizes.select(F.monotonically_increasing_id().alias("__id"), *named, "n", *[F.col(quoted(c)).alias(f"__x{i}") for i, c in enumerate(others)]), "group-sizes")
    spot = {name: (F.col("n") - 1) * F.lit(float(p)) for name, p in probs.items()}
    ranks = F.array_distinct(F.array(*[f(spot[name]).cast("bigint") for name in probs for f in (F.floor, F.ceil)]))
    wanted = sizes.select("__id", F.explode(ranks).alias("__rank")).withColumn("__left", F.col("__rank")).withColumn("__prefix", F.lit(0).cast("bigint"))
    same = [F.col(quoted(g)).eqNullSafe(F.col(k)) for g, k in zip(group, keys, strict=True)]
    values = df.select(*map(quoted, group), "value")
    values = values.join(sizes.select("__id", *keys), same).select("__id", "value") if group else values.select(sizes.select("__id").scalar().alias("__id"), "value")
    for level in range(64 // DIGIT_BITS):
        wanted = settled(wanted, "ranks")
        known = {(r["__id"], r["__prefix"]) for r in wanted.select("__id", "__prefix").distinct().collect()}
        counts = values.mapInArrow(partial(_digits, known=known, level=level), "__id bigint, __prefix bigint, __digit int, __n bigint")
        counts = counts.groupBy("__id", "__prefix", "__digit").agg(F.sum("__n").alias("__n"))
        # At most 65,536 rows per group and prefix.
        below = Window.partitionBy("__id", "__prefix").orderBy("__digit").rowsBetween(Window.unboundedPreceding, -1)
        counts = settled(counts.withColumn("__below", F.coalesce(F.sum("__n").over(below), F.lit(0))), "digits")
        inside = (F.col("__left") >= F.col("__below")) & (F.col("__left") < F.col("__below") + F.col("__n"))
        wanted = wanted.join(counts, ["__id", "__prefix"]).where(inside).select(
            "__id", "__rank", (F.col("__left") - F.col("__below")).alias("__left"), F.shiftleft("__prefix", DIGIT_BITS).bitwiseOR(F.col("__digit")).alias("__prefix"))
    told = wanted.mapInArrow(_values, "__id bigint, __rank bigint, value double")
    listed = told.groupBy("__id").agg(F.map_from_entries(F.collect_list(F.struct("__rank", "value"))).alias("__values"))
    found, picked = sizes.join(listed, "__id"), []
    for name in probs:
        low, high = (F.element_at("__values", f(spot[name]).cast("bigint")) for f in (F.floor, F.ceil))
        picked.append(F.when(low == high, low).otherwise(low + (high - low) * (spot[name] - F.floor(spot[name]))).alias(name))
    return found.select(
        *[F.col(k).alias(g) for k, g in zip(keys, group, strict=True)], "n", *picked, *[F.col(f"__x{i}").alias(c) for i, c in enumerate(others)])


def _sortable(values: np.ndarray) -> np.ndarray:
    """Unsigned 64-bit keys in the order of the numbers; NaN is the largest, both zeros are one."""
    bits = np.where(np.isnan(values), np.nan, values + 0.0).view(np.int64)
    return (bits ^ ((bits >> 63) & np.int64((1 << 63) - 1))).view(np.uint64) ^ np.uint64(1 << 63)


def _digits(batches: Iterator[pa.RecordBatch], known: set[tuple[int, int]], level: int) -> Iterator[pa.RecordBatch]:
    """How often each next digit follows the known prefixes of the keys of a group."""
    order = sorted(known, key=lambda k: (k[0], k[1] % (1 << 64)))
    ids, prefixes = np.array([k[0] for k in order], np.int64), np.array([k[1] % (1 << 64) for k in order], np.uint64)
    first = {g: (np.searchsorted(ids, g, "left"), np.searchsorted(ids, g, "right")) for g in set(ids.tolist())}
    keys, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        found, at = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
        return found, np.bincount(at, np.concatenate([p[1] for p in parts]), len(found)).astype(np.int64)

    parts, held = [(keys, counts)], 0
    for batch in batches:
        groups, key = batch["__id"].to_numpy(), _sortable(batch["value"].to_numpy())
        prefix = key >> np.uint64(64 - DIGIT_BITS * level) if level else np.zeros(len(key), np.uint64)
        digit = (key >> np.uint64(64 - DIGIT_BITS * (level + 1))) & np.uint64((1 << DIGIT_BITS) - 1)
        for g in np.unique(groups).tolist():
            low, high = first.get(g, (0, 0))
            if low == high:
                continue
            mine = groups == g
            at = np.minimum(np.searchsorted(prefixes[low:high], prefix[mine]), high - low - 1)
            hit = prefixes[low:high][at] == prefix[mine]
            parts.append(np.unique((at[hit] + low) * (1 << DIGIT_BITS) + digit[mine][hit].astype(np.int64), return_counts=True))
            held += len(parts[-1][0])
        if held > 1 << 20:
            parts = [merged(parts)]
            held = 0
    keys, counts = merged(parts)
    at = keys >> DIGIT_BITS
    yield pa.RecordBatch.from_arrays([
        pa.array(ids[at], pa.int64()), pa.array(prefixes[at].view(np.int64), pa.int64()), pa.array(keys & ((1 << DIGIT_BITS) - 1), pa.int32()), pa.array(counts, pa.int64()),
    ], names=["__id", "__prefix", "__digit", "__n"])


def _values(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The numbers of whole keys."""
    for batch in batches:
        bits = (batch["__prefix"].to_numpy().view(np.uint64) ^ np.uint64(1 << 63)).view(np.int64)
        values = (bits ^ ((bits >> 63) & np.int64((1 << 63) - 1))).view(np.float64)
        yield pa.RecordBatch.from_arrays([batch["__id"], batch["__rank"], pa.array(values, pa.float64())], names=["__id", "__rank", "value"])
