"""Scaled dot-product attention over ordered series, in tiles.

A series is cut into a coarse grid: tiles of consecutive query rows against tiles of consecutive key rows. A tile has about as many
rows as the geometric mean of the series and a block, so a row is copied once per grid column, and what is shuffled
grows with the length of a series to the power 1.5, not 2. Within a tile blocks are multiplied with numpy, and each query row keeps
one state of fixed size: the running maximum of its logits, the mass of their exponentials and the weighted sum of values. The
states of a row's tiles are merged as a tree. No row pairs are ever written out, and no task holds more than two tiles.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from math import isqrt

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.functions import vectors
from tidewell.operators.ordering import with_position
from tidewell.session import settled

# Rows of a block, rows of short series that share a call, and rows of a tile at most: two tiles must fit into a task.
BLOCK = 1024
PACK = 8 * BLOCK
TILE = 64 * BLOCK
# States of a row that are merged at a time.
FAN_IN = 16
STATE = "__top array<double>, __mass array<double>, __sum array<double>"


def tile_rows(longest: int, block: int = BLOCK) -> int:
    """Rows of a tile for series of at most `longest` rows: one block for a series of one block, 4 for 16, 16 for 256."""
    blocks = max(1, -(-longest // block))
    return min(max(TILE, block), block * (isqrt(blocks - 1) + 1))


def _matrix(table: pa.Table, name: str) -> np.ndarray:
    return table.column(name).combine_chunks().flatten().to_numpy().reshape(table.num_rows, -1)


def _codes(series: Sequence[str], *tables: pa.Table) -> list[np.ndarray]:
    """A number per row that tells the series apart, null like any other value."""
    names = pd.concat([t.select(list(series)).to_pandas() for t in tables])
    codes = names.groupby(list(series), dropna=False, sort=False).ngroup().to_numpy()
    return np.split(codes, np.cumsum([t.num_rows for t in tables])[:-1])


def _lists(values: np.ndarray) -> pa.Array:
    return pa.array(list(values), pa.list_(pa.float64()))


def _stated(rows: pa.Table, top: np.ndarray, mass: np.ndarray, total: np.ndarray) -> pa.Table:
    for name, values in (("__top", top), ("__mass", mass), ("__sum", total)):
        rows = rows.append_column(name, _lists(values))
    return rows


def _attend(q: np.ndarray, q_at: np.ndarray, k: np.ndarray, v: np.ndarray, k_at: np.ndarray, causal: bool, lookback: int | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """State of some query rows of one head over all key rows of a tile, block by block; rows are in order of place."""
    top, mass, total = np.full(len(q), -np.inf), np.zeros(len(q)), np.zeros((len(q), v.shape[1]))
    scale = 1 / np.sqrt(q.shape[1])
    # Key rows that some query row sees.
    last = np.searchsorted(k_at, q_at[-1], "right") if causal else len(k)
    first = 0 if lookback is None else np.searchsorted(k_at, q_at[0] - lookback, "right")
    for begin in range(first, last, BLOCK):
        part = slice(begin, min(begin + BLOCK, last))
        logits = q @ k[part].T * scale
        if causal:
            distance = q_at[:, None] - k_at[None, part]
            logits[(distance < 0) if lookback is None else (distance < 0) | (distance >= lookback)] = -np.inf
        high = np.maximum(top, logits.max(axis=1))
        known = np.where(np.isfinite(high), high, 0.0)
        shifted, fade = np.exp(logits - known[:, None]), np.exp(top - known)
        top, mass = high, mass * fade + shifted.sum(axis=1)
        total = total * fade[:, None] + shifted @ v[part]
    return top, mass, total


def _tile(left: pa.Table, right: pa.Table, series: Sequence[str], heads: int, causal: bool, lookback: int | None) -> pa.Table:
    """The states of the query rows of a tile (`left`) over its key rows (`right`), for each of the series in it."""
    n, rows = left.num_rows, left.drop_columns(["__q", "__qt", "__kt", "__pack"])
    if not n or not right.num_rows:
        return _stated(rows.slice(0, 0), *[np.zeros((0, 1))] * 3)
    qs, ks, vs = _matrix(left, "__q"), _matrix(right, "__k"), _matrix(right, "__v")
    q_at, k_at = left.column("__pos").to_numpy(), right.column("__pos").to_numpy()
    q_code, k_code = _codes(series, left, right)
    q_order, k_order = np.lexsort((q_at, q_code)), np.lexsort((k_at, k_code))
    present, starts = np.unique(q_code[q_order], return_index=True)
    k_starts, k_ends = (np.searchsorted(k_code[k_order], present, side) for side in ("left", "right"))
    dim, width = qs.shape[1] // heads, vs.shape[1] // heads
    top, mass, total = np.full((n, heads), -np.inf), np.zeros((n, heads)), np.zeros((n, heads * width))
    for start, end, k_start, k_end in zip(starts, [*starts[1:], n], k_starts, k_ends, strict=True):
        theirs = k_order[k_start:k_end]
        for begin in range(start, end, BLOCK) if k_end > k_start else ():
            mine = q_order[begin : min(begin + BLOCK, end)]
            for h in range(heads):
                d, w = slice(h * dim, (h + 1) * dim), slice(h * width, (h + 1) * width)
                top[mine, h], mass[mine, h], total[mine, w] = _attend(qs[mine, d], q_at[mine], ks[theirs, d], vs[theirs, w], k_at[theirs], causal, lookback)
    return _stated(rows, top, mass, total)


def _merge(table: pa.Table, series: Sequence[str]) -> pa.Table:
    """One state per row out of those of several tiles, or of states merged before."""
    rows = table.drop_columns(["__top", "__mass", "__sum"])
    place = rows.column_names.index("__part")
    rows = rows.set_column(place, "__part", pa.array(rows.column("__part").to_numpy() // FAN_IN, pa.int32()))
    at, code = table.column("__pos").to_numpy(), _codes(series, table)[0]
    order = np.lexsort((at, code))
    first = np.flatnonzero(np.diff(code[order], prepend=-1) | (np.diff(at[order], prepend=-1) != 0))
    top, mass, total = (_matrix(table, name)[order] for name in ("__top", "__mass", "__sum"))
    counts = np.diff(np.append(first, len(order)))
    high = np.maximum.reduceat(top, first)
    fade = np.exp(top - np.repeat(np.where(np.isfinite(high), high, 0.0), counts, axis=0))
    mass = np.add.reduceat(mass * fade, first)
    total = np.add.reduceat(total * np.repeat(fade, total.shape[1] // fade.shape[1], axis=1), first)
    return _stated(rows.take(pa.array(order[first])), high, mass, total)


def attention(
    df: DataFrame,
    series: Sequence[str],
    order: Sequence[str],
    q: str,
    k: str,
    v: str,
    heads: int = 1,
    causal: bool = True,
    lookback: int | None = None,
    keep: Sequence[str] = (),
    block: int = BLOCK,
    out: str = "attended",
) -> DataFrame:
    """Series, `keep` columns and the attended vector of each row.

    Causal attention sees the row itself and earlier rows, with `lookback` only that many of them
    (the row included); otherwise every row of the series is seen. `block` is the number of rows that one tile has at least.
    """
    if lookback is not None and not causal:
        raise ValueError("lookback applies to causal attention")
    names = [c for c in dict.fromkeys(keep) if c not in series]
    given = df.select(*dict.fromkeys([*series, *order, *names]), *[vectors.doubles(F.col(c)).alias(n) for n, c in (("__q", q), ("__k", k), ("__v", v))])
    # Written once: the places of the rows, the lengths, the queries and the keys come from it.
    placed = settled(with_position(given, order, series, "__pos"), "series")
    rows, longest = placed.agg(F.count(F.lit(1)), F.coalesce(F.max("__pos") + 1, F.lit(0))).first()
    seen = longest if lookback is None else min(longest, lookback)
    side = tile_rows(seen, block)
    tile = lambda pos: F.floor(pos / side).cast("bigint")
    own, zero = tile(F.col("__pos")), F.lit(0).cast("bigint")
    last = zero
    if longest > side and lookback is None:
        ends = placed.groupBy(*[F.col(s).alias(f"__s{i}") for i, s in enumerate(series)]).agg(tile(F.max("__pos")).alias("__last"))
        placed = placed.join(settled(ends, "series-ends"), [F.col(s).eqNullSafe(F.col(f"__s{i}")) for i, s in enumerate(series)])
        last = F.col("__last")
    first_key = zero if lookback is None else tile(F.greatest(F.col("__pos") - (lookback - 1), zero))
    last_query = last if lookback is None else tile(F.col("__pos") + (lookback - 1))
    # Short series share a call, about PACK rows at a time.
    pack = F.pmod(F.xxhash64(*series), F.lit(max(1, rows // PACK))).alias("__pack")
    queries = placed.select(*series, pack, "__pos", "__q", *names, own.alias("__qt"), F.posexplode(F.sequence(first_key, own if causal else last)).alias("__part", "__kt"))
    # The same columns under names of their own, which the join of both sides needs.
    shared = [F.col(c).alias(c) for c in (*series, "__pos", "__k", "__v")]
    keys = placed.select(*shared, pack, F.explode(F.sequence(own if causal else zero, last_query)).alias("__qt"), own.alias("__kt"))

    told, calls = list(series), ["__pack", "__qt", "__kt"]
    head = queries.drop("__q", *calls).schema
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in head) + f", {STATE}"
    states = queries.groupBy(*calls).cogroup(keys.groupBy(*calls)).applyInArrow(
        lambda left, right: _tile(left, right, told, heads, causal, lookback), columns)
    # As many states of a row as key tiles that it sees; FAN_IN of them are merged at a time.
    parts = -(-longest // side) if lookback is None else min(-(-longest // side), (lookback - 1) // side + 2)
    while parts > 1:
        near = [pack, F.floor(F.col("__pos") / block).alias("__near"), F.floor(F.col("__part") / FAN_IN).alias("__share")]
        states = states.groupBy(*near).applyInArrow(lambda table: _merge(table, told), columns)
        parts = -(-parts // FAN_IN)
    width = F.size("__sum") / heads
    value = F.transform("__sum", lambda x, j: x / F.get("__mass", F.floor(j / width).cast("int")))
    return states.select(*series, *names, value.alias(out))


def temporal_attention_block(
    df: DataFrame,
    series: Sequence[str],
    order: Sequence[str],
    x: str,
    wq: Sequence[Sequence[float]],
    wk: Sequence[Sequence[float]],
    wv: Sequence[Sequence[float]],
    wo: Sequence[Sequence[float]],
    causal: bool = True,
    keep: Sequence[str] = (),
    out: str = "block",
    biases: Mapping[str, Sequence[float]] | None = None,
    gain: Sequence[float] | None = None,
    shift: Sequence[float] | None = None,
    activation: str = "relu",
) -> DataFrame:
    """Attention on projections of x, residual activation, layer normalisation and an output projection.

    `biases` may have `q`, `k`, `v` and `o`; `gain` and `shift` belong to the normalisation.
    """
    given = biases or {}
    projected = df.withColumns({
        name: vectors.affine(vectors.doubles(F.col(x)), w, given.get(key))
        for name, w, key in (("__wq", wq, "q"), ("__wk", wk, "k"), ("__wv", wv, "v"))
    })
    attended = attention(
        projected, series, order, "__wq", "__wk", "__wv", causal=causal, keep=[*keep, x], out="__attended")
    summed = vectors.activated(vectors.add(vectors.doubles(F.col(x)), F.col("__attended")), activation)
    normal = attended.withColumn("__normal", vectors.layer_norm(summed, gain=gain, shift=shift))
    return normal.withColumn(out, vectors.affine(F.col("__normal"), wo, given.get("o"))).drop("__attended", "__normal")
