"""Score documents with a given character-level model: logits and loss of each position."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.functions import vectors
from tidewell.operators.attention import attention
from tidewell.operators.evaluate import sequence_nll

Matrix = Sequence[Sequence[float]]


@dataclass(frozen=True)
class Layer:
    """Projections of one block; each matrix has one row per output."""

    query: Matrix
    key: Matrix
    value: Matrix
    mix: Matrix
    widen: Matrix
    narrow: Matrix


@dataclass(frozen=True)
class CharModel:
    """Embeddings of tokens and positions, blocks, and the output projection."""

    tokens: Matrix
    positions: Matrix
    layers: Sequence[Layer]
    head: Matrix
    heads: int = 1


def _rows(lists: pa.ListArray):
    import numpy as np

    return lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(lists), -1)


def _fed(layer: Layer, attended: Column, x: Column) -> Column:
    """What a block makes of a position after attention: mixed into `x`, normalised, widened and narrowed, for a batch of rows at once."""
    mix, widen, narrow = layer.mix, layer.widen, layer.narrow

    @F.arrow_udf("array<double>")
    def fed(attended, x):
        import numpy as np
        import pyarrow as pa

        y = _rows(x) + _rows(attended) @ np.array(mix, np.float64).T
        normal = y * ((y * y).mean(axis=1, keepdims=True) + 1e-5) ** -0.5
        y = y + np.maximum(normal @ np.array(widen, np.float64).T, 0.0) @ np.array(narrow, np.float64).T
        return pa.ListArray.from_arrays(pa.array(np.arange(len(y) + 1) * y.shape[1], pa.int32()), pa.array(y.ravel()))

    return fed(attended, x)


def _likelihoods(states: DataFrame, head: Matrix, key: str) -> DataFrame:
    """`key` and `__p`, the probability of the target, without the logits as a column; null where the target has none."""
    def likelihoods(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            if not len(batch):
                continue
            given = batch.column(2).fill_null(-1).to_numpy(zero_copy_only=False)
            scores = _rows(batch.column(1)) @ np.array(head, np.float64).T
            shifted = np.exp(scores - scores.max(axis=1, keepdims=True))
            none = (given < 0) | (given >= scores.shape[1])
            found = shifted[np.arange(len(given)), np.where(none, 0, given)] / shifted.sum(axis=1)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, mask=none)], names=[key, "__p"])

    kind = states.schema[key].dataType.simpleString()
    return states.select(key, "x", "target").mapInArrow(likelihoods, f"`{key}` {kind}, __p double")


def _last_states(pairs: DataFrame, model: CharModel, key: str) -> DataFrame:
    """`x`, the state of each position after all blocks.

    A position sees itself and the earlier ones of its block. The positions are bounded by the
    rows of the position embedding, the blocks of a document are not.
    """
    def times(name: str, matrix: Matrix):
        return vectors.linear(F.col(name), vectors.weights(matrix))

    start = vectors.add(
        F.get(vectors.weights(model.tokens), F.col("token")),
        F.get(vectors.weights(model.positions), F.col("position")))
    keep = ["position", "token", "target"]
    rows = pairs.select(key, "block", *keep, vectors.rms_norm(start).alias("x"))
    for layer in model.layers:
        rows = rows.withColumn("__n", vectors.rms_norm(F.col("x")))
        rows = rows.withColumns({
            "__q": times("__n", layer.query), "__k": times("__n", layer.key), "__v": times("__n", layer.value)})
        rows = attention(
            rows, [key, "block"], ["position"], "__q", "__k", "__v", model.heads, keep=[*keep, "x"], out="__a")
        rows = rows.withColumn("x", _fed(layer, F.col("__a"), F.col("x")))
    return rows.select(key, "block", *keep, "x")


def logits(pairs: DataFrame, model: CharModel, key: str) -> DataFrame:
    """Add `logits` to rows of (key, block, position, token, target)."""
    states = _last_states(pairs, model, key)
    return states.withColumn("logits", vectors.linear(F.col("x"), vectors.weights(model.head))).drop("x")


def document_loss(pairs: DataFrame, model: CharModel, key: str) -> DataFrame:
    """Mean negative log-likelihood of each document over its positions."""
    states = _last_states(pairs, model, key)
    return sequence_nll(_likelihoods(states, model.head, key), key, "__p")
