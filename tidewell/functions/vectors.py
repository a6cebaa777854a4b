"""Arithmetic on `array<double>` columns."""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate `value` once and hand it to `body`.

    Inside a lambda Spark would otherwise work out an outer expression again for each element.
    """
    return F.transform(F.array(value), body)[0]


def doubles(x: Column) -> Column:
    return x.cast("array<double>")


def total(x: Column) -> Column:
    return F.aggregate(x, F.lit(0.0), lambda acc, v: acc + v)


def dot(x: Column, y: Column) -> Column:
    return total(F.zip_with(x, y, lambda a, b: a * b))


def weights(rows: Sequence[Sequence[float]]) -> Column:
    """A literal matrix, one inner array per output, folded to a constant by the optimizer."""
    return F.from_json(F.lit(json.dumps([[float(w) for w in row] for row in rows])), "array<array<double>>")


def linear(x: Column, matrix: Column) -> Column:
    return bind(x, lambda v: F.transform(matrix, lambda row: dot(row, v)))


def softmax(x: Column) -> Column:
    """Softmax with the maximum subtracted first."""
    def shifted(v):
        return bind(F.array_max(v), lambda top: F.transform(v, lambda item: F.exp(item - top)))
    return bind(bind(x, shifted), lambda e: bind(total(e), lambda s: F.transform(e, lambda item: item / s)))


def rms_norm(x: Column, eps: float = 1e-5) -> Column:
    def scaled(v):
        scale = F.pow(dot(v, v) / F.size(v) + F.lit(eps), F.lit(-0.5))
        return bind(scale, lambda s: F.transform(v, lambda item: item * s))
    return bind(x, scaled)


def constants(values: Sequence[float]) -> Column:
    return F.array(*[F.lit(float(v)) for v in values])


def affine(x: Column, matrix: Sequence[Sequence[float]], bias: Sequence[float] | None = None) -> Column:
    """A dense layer: one weight row and, if given, one bias per output."""
    out = linear(x, weights(matrix))
    return out if bias is None else add(out, constants(bias))


def layer_norm(x: Column, eps: float = 1e-3, gain: Sequence[float] | None = None, shift: Sequence[float] | None = None) -> Column:
    """Zero mean and unit population variance, then times `gain` and plus `shift` where they are given."""
    def centred(v):
        return bind(total(v) / F.size(v), lambda mean: F.transform(v, lambda item: item - mean))

    def scaled(c):
        return bind(F.sqrt(dot(c, c) / F.size(c) + F.lit(eps)), lambda s: F.transform(c, lambda item: item / s))
    out = bind(bind(x, centred), scaled)
    if gain is not None:
        out = F.zip_with(out, constants(gain), lambda a, b: a * b)
    return out if shift is None else add(out, constants(shift))


def activated(x: Column, name: str = "relu") -> Column:
    """An activation by name: `relu`, `tanh`, `sigmoid`, `gelu` (tanh form) or `linear`."""
    if name == "relu":
        return relu(x)
    if name == "tanh":
        return F.transform(x, F.tanh)
    if name == "sigmoid":
        return F.transform(x, lambda v: 1 / (1 + F.exp(-v)))
    if name == "gelu":
        return F.transform(x, lambda v: 0.5 * v * (1 + F.tanh(0.7978845608028654 * (v + 0.044715 * v * v * v))))
    if name == "linear":
        return x
    raise ValueError(f"unknown activation {name!r}")


def relu(x: Column) -> Column:
    return F.transform(x, lambda v: F.greatest(v, F.lit(0.0)))


def add(x: Column, y: Column) -> Column:
    return F.zip_with(x, y, lambda a, b: a + b)


def argmax(x: Column) -> Column:
    """0-based place of the largest element, the first one on ties."""
    return (F.array_position(x, F.array_max(x)) - 1).cast("int")


def cross_entropy(logits: Column, label: Column) -> Column:
    """-log softmax(logits)[label], through log-sum-exp."""
    def loss(v):
        def spread(top):
            return F.log(total(F.transform(v, lambda item: F.exp(item - top)))) + top
        return bind(F.array_max(v), spread) - F.element_at(v, label.cast("int") + 1)
    return bind(logits, loss)
