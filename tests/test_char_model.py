"""The character model against a plain numpy forward pass."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewell.operators import text
from tidewell.plans.char_model import CharModel, Layer, document_loss
from tidewell.workload import Tables
from tidewell.workload.text import token_pairs


def expected(model, tokens, block):
    def norm(v):
        return v / np.sqrt((v * v).mean(-1, keepdims=True) + 1e-5)

    n = min(block, len(tokens) - 1)
    ids = np.array(tokens[:n])
    x = norm(np.array(model.tokens)[ids] + np.array(model.positions)[:n])
    for layer in model.layers:
        h = norm(x)
        q, k, v = (h @ np.array(w).T for w in (layer.query, layer.key, layer.value))
        width, parts = q.shape[1] // model.heads, []
        for i in range(model.heads):
            cut = slice(i * width, (i + 1) * width)
            score = np.where(np.tri(n, dtype=bool), q[:, cut] @ k[:, cut].T / np.sqrt(width), -np.inf)
            weight = np.exp(score - score.max(1, keepdims=True))
            parts.append(weight / weight.sum(1, keepdims=True) @ v[:, cut])
        x = np.hstack(parts) @ np.array(layer.mix).T + x
        x = np.maximum(norm(x) @ np.array(layer.widen).T, 0) @ np.array(layer.narrow).T + x
    out = x @ np.array(model.head).T
    chance = np.exp(out) / np.exp(out).sum(1, keepdims=True)
    return -np.log(chance[np.arange(n), tokens[1 : n + 1]]).mean()


@pytest.mark.parametrize("layers", [0, 2])
def test_document_loss(spark, layers):
    rng = np.random.default_rng(4)
    docs = spark.createDataFrame([(1, "abba"), (2, "cab"), (3, "a"), (4, "bcbcbcbcbc")], "id int, t string")
    codec = text.CharCodec.of(text.char_vocabulary(docs, "t"))
    size, width, block = codec.boundary + 1, 8, 6

    def matrix(rows, columns):
        return rng.normal(0, 0.5, (rows, columns)).tolist()

    model = CharModel(
        matrix(size, width), matrix(block, width),
        [Layer(*[matrix(width, width) for _ in range(4)], matrix(4 * width, width), matrix(width, 4 * width)) for _ in range(layers)],
        matrix(size, width), heads=2)
    coded = docs.withColumn("ids", codec.encode(F.col("t")))
    losses = document_loss(text.next_token_pairs(coded, "ids", block, ["id"]), model, "id")
    got = {r["id"]: (r["nll"], r["positions"]) for r in losses.collect()}
    for row in coded.collect():
        nll, positions = got[row["id"]]
        ids = row["ids"]
        assert positions == len(ids) - 1
        parts = [ids[a : a + block + 1] for a in range(0, len(ids) - 1, block)]
        total = sum(expected(model, part, block) * (len(part) - 1) for part in parts)
        assert nll == pytest.approx(total / positions, abs=1e-9)


def test_small_file_of_many_positions_is_dealt(spark, tmp_path):
    """One small file of rows that become many positions: several tasks make them."""
    spark.range(300).selectExpr("id AS k", "concat('ab', id) AS s").coalesce(1).write.parquet(str(tmp_path / "part.parquet"))
    pairs = token_pairs(Tables(spark, str(tmp_path)), "part", "k", "s", 16, rows_per_task=50)
    assert pairs.select(F.spark_partition_id().alias("p")).distinct().count() > 3
    assert pairs.count() == sum(len(f"ab{i}") + 1 for i in range(300))
