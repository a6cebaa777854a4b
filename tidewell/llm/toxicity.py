"""Toxicity scores: averaged character n-gram embeddings under a linear softmax, trained together in numpy."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import partial
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.llm.shared import LEFT, by_bytes, mix

# Lengths of the character n-grams; a space on either side of a word belongs to it.
GRAMS = (3, 4, 5)
BUCKETS = 1 << 17
# N-grams of no meaning that every text is taken to have, so that very short texts are not judged by chance.
PRIOR = 30
# An n-gram counts if so many training texts have it.
MIN_TEXTS = 10
DIMENSIONS = 8
# The mean embedding is multiplied by this before the softmax, so that one word in a hundred can decide.
SCALE = 100.0
# Bounds of the training sample: rows of each label, and characters of a text that may be in it.
SAMPLE_TOXIC, SAMPLE_CLEAN, SAMPLE_CHARS = 2000, 4000, 20_000
EPOCHS, BATCH, RATE, DECAY = 8, 128, 0.02, 2e-3
THRESHOLD = 0.7
SPACE = ord(" ")


def damped(text: str | None) -> str:
    """The words of a text, each as often as the root of its count: one word repeated must not outweigh the rest."""
    counts = Counter((text or "").lower().split())
    return " ".join([w if c < 4 else " ".join([w] * isqrt(c)) for w, c in counts.items()])


def gram_buckets(texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each n-gram length: the bucket at each character of the joined texts, whether one begins there, and where texts begin."""
    lowered = [damped(t) for t in texts]
    joined = np.frombuffer((" " + " ".join(lowered) + " ").encode("utf-32-le", "surrogatepass"), np.uint32)
    first = np.concatenate([[0], np.cumsum([len(t) + 1 for t in lowered])])
    space = (joined == SPACE) | ((joined >= 9) & (joined <= 13))
    codes = np.where(space, SPACE, joined).astype(np.uint64) + np.uint64(1)
    rolled, inner = codes, None
    for n in range(2, max(GRAMS) + 1):
        rolled = rolled[:-1] * LEFT + codes[n - 1 :]
        if n >= 3:
            letter = ~space[n - 2 : n - 2 + len(rolled)]
            inner = letter if inner is None else inner[: len(rolled)] & letter
        if n in GRAMS:
            yield (mix(rolled) & np.uint64(BUCKETS - 1)).astype(np.int64), inner, np.minimum(first, len(rolled))


def bags(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sparse rows of the share of each bucket among a text's n-grams: entries per text, bucket, share."""
    keys = []
    for bucket, valid, first in gram_buckets(texts):
        row = np.repeat(np.arange(len(texts)), np.diff(first))
        at = np.flatnonzero(valid[: len(row)])
        keys.append(row[at] * BUCKETS + bucket[at])
    keys, counts = np.unique(np.concatenate(keys), return_counts=True)
    rows = keys // BUCKETS
    return np.bincount(rows, minlength=len(texts)), (keys % BUCKETS).astype(np.int32), (counts / (PRIOR + np.bincount(rows, counts, len(texts)))[rows]).astype(np.float32)


def train(texts: list[str], toxic: np.ndarray, seed: int = 7) -> tuple[np.ndarray, float]:
    """Learns embeddings and softmax together (Adam, balanced classes); returns each bucket's share of the score, and the bias.

    Embeddings begin at zero, so n-grams that no training text has add nothing.
    """
    random = np.random.default_rng(seed)
    parts = [bags(texts[i : i + 64]) for i in range(0, len(texts), 64)]
    texts_with = np.zeros(BUCKETS, np.int64)
    for _, b, _ in parts:
        texts_with += np.bincount(b, minlength=BUCKETS)
    common = texts_with >= min(MIN_TEXTS, 1 + len(texts) // 100)
    for i, (sizes, b, s) in enumerate(parts):
        keep = common[b]
        left = np.bincount(np.repeat(np.arange(len(sizes)), sizes)[keep], minlength=len(sizes))
        parts[i] = left, b[keep], s[keep] * np.float32(SCALE)
    begin = np.concatenate([[0], np.cumsum(np.concatenate([p[0] for p in parts]))])
    buckets, shares = np.concatenate([p[1] for p in parts]), np.concatenate([p[2] for p in parts])
    del parts
    embedding = np.zeros((BUCKETS, DIMENSIONS), np.float32)
    softmax = random.normal(0, 0.5, (DIMENSIONS, 2)).astype(np.float32)
    bias = np.zeros(2, np.float32)
    weight = np.where(toxic == 1, 0.5 / max(1, (toxic == 1).sum()), 0.5 / max(1, (toxic == 0).sum())) * len(texts)
    moments = [[np.zeros_like(p), np.zeros_like(p)] for p in (embedding, softmax, bias)]
    step = 0
    for _ in range(EPOCHS):
        order = random.permutation(len(texts))
        for at in range(0, len(order), BATCH):
            chosen = order[at : at + BATCH]
            sizes = begin[chosen + 1] - begin[chosen]
            spot = np.repeat(begin[chosen] - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes) + np.arange(sizes.sum())
            owner, b, s = np.repeat(np.arange(len(chosen)), sizes), buckets[spot], shares[spot]
            taken = embedding[b] * s[:, None]
            mean = np.stack([np.bincount(owner, taken[:, d], len(chosen)) for d in range(DIMENSIONS)], 1).astype(np.float32)
            logits = mean @ softmax + bias
            odds = np.exp(logits - logits.max(1, keepdims=True))
            odds /= odds.sum(1, keepdims=True)
            odds[np.arange(len(chosen)), toxic[chosen]] -= 1
            slope = (odds * weight[chosen, None] / len(chosen)).astype(np.float32)
            back = (slope @ softmax.T)[owner] * s[:, None]
            wide = np.stack([np.bincount(b, back[:, d], BUCKETS) for d in range(DIMENSIONS)], 1)
            step += 1
            for param, moment, grad in zip((embedding, softmax, bias), moments, (wide + DECAY * embedding, mean.T @ slope, slope.sum(0)), strict=True):
                moment[0] = 0.9 * moment[0] + 0.1 * grad
                moment[1] = 0.99 * moment[1] + 0.01 * grad * grad
                param -= RATE * (moment[0] / (1 - 0.9**step)) / (np.sqrt(moment[1] / (1 - 0.99**step)) + 1e-6)
    direction = softmax[:, 1] - softmax[:, 0]
    return (embedding @ direction * SCALE).astype(np.float32), float(bias[1] - bias[0])


def score(texts: list[str | None], table: np.ndarray, bias: float) -> np.ndarray:
    total, count = np.zeros(len(texts)), np.zeros(len(texts))
    for bucket, valid, first in gram_buckets(texts):
        sums = np.concatenate([[0.0], np.cumsum(np.where(valid, table[bucket], 0.0), dtype=np.float64)])
        counts = np.concatenate([[0], np.cumsum(valid)])
        total += sums[first[1:]] - sums[first[:-1]]
        count += counts[first[1:]] - counts[first[:-1]]
    return 1 / (1 + np.exp(-np.clip(total / (PRIOR + count) + bias, -50, 50)))


def _scored(batches: Iterator[pa.RecordBatch], table: np.ndarray, bias: float) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rows, texts in by_bytes(list(range(len(batch))), batch["text"].to_pylist(), 1 << 20):
            at = pa.array(rows)
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"].take(at), batch["held_out"].take(at), pa.array(score(texts, table, bias), pa.float64())], names=["doc_id", "held_out", "score"])


def held_out(doc_id: str) -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def sample(docs: DataFrame, labels: DataFrame) -> tuple[list[str], np.ndarray]:
    """Labelled texts to learn from: at most `SAMPLE_TOXIC` and `SAMPLE_CLEAN` rows, by a hash of the id, none of them held out."""
    known = labels.where(~held_out("doc_id") & F.col("toxic").isin(0, 1)).select(F.col("doc_id").alias("label_id"), F.col("toxic").cast("int").alias("toxic"))
    order = [F.xxhash64("label_id"), "label_id"]
    chosen = known.where("toxic = 1").orderBy(*order).limit(SAMPLE_TOXIC).unionByName(known.where("toxic = 0").orderBy(*order).limit(SAMPLE_CLEAN))
    texts = docs.where(F.char_length("text") <= SAMPLE_CHARS).select("doc_id", "text")
    # The broadcast side has at most SAMPLE_TOXIC + SAMPLE_CLEAN rows of two numbers.
    known = texts.join(F.broadcast(chosen), F.col("doc_id") == F.col("label_id"))
    # One text per label, whatever shares its id: what is collected is bounded in rows as well.
    rows = known.groupBy("doc_id", "toxic").agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text")).collect()
    rows.sort(key=lambda r: (r["doc_id"], r["toxic"], r["text"]))
    return [r["text"] for r in rows], np.array([r["toxic"] for r in rows], np.int64)


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Scores every whole text of `docs (doc_id, text)`; learns from `labels (doc_id, toxic)` of rows that are not held out.

    Held out are rows with crc32(doc_id as text) mod 3 = 1. Only the text is an input of a score.

    Result, one row per input row: `doc_id`, `held_out`, `score` (0 to 1), `predicted` (1 from 0.7). Null and empty texts
    get the score of no evidence; without labels every score is 0.5. Repeated rows get equal scores, rows with a null doc_id are
    scored and not held out. No rows give no rows; other columns are not used.
    """
    texts, toxic = sample(docs, labels)
    table, bias = train(texts, toxic) if len(set(toxic.tolist())) == 2 else (np.zeros(BUCKETS, np.float32), 0.0)
    told = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", held_out("doc_id").alias("held_out"))
    scored = told.mapInArrow(partial(_scored, table=table, bias=bias), "doc_id bigint, held_out boolean, score double")
    return scored.withColumn("predicted", F.when(F.col("score") >= THRESHOLD, 1).otherwise(0))
