"""Language of a text: multinomial naive Bayes over hashed character n-grams, counted in tasks and scored in numpy."""

from __future__ import annotations

import sys
from collections.abc import Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.llm.shared import LEFT, by_bytes

# Lengths of the character n-grams; a run of anything but letters is one space, which belongs to the words on either side.
GRAMS = (2, 3, 4)
# Cells of the matrix of log probabilities (languages x buckets); with many languages there are fewer buckets.
CELLS, MOST_BUCKETS, LEAST_BUCKETS = 1 << 22, 1 << 16, 1 << 10
# Rows of a language that are learnt from, in expectation: those with the smallest hashes of their id.
TRAIN_ROWS = 5000
# Added to every count.
ALPHA = 0.5
UNKNOWN = "und"
SLICE_CHARS = 1 << 20
SPACE = np.uint32(32)


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1)


def gram_buckets(texts: list[str | None], buckets: int) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """For each n-gram length the bucket at each character of the joined texts, `buckets` where none begins; the offset of each text; its letters.

    Letters are lower-cased. An n-gram has a letter and lies within one text, with a space on either end of it.
    """
    lowered = [(t or "").lower() for t in texts]
    codes = np.frombuffer((" " + "  ".join(lowered) + " ").encode("utf-32-le", "surrogatepass"), np.uint32)
    first = np.concatenate([[0], np.cumsum([len(t) + 2 for t in lowered])])
    letter = _letters()[codes]
    # Only the first and the last space of a run stay: the former ends a word, the latter begins one, and two meet between texts.
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    keep[first[:-1]] = True
    seen = np.concatenate([[0], np.cumsum(keep)])
    letters = np.concatenate([[0], np.cumsum(letter)])
    codes, letter = np.where(letter, codes, SPACE)[keep], letter[keep]
    starts = seen[first]
    text_of = np.repeat(np.arange(len(texts)), np.diff(starts))
    shift = np.uint64(65 - buckets.bit_length())
    out, rolled, some = [], codes.astype(np.uint64) + np.uint64(1), letter
    value = rolled
    for n in range(2, max(GRAMS) + 1):
        rolled = rolled[:-1] * LEFT + value[n - 1 :]
        some = some[:-1] | letter[n - 1 :]
        if n in GRAMS:
            bucket = np.full(len(codes), buckets, np.int32)
            inside = some & (text_of[: len(rolled)] == text_of[n - 1 :])
            spread = (rolled ^ (rolled >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
            bucket[: len(rolled)] = np.where(inside, spread >> shift, buckets)
            out.append(bucket)
    return out, starts, np.diff(letters[first])


def _counted(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    """N-grams of each language in a partition, by bucket; a partition holds one row of counts per language it has."""
    counts: dict[int, np.ndarray] = {}
    for batch in batches:
        order = np.argsort(batch["code"].to_numpy(), kind="stable")
        batch = batch.take(pa.array(order))
        codes = batch["code"].to_numpy()
        edges = np.append(np.flatnonzero(np.diff(codes, prepend=-1)), len(codes))
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            have = counts.setdefault(int(codes[a]), np.zeros(buckets + 1, np.int64))
            for _, texts in by_bytes(list(range(a, b)), batch["text"].slice(a, b - a).to_pylist(), SLICE_CHARS):
                for bucket in gram_buckets(texts, buckets)[0]:
                    have += np.bincount(bucket, minlength=buckets + 1)
    for code, have in counts.items():
        at = np.flatnonzero(have[:buckets])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(at), code), pa.int32()), pa.array(at, pa.int32()), pa.array(have[at], pa.int64())], names=["code", "bucket", "n"])


def log_joint(texts: list[str | None], table: np.ndarray, priors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log of prior and likelihood of each text (rows) in each language (columns), and the number of letters of each text.

    `table` has a row of log probabilities per language, and a last column of zeros for places without an n-gram.
    """
    grams, starts, letters = gram_buckets(texts, table.shape[1] - 1)
    out = np.tile(priors, (len(texts), 1))
    for bucket in grams:
        for code, row in enumerate(table):
            out[:, code] += np.add.reduceat(row[bucket], starts[:-1], dtype=np.float64)
    return out, letters


def _told(batches: Iterator[pa.RecordBatch], names: list[str], table: np.ndarray, priors: np.ndarray) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rows, texts in by_bytes(list(range(len(batch))), batch["text"].to_pylist(), SLICE_CHARS):
            at = pa.array(rows)
            found, score = [UNKNOWN] * len(rows), np.zeros(len(rows))
            if names:
                joint, letters = log_joint(texts, table, priors)
                best = joint.argmax(1)
                odds = 1 / np.exp(joint - joint.max(1, keepdims=True)).sum(1)
                found = [names[b] if n else UNKNOWN for b, n in zip(best.tolist(), letters.tolist(), strict=True)]
                score = np.where(letters > 0, odds, 0.0)
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"].take(at), batch["held_out"].take(at), pa.array(found, pa.string()), pa.array(score, pa.float64())],
                names=["doc_id", "held_out", "lang_pred", "score"])


def remainder(doc_id: str, folds: int) -> Column:
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % folds


def train(known: DataFrame, rows: int = TRAIN_ROWS) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Languages in order, log probabilities (languages x buckets, and a column of zeros) and log priors, from `known (doc_id, text, lang)`.

    Priors count all rows; n-grams those of about `rows` rows of each language, by a hash of the id. Only counts reach the driver.
    """
    spark = known.sparkSession
    sizes = known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy("lang").limit(CELLS // LEAST_BUCKETS + 1).collect()
    if len(sizes) > CELLS // LEAST_BUCKETS:
        raise ValueError(f"more than {CELLS // LEAST_BUCKETS} languages")
    if not sizes:
        return [], np.zeros((0, 1), np.float32), np.zeros(0)
    buckets = min(MOST_BUCKETS, 1 << ((CELLS // len(sizes)).bit_length() - 1))
    share = [(r["lang"], code, min(1.0, rows / r["n"])) for code, r in enumerate(sizes)]
    # As many rows as languages.
    chosen = F.broadcast(spark.createDataFrame(share, "learnt string, code int, share double"))
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) / float(1 << 20)
    texts = known.join(chosen, F.col("lang") == F.col("learnt")).where(place < F.col("share")).select("code", "text")
    found = texts.mapInArrow(partial(_counted, buckets=buckets), "code int, bucket int, n bigint").groupBy("code", "bucket").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros((len(sizes), buckets))
    counts[found["code"].to_numpy(), found["bucket"].to_numpy()] = found["n"].to_numpy()
    table = np.zeros((len(sizes), buckets + 1), np.float32)
    table[:, :buckets] = np.log((counts + ALPHA) / (counts.sum(1, keepdims=True) + ALPHA * buckets))
    totals = np.array([r["n"] for r in sizes], np.float64)
    return [r["lang"] for r in sizes], table, np.log(totals / totals.sum())


def identify(docs: DataFrame, folds: int = 5) -> DataFrame:
    """Language of every whole text of `docs (doc_id, text, lang)`, learnt from rows whose crc32(doc_id as text) mod `folds` is not 0.

    Result, one row per input row: `doc_id`, `held_out` (that remainder is 0), `lang_pred`, `score` (posterior probability, 0 to 1). Only the text is an
    input of a prediction. A null text, a text without a letter, and any text where nothing was learnt is `und` with score 0. Of equally
    likely languages the first by name is told. Rows with a null doc_id are told, neither held out nor learnt from; rows with a null lang are told and
    not learnt from. Repeated rows get equal results, and no rows give no rows. Other columns are not used.
    """
    known = docs.where(remainder("doc_id", folds) != 0).where("lang is not null").select("doc_id", "text", "lang")
    names, table, priors = train(known)
    held = F.coalesce(remainder("doc_id", folds) == 0, F.lit(False))
    asked = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", held.alias("held_out"))
    return asked.mapInArrow(partial(_told, names=names, table=table, priors=priors), "doc_id bigint, held_out boolean, lang_pred string, score double")
