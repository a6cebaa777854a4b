"""Documents to packed training sequences: each stage is one operator, written and read again."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.llm import lines, minhash, mixing, packing, quality
from tidewell.session import settled

# A repeated line of so many words goes alone, as a repeated window of op7 does.
LINE_WORDS = 13


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or are far from their language go.

    Rows are matched by id and text. Null ids and texts are matched like any other; an empty table stays empty.
    """
    found = quality.rate(docs).where("kept").select(F.col("doc_id").alias("kept_id"), F.col("text_hash").alias("kept_hash")).distinct()
    same_text = F.xxhash64(F.coalesce(docs["text"], F.lit(""))) == found["kept_hash"]
    return docs.join(found, docs["doc_id"].eqNullSafe(found["kept_id"]) & same_text, "left_semi")


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of repeated line runs, and of single lines of `LINE_WORDS` words or more, are cut; a document that loses all its lines goes. `n_chars` follows the text."""
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    found = lines.repeated_lines(docs, carry=tuple(others), min_words=LINE_WORDS).where("n_removed = 0 or n_lines > n_removed")
    kept = {c: F.col(f"rest.`{c}`") for c in others} | {"doc_id": F.col("doc_id").cast(docs.schema["doc_id"].dataType), "text": F.col("text")}
    if "n_chars" in others:
        kept["n_chars"] = F.when(F.col("n_removed") > 0, F.char_length("text").cast(docs.schema["n_chars"].dataType)).otherwise(kept["n_chars"])
    return found.select(*[kept[c].alias(c) for c in docs.columns])


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class stays, that with the smallest id (five words, similarity 0.8).

    Rows that share a doc_id are one document here and go together; rows without an id stay.
    """
    classes = minhash.near_duplicates(docs, k=5, percent=80).where("not kept").select(F.col("doc_id").alias("dropped_id")).distinct()
    return docs.join(classes, docs["doc_id"] == classes["dropped_id"], "left_anti")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document at least once; documents of small sources are repeated until the sources have their weights."""
    others = [c for c in docs.columns if c not in ("doc_id", "source", "text")]
    # Columns of other names ride along, whatever they are called.
    found = mixing.mix(docs.select("doc_id", "source", "text", F.struct(F.lit(0).alias("none"), *others).alias("others")))
    read = found.where("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return read.select(*[F.col(f"others.`{c}`").alias(c) if c in others else F.col(c) for c in docs.columns])


def best_fit(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents and their places in sequences of at most 2048 tokens."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality_rules", quality_rules), ("line_dedup", line_dedup), ("near_dedup", near_dedup), ("mix_sources", mix_sources), ("best_fit_packing", best_fit),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole `documents` table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = settled(stage(spark, docs, sf_dir), name)
    return docs
