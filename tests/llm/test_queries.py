"""The registered queries over the smallest tables, against their SQL, and what no SQL can tell."""

import zlib

import pytest

from __spark_entry__ import oracle_sql, queries
from oracle import compare, connect
from tidewell.llm.queries import QUERIES

TABLES = "/root/testdata/sf0.001"
COLUMNS = {
    "op1": ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"],
    "op2": ["doc_id", "held_out", "score", "predicted"],
    "op6": ["doc_id", "n_shingles", "component_id", "kept"],
    "op7": ["doc_id", "n_words", "n_removed", "kept_sha256"],
    "op8": ["doc_id", "keep_id", "group_size", "kept", "text_sha256"],
    "op9": ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
    "op10": ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"],
}


@pytest.mark.parametrize("name", [*QUERIES, "pipeline"])
def test_query(spark, name):
    assert name in queries()
    assert compare(spark, connect(TABLES), queries()[name], oracle_sql().get(name), TABLES) is None


@pytest.mark.parametrize("key", COLUMNS)
def test_columns(spark, key):
    name = next(n for n in QUERIES if n.startswith(f"{key}_"))
    found = QUERIES[name](spark, TABLES)
    assert found.columns[: len(COLUMNS[key])] == COLUMNS[key]


def test_held_out_accuracy(spark):
    """Learnt from the labels that are not held out, over tables of ten times the size."""
    folder = "/root/testdata/sf0.1"
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    rows = [r for r in QUERIES["op2_toxicity"](spark, folder).collect() if r["doc_id"] in labels]
    held = [r for r in rows if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows)
    toxic = sorted(r["score"] for r in held if labels[r["doc_id"]])
    clean = sorted(r["score"] for r in held if not labels[r["doc_id"]])
    above = sum(t > c for t in toxic for c in clean) / (len(toxic) * len(clean))
    assert above > 0.93
    assert sum(s >= 0.7 for s in clean) < 0.04 * len(clean)
