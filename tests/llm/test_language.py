"""Language identification against a plain-Python naive Bayes and on held-out documents."""

import math
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

import corpus
from fixtures import docs, empty, odd, pairs  # noqa: F401
from tidewell.llm import language, queries

TABLES = "/root/testdata/sf0.01"


def grams(text: str | None) -> list[str]:
    """Lower-cased letters, one space for a run of anything else, a space in front and one behind the last word."""
    out = " "
    for c in (text or "").lower():
        if c.isalpha():
            out += c
        elif out[-1] != " ":
            out += " "
    out += "" if out[-1] == " " else " "
    return [g for n in language.GRAMS for g in (out[i : i + n] for i in range(len(out) - n + 1)) if g.strip()]


def bucket_of(gram: str, buckets: int) -> int:
    value = 0
    for c in gram:
        value = (value * int(language.LEFT) + ord(c) + 1) % (1 << 64)
    value = (value ^ (value >> 29)) * 0x94D049BB133111EB % (1 << 64)
    return value >> (65 - buckets.bit_length())


def test_grams():
    texts = ["Ab, c!", None, "", " 42 ", "Éa b", "x", "İ  ß\n", "a" * 9]
    found, starts, letters = language.gram_buckets(texts, 1 << 16)
    for i, text in enumerate(texts):
        mine = Counter(int(b) for bucket in found for b in bucket[starts[i] : starts[i + 1]] if b < 1 << 16)
        assert mine == Counter(bucket_of(g, 1 << 16) for g in grams(text))
        assert letters[i] == sum(c.isalpha() for c in (text or "").lower())


def test_scores_are_those_of_naive_bayes(docs, pairs):
    rows = corpus.rows()
    known = [r for r in rows if r[2] is not None and zlib.crc32(str(r[0]).encode()) % 5]
    buckets = language.MOST_BUCKETS
    counts = {lang: Counter(bucket_of(g, buckets) for r in known if r[2] == lang for g in grams(r[1])) for lang in sorted({r[2] for r in known})}
    prior = Counter(r[2] for r in known)
    got = {r.doc_id: r for r in language.identify(docs).collect()}
    assert len(got) == len(rows)
    for doc_id, text in pairs[:40] + pairs[-15:]:
        joint = {lang: math.log(prior[lang] / len(known)) + sum(
            math.log((c[bucket_of(g, buckets)] + language.ALPHA) / (c.total() + language.ALPHA * buckets)) for g in grams(text)) for lang, c in counts.items()}
        row = got[doc_id]
        assert row.held_out == (zlib.crc32(str(doc_id).encode()) % 5 == 0)
        if not any(c.isalpha() for c in text or ""):
            assert (row.lang_pred, row.score) == ("und", 0.0)
            continue
        top = max(joint.values())
        assert joint[row.lang_pred] > top - 1e-2 - 1e-5 * abs(top)
        assert abs(row.score - 1 / sum(math.exp(j - top) for j in joint.values())) < 0.02


def test_held_out_accuracy(spark):
    truth = {r.doc_id: (r.lang, r.text) for r in spark.read.parquet(f"{TABLES}/documents.parquet").collect()}
    rows = queries.op12_language_id(spark, TABLES).collect()
    assert len(rows) == len(truth)
    held = [r for r in rows if r.held_out and r.lang_pred != "und"]
    assert len(held) > 150
    assert sum(r.lang_pred == truth[r.doc_id][0] for r in held) > 0.97 * len(held)
    assert all(r.lang_pred in {"en", "de", "fr", "es", "und"} and 0 <= r.score <= 1 for r in rows)


def test_few_rows_of_each_language_are_learnt_from(spark):
    rows = [(i, "alpha beta" if i % 2 else "gamma delta", "l" if i % 2 else "r") for i in range(4000)]
    names, table, priors = language.train(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"), rows=100)
    assert names == ["l", "r"] and np.allclose(np.exp(priors), 0.5) and not table[:, -1].any()
    learnt = np.exp(table[0, :-1]).max() / np.exp(table[0, :-1]).min() * language.ALPHA
    assert 2 * 60 < learnt < 2 * 140


def test_many_languages_share_fewer_buckets(spark):
    rows = [(i, f"{chr(97 + i % 26) * 3} {chr(97 + i // 26) * 3}", f"l{i}") for i in range(200)]
    names, table, _ = language.train(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"))
    assert len(names) == 200 and table.shape == (200, (1 << 14) + 1)


def test_empty_odd_and_unlabelled(empty, odd, docs, spark):
    assert language.identify(empty).collect() == []
    told = language.identify(odd)
    assert told.count() == odd.count()
    assert not any(r.held_out for r in told.where("doc_id is null").collect())
    rows = language.identify(docs.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {(r.lang_pred, r.score) for r in rows} == {("und", 0.0)}
