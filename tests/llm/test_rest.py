"""Archives, toxicity, mixing, licences, packing, quality and the pipeline."""

import base64
import gzip
import hashlib
import math
import textwrap
import zlib
from collections import defaultdict
from math import log

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus
import corpus_pipeline
from fixtures import docs, empty, odd, pairs  # noqa: F401
from tidewell.llm import licenses, mixing, packing, quality, shared, toxicity, warc
from tidewell.session import shared_folder

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
PAGES = "page_id bigint, url string, html string, payload_bytes string, first_id string, archive string"


def pages():
    long = "ä<p>\r\n\r\nWARC/1.1\r\n" * 20_000
    bodies = ["<a>", "", None, "<a>", long, "é\r\n\r\n", "x", long, ""]
    return [(i * 7 % 10, None if i == 2 else f"http://h/{i} a\r\nb", b, "p", "f", "a") for i, b in enumerate(bodies)]


def test_archives(spark):
    frame = spark.createDataFrame(pages(), PAGES)
    folder, out = shared_folder(spark, "warc"), shared_folder(spark, "members")
    warc.write_monolithic(frame.coalesce(2), folder)
    index = warc.normalise(spark, folder, out)
    got = {r.page_id: r for r in warc.read_records(index).collect()}
    firsts = {}
    for page, _, body, *_ in sorted(pages()):
        firsts.setdefault(body or "", page)
    for page, _, body, *_ in pages():
        data, first = (body or "").encode(), firsts[body or ""]
        r = got[page]
        assert (r.payload_bytes, r.payload_digest) == (len(data), base64.b32encode(hashlib.sha1(data).digest()).decode())
        assert (r.record_type, r.refers_to) == (("response", None) if page == first else ("revisit", first))
        assert bytes(r.payload) == (data if page == first else b"")
    entries = defaultdict(list)
    for r in index.collect():
        entries[r.archive].append((r.offset, r.length))
    for archive, members in entries.items():
        data = open(archive.removeprefix("file:"), "rb").read()
        whole = b"".join(zlib.decompress(data[o : o + n], 31) for o, n in sorted(members))
        assert whole == gzip.decompress(data) and whole.count(b"\r\n\r\nWARC/1.1\r\nWARC-Type") == len(members) - 1
        assert sum(n for _, n in members) == len(data)
    again = warc.normalise(spark, out, shared_folder(spark, "again"))
    assert sorted((r.record_id, r.length) for r in again.collect()) == sorted((r.record_id, r.length) for r in index.collect())


def test_archives_min_bytes_and_odd_rows(spark):
    frame = spark.createDataFrame([(None, "u", "x", "", "", ""), (1, "u", "x", "", "", ""), (1, "u", "x", "", "", ""), (2, "u", "x", "", "", ""), (3, "u", None, "", "", ""), (4, "u", "", "", "", "")], PAGES)
    folder = shared_folder(spark, "warc")
    warc.write_monolithic(frame, folder, min_bytes=1)
    got = warc.read_records(warc.normalise(spark, folder, shared_folder(spark, "members"))).collect()
    assert sorted((r.page_id or 0, r.record_type) for r in got) == [(0, "revisit"), (1, "response"), (1, "response"), (2, "revisit"), (3, "response"), (4, "response")]
    folder = shared_folder(spark, "warc")
    warc.write_monolithic(frame.limit(0), folder)
    assert warc.read_records(warc.normalise(spark, folder, shared_folder(spark, "members"))).count() == 0


def test_damaged_archives_fail():
    with pytest.raises(ValueError):
        list(warc.records(iter([b"WARC/1.1\r\nContent-Length: 9\r\n\r\nabc"])))
    with pytest.raises(ValueError):
        list(warc.records(iter([b"HTTP/1.1\r\nContent-Length: 0\r\n\r\n\r\n\r\n"])))


def toxic_corpus(spark, n=900):
    rng = np.random.default_rng(5)
    syllables = ["ta", "re", "mo", "li", "ne", "so", "ka", "du"]
    def word():
        return "".join(rng.choice(syllables, rng.integers(1, 4)))
    docs, labels = [], []
    for i in range(n):
        text = [word() for _ in range(rng.integers(5, 80))]
        bad = i % 4 == 0
        for _ in range(1 + len(text) // 15 if bad else 0):
            text[rng.integers(0, len(text))] = "vex" + word() + "zor"
        docs.append((i, " ".join(text), "l", 7))
        labels.append((i, 1, int(bad)))
    return spark.createDataFrame(docs, "doc_id bigint, text string, score string, label_id bigint"), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")


def test_toxicity_of_held_out_rows(spark):
    docs, labels = toxic_corpus(spark)
    got = toxicity.toxicity(docs, labels).join(labels, "doc_id").collect()
    held = [r for r in got if r.held_out]
    assert 200 < len(held) < 400 and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    assert sum((r.score > 0.5) == bool(r.toxic) for r in held) / len(held) > 0.95
    flipped = labels.withColumn("toxic", F.when(toxicity.held_out("doc_id"), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert {r.doc_id: r.score for r in toxicity.toxicity(docs, flipped).collect()} == {r.doc_id: r.score for r in got}
    assert all(r.predicted == int(r.score >= 0.7) for r in got)


def test_toxicity_of_odd_rows(spark, odd, empty):
    docs, labels = toxic_corpus(spark, 60)
    assert toxicity.toxicity(empty, labels).count() == 0
    assert {r.score for r in toxicity.toxicity(odd, labels.limit(0)).collect()} == {0.5}
    got = toxicity.toxicity(odd, labels).collect()
    assert len(got) == odd.count() and all(0 <= r.score <= 1 and r.held_out is not None for r in got)
    blank = toxicity.score([None, "", " \n", "x" * 100_000], np.ones(toxicity.BUCKETS, np.float32), 0.0)
    assert blank[0] == blank[1] == blank[2] == 0.5 < blank[3]


def test_damped_words():
    assert sorted(toxicity.damped("A a a a b\tc").split()) == ["a", "a", "b", "c"]


def test_mixture_weights_and_copies(docs, spark):
    got = mixing.mix(docs, entropy_share=0.99, max_repeats=3.0).collect()
    assert len(got) == docs.count()
    tokens, read, epochs = defaultdict(int), defaultdict(int), {}
    for r in got:
        tokens[r.source] += r.n_tokens
        read[r.source] += r.n_tokens * r.copies
        epochs[r.source] = r.epochs
        assert r.n_tokens == len(corpus.words(r.text)) and r.copies in (int(r.epochs), int(r.epochs) + 1) and 0 <= r.mix_key < 1
    longest = max(r.n_tokens for r in got)
    for s in tokens:
        assert 1 <= epochs[s] <= 3 and 0 <= tokens[s] * epochs[s] - read[s] <= longest
    assert epochs[max(tokens, key=tokens.get)] == 1.0
    share = [tokens[s] * epochs[s] / sum(tokens[x] * epochs[x] for x in tokens) for s in tokens]
    assert max(epochs.values()) > 2.99 or abs(-sum(p * log(p) for p in share) / log(len(share)) - 0.99) < 1e-3


def test_mixture_follows_its_permutations(spark):
    rows = [(i, "a" if i % 5 else "b", "w " * (1 + i % 9)) for i in range(2000)]
    frame = spark.createDataFrame(rows, "doc_id bigint, source string, text string")
    got = mixing.mix(frame, entropy_share=0.9, max_repeats=10.0, budget=4000).select("*", *[
        F.xxhash64(F.lit(7), F.col("doc_id")).alias("h"), F.xxhash64(F.lit(9), F.col("doc_id")).alias("o")]).collect()
    told = spark.createDataFrame([(b,) for b in range(1024)], "b bigint").select("b", F.xxhash64(F.lit(8), F.col("b")).alias("k")).collect()
    order = {r.b: r.k for r in told}
    for source in "ab":
        own = [r for r in got if r.source == source]
        budget = (own[0].epochs - int(own[0].epochs)) * sum(r.n_tokens for r in own)
        blocks = defaultdict(list)
        for r in own:
            blocks[(order[r.h % 1024], r.h % 1024, order[(r.h >> 20) % 1024], (r.h >> 20) % 1024)].append(r)
        spent = 0
        for key in sorted(blocks):
            part = sorted(blocks[key], key=lambda r: (r.o, r.doc_id))
            for r in part:
                spent += r.n_tokens
                assert r.copies - int(r.epochs) == int(spent <= budget), (source, r.doc_id)
    assert 3900 <= sum(r.n_tokens * r.copies for r in got) <= 4000


def test_mixture_of_odd_rows(odd, empty, spark):
    assert mixing.mix(empty).count() == 0
    assert mixing.mix(odd).count() == odd.count()
    blank = spark.createDataFrame([(1, None, None), (2, "s", ""), (3, "s", None)], "doc_id bigint, source string, text string")
    assert [r.copies for r in mixing.mix(blank).collect()] == [1, 1, 1]


def test_licences(spark, empty, odd):
    text = "x\nLICENSED under the Apache License (Version 2.0)\nreleased under the MIT license\n"
    docs = spark.createDataFrame([(1, text), (2, None), (3, ""), (4, "one"), (5, "nothing to see in this line of text"), (6, text + "word " * 30_000)], "doc_id bigint, text string")
    got = {r.doc_id: r for r in licenses.scan(docs).collect()}
    assert (got[1].licence, got[1].dice, got[1].line, got[1].n_statements) == ("Apache-2.0", 1.0, 2, 2)
    assert got[6].licence == "Apache-2.0" and all(got[i].licence is None and got[i].n_statements == 0 for i in (2, 3, 4, 5))
    assert licenses.scan(empty).count() == 0 and licenses.scan(odd).count() == odd.count()


def test_licence_texts_and_headers_over_lines(spark):
    def wrapped(text, width):
        return "\n".join(textwrap.wrap(text, width))

    def text(name):
        return (licenses.TEXTS / f"{name}.txt").read_text("utf-8")

    prose = "lorem ipsum of the dolor and the sit amet in this\n" * 30
    header = dict(reversed(licenses.HEADERS))
    cases = {
        1: ("MIT", "The MIT License (MIT)\n\nCopyright (c) 2020 Foo\n\n" + text("MIT")),
        2: ("MIT", prose + wrapped(text("MIT"), 40) + "\n" + prose),
        3: ("MIT", "before it. " + " ".join(text("MIT").split()) + " after it " * 50),
        4: ("BSD-3-Clause", "Copyright 2020 Foo\n" + text("BSD-3-Clause")),
        5: ("GPL-3.0", "\n".join(f" * {x}" for x in wrapped(header["GPL-3.0"], 60).split("\n"))),
        6: ("Apache-2.0", "\n".join(f"# {x}" for x in wrapped(header["Apache-2.0"], 76).split("\n")) + "\nimport os\n" + prose),
        7: ("GPL-2.0", text("GPL-2.0")),
        8: ("Proprietary", "Copyright 2020 Foo. All rights reserved."),
        9: ("MIT", "The MIT License (MIT)"),
        10: (None, prose),
        11: ("ISC", "this is it\n" + wrapped(text("ISC"), 30).replace("ALL", "")),
        12: ("GPL-3.0", text("GPL-3.0")),
        13: ("BSD-2-Clause", text("BSD-2-Clause")),
    }
    got = {r.doc_id: r for r in licenses.scan(spark.createDataFrame([(i, t) for i, (_, t) in cases.items()], "doc_id bigint, text string")).collect()}
    assert {i: r.licence for i, r in got.items()} == {i: name for i, (name, _) in cases.items()}
    assert (got[2].line, got[2].dice, got[2].n_statements) == (31, 1.0, 1) and got[3].dice > 0.99 and got[11].dice > 0.8


def test_best_run_of_words_is_found(spark):
    """Against every run of words in plain Python."""
    rng = np.random.default_rng(5)
    template = "a b c d e f a b g h"
    texts = ["\n".join(" ".join(rng.choice(list("abcdefghxy"), rng.integers(1, 6))) for _ in range(8)) + "\n" + x for x in ["a b c d", "", "x a b c\nd e q f a b\ng h", template] * 8]
    grams = licenses.bigrams(template)
    for row in licenses.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string"), [("T", template)], 0.5).collect():
        words = [(w, i) for i, line in enumerate(texts[row.doc_id].split("\n"), 1) for w in line.split()]
        best = max(2 * len(g & set(grams)) / (len(g) + len(grams)) for i in range(len(words)) for j in range(i + 2, len(words) + 1)
                   for g in [{f"{a} {b}" for (a, _), (b, _) in zip(words[i:j], words[i + 1 : j], strict=False)}])
        assert row.dice == (best if best >= 0.5 else None)


def brute_pieces(text, end=0, capacity=2048):
    ids = Tokenizer.from_file(VOCABULARY).encode(text or "", add_special_tokens=False).ids + [end]
    return [(k, a, len(ids[a : a + capacity]), zlib.crc32(np.array(ids[a : a + capacity], "<u4").tobytes())) for k, a in enumerate(range(0, len(ids), capacity))]


def check_packing(got, texts, capacity=2048):
    expected = defaultdict(list)
    for doc_id, text in texts:
        expected[doc_id] += brute_pieces(text, capacity=capacity)
    found, bins = defaultdict(list), defaultdict(list)
    for r in got:
        found[r.doc_id].append((r.piece, r.start, r.length, r.ids_crc32))
        bins[r.sequence_id].append((r.offset, r.length))
    assert {k: sorted(v) for k, v in found.items()} == {k: sorted(v) for k, v in expected.items()}
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins), sum(r.length for r in got)


@pytest.mark.parametrize(("capacity", "shard"), [(2048, 16_384), (64, 50)])
def test_packing(docs, pairs, capacity, shard):
    bins, total = check_packing(packing.pack(docs, VOCABULARY, capacity, shard=shard).collect(), pairs, capacity)
    assert bins <= -(-total // capacity) * 1.1 + 3


def test_packing_of_odd_rows(odd, empty):
    assert packing.pack(empty, VOCABULARY).count() == 0
    check_packing(packing.pack(odd, VOCABULARY).collect(), [(r.doc_id, r.text) for r in odd.collect()])


def test_local_search_empties_bins():
    # Best fit leaves four bins where three are enough.
    sizes = np.array([6, 5, 5, 4, 4, 3, 3])
    before = packing.best_fit(sizes, 10)
    squares = sum(f * f for f in before.fill)
    after = packing.local_search(before)
    assert sum(1 for f in after.fill if f) == 3 and sum(f * f for f in after.fill) >= squares
    rng = np.random.default_rng(2)
    for _ in range(5):
        sizes = rng.integers(200, 1100, 400)
        first = packing.best_fit(sizes, 2048)
        n = sum(1 for f in first.fill if f)
        bins = packing.local_search(first)
        assert sorted(i for b in bins.items for _, i in b) == list(range(400))
        assert all(sum(s for s, _ in b) == f <= 2048 for b, f in zip(bins.items, bins.fill, strict=True)) and sum(1 for f in bins.fill if f) <= n


def test_local_search_tries_all_bins():
    """Best fit, and partners among the fullest bins alone, leave 241 and 206 bins."""
    for low, high, most in ((600, 800, 235), (400, 900, 204)):
        first = packing.best_fit(np.random.default_rng(1).integers(low, high + 1, 600), 2048)
        before = sum(1 for f in first.fill if f)
        bins = packing.local_search(first)
        after = sum(1 for f in bins.fill if f)
        print(low, high, before, after, -(-sum(bins.fill) // 2048))
        assert after <= most and after < before
        # No step is left between any two bins.
        assert not any(
            packing._improve(bins, t, d) for _, d in list(bins.order) for _, t in list(bins.order) if t != d and bins.fill[t] >= bins.fill[d])


def test_words_are_tokenized_like_texts():
    texts = ["Don't <|endoftext|>x ΑΣ ΑΣΆ", "a b　c\x1cd\x85e", "İx ﬁ é 12ab", "", None, " \n"]
    tokenizer = Tokenizer.from_file(VOCABULARY)
    assert packing.token_bytes(texts, VOCABULARY) == [np.array(tokenizer.encode(t or "", add_special_tokens=False).ids, "<u4").tobytes() for t in texts]


def test_forms_of_a_word_are_tokenized_once(monkeypatch):
    texts = ["R\u00e9r\u00e9, r\u00e9r\u00e9. r\u00e9r\u00e9!!\nA$$$ a*** a", None, "", "a?! r\u00e9r\u00e9,", "it's x<| \u00d7. a."]
    asked, encoded = [], packing._encoded
    monkeypatch.setattr(packing, "_ids_of", {})
    monkeypatch.setattr(packing, "_encoded", lambda words, path: asked.extend(words) or encoded(words, path))
    tokenizer = Tokenizer.from_file(VOCABULARY)
    assert packing.token_bytes(texts, VOCABULARY) == [np.array(tokenizer.encode(t or "", add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert sorted(w for w in asked if w) == sorted(["r\u00e9r\u00e9", ",", ".", "!!", "$$$", "***", "a", "?!", "it's", "x<|", "\u00d7.", "a."])


@pytest.mark.parametrize("part", [40, 8 << 20])
def test_token_bytes_of_odd_texts(monkeypatch, part):
    monkeypatch.setattr(packing, "PART", part)
    rng = np.random.default_rng(5)
    marks = [*"aBz09\u00e9\u00df\u00c0\u00d7\u00f7\u00b5\u0130 \n\t\x1c\x85\xa0.,!'_|<>$", "'S", "<|EndOfText|>", "<|endoftext|>", ". ", "e\u0301", "\u03a3", "\u212a"]
    texts = [None, "<|EndOfText|> x", *("".join(rng.choice(marks, n)) for n in rng.integers(0, 15, 3000))]
    tokenizer = Tokenizer.from_file(VOCABULARY)
    assert packing.token_bytes(texts, VOCABULARY) == [np.array(tokenizer.encode(t or "", add_special_tokens=False).ids, "<u4").tobytes() for t in texts]


def test_base_rules(docs, pairs):
    got = {r.doc_id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in quality.rate(docs).collect()}
    assert got == {i: corpus.base_rules(t) for i, t in pairs}


def test_divergence(spark):
    rng = np.random.default_rng(4)
    def prose(n):
        return ". ".join(" ".join(rng.choice(["the", "of", "and", "house", "river", "walks", "green", "to"], 9)).capitalize() for _ in range(n))
    rows = [(i, prose(20 + i % 9), "en") for i in range(60)] + [(100, prose(30).upper().replace(" ", "!! "), "en"), (101, " | ".join(f"{i}%$#" for i in range(300)), "en")]
    got = {r.doc_id: r for r in quality.rate(spark.createDataFrame(rows, "doc_id bigint, text string, lang string")).collect()}
    assert all(not got[i].kept and got[i].class_distance > 0.19 for i in (100, 101))
    assert all(got[i].class_distance < 0.1 and got[i].kept != got[i].base_failed for i in range(60))
    check = got[5]
    assert 0 <= check.word_distance <= 1 and got[101].word_distance > check.word_distance


def test_distance(spark):
    frame = spark.createDataFrame([([1, 0], [0, 1]), ([2, 2], [4, 4]), ([0, 0], [1, 1]), ([1, 3], [3, 1])], "a array<bigint>, b array<bigint>")
    got = [r.d for r in frame.select(quality.distance("a", "b").alias("d")).collect()]
    p, q = np.array([0.25, 0.75]), np.array([0.75, 0.25])
    assert got[:3] == [1.0, 0.0, None] and abs(got[3] - np.sqrt((p * np.log2(p / 0.5) + q * np.log2(q / 0.5)).sum() / 2)) < 1e-12


def test_quality_of_odd_rows(odd, empty):
    assert quality.rate(empty).count() == 0
    assert quality.rate(odd).count() == odd.count()


def test_pipeline_stages(spark, docs):
    state = docs
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "line_dedup", "near_dedup", "mix_sources", "best_fit_packing"]
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        before = state
        state = corpus_pipeline.settled(stage(spark, before, ""), name)
        seen[name] = (before.collect(), state.collect())
        if name != names[-1]:
            assert state.columns == docs.columns and {r.copies for r in seen[name][1]} <= {"c"}
    rated = {r.doc_id: r.kept for r in quality.rate(docs).collect()}
    assert sorted(r.doc_id for r in seen["quality_rules"][1]) == sorted(i for i, k in rated.items() if k)
    before, after = seen["line_dedup"]
    brute = corpus.line_runs([(r.doc_id, r.text) for r in before], 2)
    assert {r.doc_id: corpus.sha(r.text.encode()) for r in after} == {i: h for i, (n, gone, h) in brute.items() if not gone or n > gone}
    before, after = seen["near_dedup"]
    brute = corpus.near([(r.doc_id, r.text) for r in before], 5, 80)
    assert sorted(r.doc_id for r in after) == sorted(i for i, (_, c) in brute.items() if i == c)
    before, after = seen["mix_sources"]
    copies = {r.doc_id: r.copies for r in mixing.mix(spark.createDataFrame(before, docs.schema)).collect()}
    assert sorted(r.doc_id for r in after) == sorted(i for i, c in copies.items() for _ in range(c))
    check_packing(seen["best_fit_packing"][1], [(r.doc_id, r.text) for r in after])


def test_pipeline_of_odd_and_no_rows(spark, odd, empty):
    for start in (odd, empty):
        state = start
        for name, stage in corpus_pipeline.STAGES:
            state = corpus_pipeline.settled(stage(spark, state, ""), name)
        assert state.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
        assert start is odd or state.count() == 0


def plain_score(text, table, bias):
    """The score of one text by the definition: shares of hashed n-grams of its damped words, times what each is worth."""
    counts = {}
    for word in (text or "").lower().split():
        counts[word] = counts.get(word, 0) + 1
    total = n = 0
    for word, times in counts.items():
        padded = f" {word} "
        for size in toxicity.GRAMS:
            for at in range(len(padded) - size + 1):
                value = 0
                for c in padded[at : at + size]:
                    value = (value * int(shared.LEFT) + ord(c) + 1) % (1 << 64)
                bucket = int(shared.mix(np.array([value], np.uint64))[0]) % toxicity.BUCKETS
                repeats = math.isqrt(times)
                total += repeats * float(table[bucket])
                n += repeats
    return 1 / (1 + math.exp(-(total / (toxicity.PRIOR + n) + bias)))


def test_toxicity_score_by_its_definition():
    rng = np.random.default_rng(8)
    table = rng.normal(0, 40, toxicity.BUCKETS).astype(np.float32)
    texts = ["You Fool you", "", None, "a bb ccc dddd", "same " * 30 + "other", "\u00dcber x"]
    assert np.allclose(toxicity.score(texts, table, 0.3), [plain_score(t, table, 0.3) for t in texts], atol=1e-9)


def test_toxicity_learns_from_one_text_per_label(spark):
    docs = spark.createDataFrame([(i % 4, f"text {i}") for i in range(40)], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(4)], "doc_id bigint, toxic int")
    texts, toxic = toxicity.sample(docs, labels)
    known = [i for i in range(4) if zlib.crc32(str(i).encode()) % 3 != 1]
    assert len(texts) == len(known) and toxic.tolist() == [i % 2 for i in known]
