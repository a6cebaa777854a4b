"""Exact, near, window and line duplicates against plain Python."""

import numpy as np
import pytest

import corpus
import corpus_pipeline
from fixtures import docs, empty, odd, pairs  # noqa: F401
from tidewell.llm import exact, lines, minhash, shared, substrings


@pytest.mark.parametrize("block_docs", [minhash.BLOCK_DOCS, 2])
@pytest.mark.parametrize(("k", "percent"), [(3, 85), (5, 80)])
def test_near_duplicates(docs, pairs, monkeypatch, block_docs, k, percent):
    monkeypatch.setattr(minhash, "BLOCK_DOCS", block_docs)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_duplicates(docs, k, percent).collect()}
    assert got == corpus.near(pairs, k, percent)


def test_a_family_of_many_near_copies_is_one_class(spark, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK_DOCS", 16)
    base = [f"w{i}" for i in range(120)]
    rows = [(j, " ".join([*base[:j], f"x{j}", *base[j + 1 :]])) for j in range(90)]
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string"), 3, 85).collect()
    assert {r.component_id for r in got} == {0}
    assert sum(r.kept for r in got) == 1


def test_signature_places_agree_as_often_as_the_sets():
    rng = np.random.default_rng(1)
    pool = rng.integers(0, 1 << 63, 1500).astype(np.uint64)
    left, right = np.unique(pool[:1000]), np.unique(pool[500:])
    out = minhash.superminhash(np.concatenate([left, right]), np.array([0, len(left), len(left) + len(right)]), 2000)
    assert abs((out[0] == out[1]).mean() - 1 / 3) < 0.04
    assert (minhash.superminhash(pool[:1], np.array([0, 1]), 128) < np.iinfo(np.uint32).max).all()


def test_windows(docs, pairs):
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in substrings.repeated_windows(docs, 13).collect()}
    assert got == corpus.windows(pairs, 13)


def test_longest_window_is_found_by_doubling(spark):
    words = [f"w{i}" for i in range(100)]
    rows = [(1, " ".join(words)), (2, "a b " + " ".join(words[:60])), (3, "c d e")]
    got = {r.doc_id: (r.longest, r.spans, r.kept_text) for r in substrings.repeated_windows(spark.createDataFrame(rows, "doc_id bigint, text string"), 13).collect()}
    assert [got[i][0] for i in (1, 2, 3)] == [52, 52, 0]
    assert [(s.start, s.end) for s in got[2][1]] == [(2, 62)]
    assert got[2][2] == "a b"


def test_null_text_on_a_repeated_id(spark):
    text = " ".join(f"w{i}" for i in range(20))
    rows = [(3, text), (5, None), (5, f"{text} x"), (5, f"{text} x"), (None, text), (5, "")]
    got = sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept_sha256) for r in substrings.repeated_windows(spark.createDataFrame(rows, "doc_id bigint, text string"), 13).collect())
    none, whole = corpus.sha(b""), corpus.sha(text.encode())
    assert got == sorted([("3", 20, 0, whole), ("5", 0, 0, none), ("5", 0, 0, none), *[("5", 21, 20, corpus.sha(b"x"))] * 2, ("None", 20, 0, whole)])


def test_long_texts_are_hashed_in_parts(monkeypatch):
    text = "  " + " ".join(f"word{i % 97}" for i in range(5000)) + "\n"
    whole, at = shared.word_hashes([text, None, "word1"])
    monkeypatch.setattr(shared, "PART_BYTES", 64)
    parts, at_parts = shared.word_hashes([text, None, "word1"])
    assert (whole == parts).all() and (at == at_parts).all() and at.tolist() == [0, 5000, 5000, 5001]
    assert whole[1] == whole[5000] and len(set(whole.tolist())) == 97


@pytest.mark.parametrize(("block", "bits"), [(exact.BLOCK, 64), (16, 64), (16, 3)])
def test_exact_duplicates(docs, pairs, block, bits):
    got = {r.doc_id: (r.keep_id, r.group_size, r.kept, r.text_sha256) for r in exact.exact_duplicates(docs, block, bits).collect()}
    assert got == corpus.equal_texts(pairs)


@pytest.mark.parametrize("n", [1, 2, 3, 5])
def test_line_runs(docs, pairs, n):
    got = {r.doc_id: (r.n_lines, r.n_removed, r.kept_sha256) for r in lines.repeated_lines(docs, n).collect()}
    assert got == corpus.line_runs(pairs, n)


def test_long_lines_go_whatever_their_neighbours_are(spark):
    long, short = " \t".join(f"w{i}" for i in range(13)) + " ", " ".join(f"v{i}" for i in range(12))
    texts = [f"a\n{long}\nb", f"c\n{long}\n\nd", long, f"{short}\ne", f"f\n{short}", f"c\n{long}", f"{long}\n{long}", f" {long}"]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r.doc_id: (r.n_lines, r.n_removed, r.text) for r in lines.repeated_lines(frame, min_words=13).collect()}
    assert got == {
        0: (3, 0, texts[0]), 1: (3, 1, "c\n\nd"), 2: (1, 1, ""), 3: (2, 0, texts[3]), 4: (2, 0, texts[4]), 5: (2, 2, ""), 6: (2, 2, ""), 7: (1, 0, texts[7])}
    stage = {r.doc_id for r in corpus_pipeline.line_dedup(spark, frame, "").collect()}
    assert stage == {0, 1, 3, 4, 7}


def test_suffix_ranks_order_the_suffixes(spark):
    text = "a\nb\na\nb\na\nc"
    held = spark.createDataFrame([(0, i, 6, ord(c), 0) for i, c in enumerate(text.split("\n"))], "row bigint, pos bigint, n bigint, h1 bigint, h2 bigint")
    levels = lines.suffix_ranks(held, 8)
    assert [h for h, _ in levels] == [1, 2]
    ranks = {r.pos: r.rank for r in levels[0][1].collect()}
    assert ranks[0] == ranks[2] == ranks[4] < ranks[1] == ranks[3]


OPERATORS = {
    "near": lambda d: minhash.near_duplicates(d, 3, 85),
    "windows": lambda d: substrings.repeated_windows(d, 13),
    "exact": exact.exact_duplicates,
    "lines": lines.repeated_lines,
}


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_and_odd_rows(odd, empty, name):
    assert OPERATORS[name](empty).count() == 0
    assert OPERATORS[name](odd).count() == odd.count()


def test_rows_without_an_id(odd):
    near = minhash.near_duplicates(odd, 3, 85).where("doc_id is null").collect()
    assert all(r.component_id is None and r.kept for r in near)
    assert all(r.n_removed == 0 for r in substrings.repeated_windows(odd, 13).where("doc_id is null").collect())
    same = exact.exact_duplicates(odd).where("doc_id is null").collect()
    assert not any(r.kept for r in same) and all(r.keep_id is not None for r in same)


def test_components(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (103, 101), (7, 7), (200, 200)], "a bigint, b bigint")
    got = {r.id: r.component for r in shared.components(edges).collect()}
    assert got == {i: 0 for i in range(41)} | {100: 100, 101: 100, 103: 100}


def test_id_filter_keeps_every_id(spark):
    ids = [0, 1, -5, 1 << 40, 77]
    bitmap = shared.id_filter(spark.createDataFrame([(i,) for i in ids], "doc_id bigint"), "doc_id")
    assert all(shared.in_filter(bitmap, ids)) and sum(shared.in_filter(bitmap, list(range(1000, 2000)))) < 10


@pytest.fixture
def files_of(spark, monkeypatch):
    """The most files of an intermediate by purpose, with many shuffle partitions that nobody joins."""
    found, settled = {}, shared.settled

    def counted(df, purpose):
        table = settled(df, purpose)
        found[purpose] = max(found.get(purpose, 0), len(table.inputFiles()))
        return table

    monkeypatch.setattr(shared, "settled", counted)
    settings = {"spark.sql.shuffle.partitions": "32", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield found
    for k, v in before.items():
        spark.conf.set(k, v)


def test_small_tables_of_near_dedup_are_one_file(spark, files_of):
    rows = [(100 * g + j, " ".join([f"g{g}w{i}" for i in range(40)] + [f"x{j}"])) for g in range(40) for j in range(3)]
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string"), 3, 85).collect()
    assert sorted((r.doc_id, r.component_id) for r in got) == [(d, d // 100 * 100) for d, _ in rows]
    assert {k: files_of[k] for k in ("classes", "stars", "edges", "families", "members")} == dict.fromkeys(("classes", "stars", "edges", "families", "members"), 1)


def test_small_tables_of_line_dedup_are_one_file(spark, files_of):
    rows = [(2 * g + c, f"own {2 * g + c}\nfirst of {g}\nsecond of {g}") for g in range(100) for c in (0, 1)]
    got = lines.repeated_lines(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert {r.doc_id: r.n_removed for r in got} == {d: 2 * (d % 2) for d, _ in rows}
    assert {k: files_of[k] for k in ("pairs", "members", "later")} == {"pairs": 1, "members": 1, "later": 1}
