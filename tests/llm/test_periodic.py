"""Runs of repeated words against plain Python."""

import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest

import corpus
from fixtures import docs, empty, odd, pairs  # noqa: F401
from tidewell.llm import periodic, queries


def smallest_period(words: list) -> int:
    """By the table of borders."""
    border = [0] * len(words)
    for i in range(1, len(words)):
        k = border[i - 1]
        while k and words[i] != words[k]:
            k = border[k - 1]
        border[i] = k + (words[i] == words[k])
    return len(words) - border[-1]


def runs(words: list) -> list[tuple[int, int, int]]:
    out = []
    for p in range(1, len(words) // 3 + 1):
        i = 0
        while i + p < len(words):
            j = i
            while j + p < len(words) and words[j] == words[j + p]:
                j += 1
            if j > i and j + p - i >= max(24, 3 * p) and smallest_period(words[i : j + p]) == p:
                out.append((i, j + p - i, p))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def brute(words: list[bytes]) -> tuple:
    found = runs(words)
    gone = {i for s, n, p in found for i in range(s + p, s + n)}
    best = max(found, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
    told = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    digest = hashlib.sha256("".join(f"{s},{n},{p}\n" for s, n, p in found).encode()).hexdigest()
    return len(found), *told, digest, corpus.sha(b" ".join(w for i, w in enumerate(words) if i not in gone))


def looped(doc_id: int, text: str | None) -> list[bytes]:
    words = corpus.words(text)
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def awkward() -> list[list[int]]:
    rng = random.Random(4)
    out = [[], [1], [1] * 23, [1] * 24, [1] * 200, [1, 2] * 40, [1, 2, 1] * 30, list(range(50)), [1, 1, 2] * 9, [5] * 30 + [6] * 30, list(range(8)) * 3, list(range(9)) * 3 + [0]]
    for _ in range(60):
        words = []
        while len(words) < rng.randint(1, 260):
            unit = [rng.randrange(3) for _ in range(rng.randint(1, 20))]
            words += unit * rng.randint(1, 6) + [rng.randrange(3) for _ in range(rng.randint(0, 4))]
        out.append(words)
    fib = [[1], [1, 2]]
    while len(fib[-1]) < 250:
        fib.append(fib[-1] + fib[-2])
    return [*out, fib[-1], fib[-1] * 3, *[[rng.randrange(2) for _ in range(300)] for _ in range(10)]]


@pytest.mark.parametrize("pairs_at_once", [periodic.GRID_PAIRS, 50])
def test_runs(monkeypatch, pairs_at_once):
    monkeypatch.setattr(periodic, "GRID_PAIRS", pairs_at_once)
    texts = awkward()
    first = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    found = periodic.runs_of(np.array([w for t in texts for w in t], np.uint64), first)
    assert [tuple(r) for r in found.tolist()] == [(i, s, s + n, p) for i, t in enumerate(texts) for s, n, p in runs(t)]


def test_the_cover_has_every_distance():
    assert {(a - b) % periodic.MODULUS for a in periodic.COVER for b in periodic.COVER} == set(range(periodic.MODULUS))


@pytest.mark.parametrize("names", [3, 1 << 24])
def test_extensions(names):
    rng = np.random.default_rng(2)
    words = np.concatenate([rng.integers(0, 3, 400), np.tile(rng.integers(0, 3, 40), 8), [names]])
    ahead = periodic.Extensions(words)
    a, b = rng.integers(0, len(words), (2, 3000))
    a, b = a[a != b], b[a != b]
    plain = [next((t for t in range(len(words)) if max(x, y) + t >= len(words) or words[x + t] != words[y + t])) for x, y in zip(a.tolist(), b.tolist(), strict=True)]
    assert ahead(a, b).tolist() == plain


def test_documents(docs, pairs):
    got = {r.doc_id: (len(r.runs), *(r.best or (None,) * 4), r.runs_sha256, r.collapsed_sha256) for r in periodic.periodic_runs(queries.looped(docs)).collect()}
    assert got == {i: brute(looped(i, t)) for i, t in pairs}


def test_texts_of_the_corpus(spark):
    """The registered query over texts of up to 3,000 words."""
    folder = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{folder}/documents.parquet").collect()
    got = {r.doc_id: tuple(r)[1:] for r in queries.op13_periodic_runs(spark, folder).collect()}
    assert set(got) == {r.doc_id for r in rows}
    short = [r for r in rows if len(corpus.words(r.text)) <= 3000]
    assert {r.doc_id: got[r.doc_id] for r in short} == {r.doc_id: brute(looped(r.doc_id, r.text)) for r in short}


def test_empty_odd_and_very_long(empty, odd, spark):
    assert periodic.periodic_runs(empty).collect() == []
    assert periodic.periodic_runs(queries.looped(odd)).count() == odd.count()
    texts = [(1, "x " * 300_000), (2, "a b " * 100_000 + "c"), (None, None)]
    got = {r.doc_id: r for r in periodic.periodic_runs(spark.createDataFrame(texts, "doc_id bigint, text string")).collect()}
    assert tuple(got[1].best) == (0, 300_000, 1, 300_000_000) and len(got[1].runs) == 1 and got[1].collapsed_text == "x"
    assert tuple(got[2].best) == (0, 200_000, 2, 100_000_000) and got[2].collapsed_text == "a b c"
    assert got[None].n_words == 0 and got[None].best is None and got[None].collapsed_text is None
