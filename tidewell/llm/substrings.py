"""Repeated word windows, found level by level: only windows that repeat are tried at twice the length."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.llm.shared import by_bytes, id_filter, in_filter, mix, packed, pair, stored, word_hashes
from tidewell.session import released

# Bytes of text whose windows meet in one bucket, on average.
BUCKET_BYTES = 2 << 20
# Characters of text whose windows are merged before they are sent.
MESSAGE_BYTES = 1 << 20
# Documents whose repeated windows are held at a time.
SLICE_ROWS = 128
# Rows that Spark and a Python task hand each other at a time: texts and their windows are wide.
BATCH_KEY, BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", "1000"
MESSAGE = "bucket int, docs binary, counts binary, codes binary, hashes binary"


def window_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of every n consecutive words, built by doubling."""
    if len(words) < n:
        return np.zeros(0, np.uint64)
    out, have, step, width, at = None, words, 1, len(words) - n + 1, 0
    while step <= n:
        if n & step:
            part = have[at : at + width]
            out = part if out is None else pair(out, part)
            at += step
        step *= 2
        if step <= n:
            have = pair(have[: len(have) - step // 2], have[step // 2 :])
    return out


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[]] * 5
    types = [pa.int32()] + [pa.binary()] * 4
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["bucket", "docs", "counts", "codes", "hashes"])


def _message(bucket: int, ids: np.ndarray, docs: np.ndarray, codes: np.ndarray, hashes: np.ndarray) -> tuple:
    first = np.flatnonzero(np.diff(docs, prepend=-1))
    counts = np.diff(np.append(first, len(docs))).astype(np.int32)
    return bucket, ids[docs[first]].tobytes(), counts.tobytes(), codes.astype(np.int32).tobytes(), hashes.tobytes()


def _messages(ids: np.ndarray, docs: np.ndarray, starts: np.ndarray, hashes: np.ndarray, buckets: int) -> pa.RecordBatch:
    """Windows in order of (`docs`, `starts`), packed per bucket; `docs` indexes `ids`.

    Of equal windows in several documents of the batch only the smallest document's are sent to the bucket, marked as repeated: a
    window that every document has costs one entry per batch. The others have met a smaller document here and are
    finished; they go to buckets below 0, by batch.
    """
    if not len(hashes):
        return _batch([])
    order = np.argsort(hashes, kind="stable")
    h, owner = hashes[order], ids[docs[order]]
    head = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
    counts = np.diff(np.append(head, len(h)))
    later = owner > np.repeat(np.minimum.reduceat(owner, head), counts)
    shared = np.repeat(np.logical_or.reduceat(later, head), counts)
    flags = np.zeros((2, len(h)), bool)
    flags[0][order], flags[1][order] = later, shared
    later, shared = flags
    rows = []
    if later.any():
        rows.append(_message(-1 - int(ids.min() % buckets), ids, docs[later], starts[later] * 2 + 1, hashes[later]))
    d, c, h = docs[~later], starts[~later] * 2 + shared[~later], hashes[~later]
    bucket = ((h >> np.uint64(32)) % np.uint64(buckets)).astype(np.uint16 if buckets < 1 << 16 else np.int64)
    order = np.argsort(bucket, kind="stable")
    bucket, d, c, h = bucket[order].astype(np.int64), d[order], c[order], h[order]
    cuts = np.append(np.flatnonzero(np.diff(bucket, prepend=-1)), len(bucket))
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        rows.append(_message(int(bucket[a]), ids, d[a:b], c[a:b], h[a:b]))
    return _batch(rows)


def _placed(ids: list[int], texts: list[str | None], n: int) -> tuple[np.ndarray, ...]:
    """Document, start, anchor and hash of every window of n words of some texts.

    A window's anchor is the smallest hash of the ceil(n / 2)-word windows inside it, so equal windows have equal anchors, and
    neighbours mostly share theirs.
    """
    words, first = word_hashes(texts)
    half = (n + 1) // 2
    short, hashes = window_hashes(words, half), window_hashes(words, n)
    anchors = short[: len(hashes)].copy()
    for shift in range(1, n - half + 1):
        np.minimum(anchors, short[shift : shift + len(hashes)], out=anchors)
    docs = np.repeat(np.arange(len(ids)), np.diff(first))[: len(hashes)]
    at = np.arange(len(hashes))
    inside = at + n <= first[1:][docs]
    docs = docs[inside]
    return docs, at[inside] - first[docs], anchors[inside], hashes[inside]


def _text_anchors(batches: Iterator[pa.RecordBatch], n: int, buckets: int) -> Iterator[pa.RecordBatch]:
    for batch in (b.slice(at, 8 * SLICE_ROWS) for b in batches for at in range(0, len(b), 8 * SLICE_ROWS)):
        for ids, texts in by_bytes(batch["doc_id"].to_pylist(), batch["text"].to_pylist(), MESSAGE_BYTES):
            docs, starts, anchors, _ = _placed(ids, texts, n)
            turn = np.ones(len(anchors), bool)
            turn[1:] = (anchors[1:] != anchors[:-1]) | (docs[1:] != docs[:-1])
            yield _messages(np.array(ids, np.int64), docs[turn], starts[turn], anchors[turn], buckets)


def _anchored_windows(batches: Iterator[pa.RecordBatch], n: int, buckets: int) -> Iterator[pa.RecordBatch]:
    """Windows whose anchor repeats, out of `doc_id, text, parts`."""
    for batch in _slices(batches):
        ids, parts = batch["doc_id"].to_pylist(), batch["parts"].to_pylist()
        for rows, texts in by_bytes(list(range(len(ids))), batch["text"].to_pylist(), MESSAGE_BYTES):
            docs, starts, anchors, hashes = _placed(rows, texts, n)
            keep = np.zeros(len(docs), bool)
            bounds = np.searchsorted(docs, np.arange(len(rows) + 1))
            for i, row in enumerate(rows):
                known = np.concatenate([np.frombuffer(p["hashes"], np.uint64) for p in parts[row]])
                keep[bounds[i] : bounds[i + 1]] = np.isin(anchors[bounds[i] : bounds[i + 1]], known)
            yield _messages(np.array([ids[r] for r in rows], np.int64), docs[keep], starts[keep], hashes[keep], buckets)


def _merged(parts: list[dict]) -> tuple[np.ndarray, np.ndarray]:
    """Codes and hashes of the repeated windows of a document, by start."""
    codes = np.concatenate([np.frombuffer(p["codes"], np.int32) for p in parts])
    hashes = np.concatenate([np.frombuffer(p["hashes"], np.uint64) for p in parts])
    order = np.argsort(codes, kind="stable")
    codes, hashes = codes[order], hashes[order]
    keep = np.append(np.diff(codes >> 1) > 0, True)
    return codes[keep], hashes[keep]


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, len(batch), SLICE_ROWS):
            yield batch.slice(at, SLICE_ROWS)


def _longer_windows(batches: Iterator[pa.RecordBatch], half: int, buckets: int) -> Iterator[pa.RecordBatch]:
    """Windows of twice the length whose two halves both repeat."""
    for batch in _slices(batches):
        docs, starts, hashes = [], [], []
        for i, parts in enumerate(batch["parts"].to_pylist()):
            codes, h = _merged(parts)
            s = (codes >> 1).astype(np.int64)
            tail = np.searchsorted(s, s + half)
            both = (tail < len(s)) & (s[np.minimum(tail, len(s) - 1)] == s + half)
            docs.append(np.full(int(both.sum()), i))
            starts.append(s[both])
            hashes.append(pair(h[both], h[tail[both]]))
        if docs:
            yield _messages(np.array(batch["doc_id"].to_pylist(), np.int64), np.concatenate(docs), np.concatenate(starts), np.concatenate(hashes), buckets)


def _per_doc(docs: np.ndarray, codes: np.ndarray, hashes: np.ndarray) -> pa.Table:
    order = np.argsort(docs, kind="stable")
    docs, codes, hashes = docs[order], codes[order].astype(np.int32), hashes[order]
    first = np.flatnonzero(np.concatenate([[True], docs[1:] != docs[:-1]])) if len(docs) else np.zeros(0, np.int64)
    bounds = np.append(first, len(docs))
    return pa.table({"doc_id": pa.array(docs[first], pa.int64()), "codes": packed(codes, bounds), "hashes": packed(hashes, bounds)})


def _unpacked(table: pa.Table | pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    docs = [np.repeat(np.frombuffer(d, np.int64), np.frombuffer(c, np.int32)) for d, c in zip(table["docs"].to_pylist(), table["counts"].to_pylist(), strict=True)]
    codes = [np.frombuffer(s, np.int32) for s in table["codes"].to_pylist()]
    return np.concatenate(docs), np.concatenate(codes), np.concatenate([np.frombuffer(h, np.uint64) for h in table["hashes"].to_pylist()])


def _met(table: pa.Table, homes: int) -> pa.RecordBatch:
    """Windows of a bucket that repeat, packed per home of their documents; a code is 2 * start, plus 1 if a smaller document has the window."""
    docs, codes, hashes = _unpacked(table)
    if table["bucket"][0].as_py() >= 0:
        order = np.argsort(hashes, kind="stable")
        docs, codes, hashes = docs[order], codes[order], hashes[order]
        head = np.flatnonzero(np.concatenate([[True], hashes[1:] != hashes[:-1]]))
        counts = np.diff(np.append(head, len(hashes)))
        later = docs > np.repeat(np.minimum.reduceat(docs, head), counts)
        repeated = np.repeat(np.logical_or.reduceat(later | (codes & 1 == 1), head), counts)
        docs, codes, hashes = docs[repeated], codes[repeated] & ~1 | later[repeated], hashes[repeated]
    if not len(docs):
        return _batch([])
    ids, at = np.unique(docs, return_inverse=True)
    home = (mix(ids.view(np.uint64)) % np.uint64(homes)).astype(np.int64)[at]
    order = np.lexsort((at, home))
    home, at, codes, hashes = home[order], at[order], codes[order], hashes[order]
    cuts = np.append(np.flatnonzero(np.diff(home, prepend=-1)), len(home))
    return _batch([_message(int(home[a]), ids, at[a:b], codes[a:b], hashes[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)])


def _gathered(table: pa.Table) -> pa.Table:
    """The repeated windows of the documents of a home, out of all buckets."""
    return _per_doc(*_unpacked(table))


def _repeated(messages: DataFrame, homes: int) -> DataFrame:
    """`doc_id`, `parts`: the windows that occur in several documents.

    Buckets and homes exchange packed blocks, so the rows that are shuffled follow the blocks, not the windows.
    """
    met = messages.groupBy("bucket").applyInArrow(lambda table: pa.Table.from_batches([_met(table, homes)]), MESSAGE)
    found = met.groupBy("bucket").applyInArrow(_gathered, "doc_id bigint, codes binary, hashes binary")
    return found.select("doc_id", F.array(F.struct("codes", "hashes")).alias("parts"))


def _digest(words: list[bytes]) -> str:
    return hashlib.sha256(b" ".join(words)).hexdigest()


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words and digest of every whole text, as it is."""
    for batch in (b.slice(at, 1024) for b in batches for at in range(0, len(b), 1024)):
        n_words, digests = [], []
        for text in batch["text"].to_pylist():
            words = (text or "").encode("utf-8", "surrogatepass").split()
            n_words.append(len(words))
            digests.append(_digest(words))
        yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(n_words, pa.int64()), pa.array(digests, pa.string())], names=["doc_id", "n_words", "kept_sha256"])


def _chosen(batches: Iterator[pa.RecordBatch], chosen: np.ndarray) -> Iterator[pa.RecordBatch]:
    for batch in _slices(batches):
        yield batch.filter(pa.array(in_filter(chosen, batch["doc_id"].to_pylist()), pa.bool_()))


def _cut(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[pa.RecordBatch]:
    for batch in _slices(batches):
        before, n_removed, digests, texts, spans = [], [], [], [], []
        for text, parts in zip(batch["text"].to_pylist(), batch["parts"].to_pylist(), strict=True):
            # A null text may share its id with a row that has windows.
            words = (text or "").encode("utf-8", "surrogatepass").split()
            before.append(_digest(words))
            codes = _merged(parts)[0]
            starts = codes[(codes & 1 == 1)] >> 1
            starts = starts[starts + n <= len(words)]
            edge = np.zeros(len(words) + 1, np.int64)
            np.add.at(edge, starts, 1)
            np.add.at(edge, starts + n, -1)
            covered = np.cumsum(edge[:-1]) > 0
            kept = [w for w, c in zip(words, covered.tolist(), strict=True) if not c]
            turns = np.flatnonzero(np.diff(covered, prepend=False, append=False))
            spans.append([{"start": int(a), "end": int(b)} for a, b in zip(turns[::2], turns[1::2], strict=True)])
            n_removed.append(int(covered.sum()))
            digests.append(_digest(kept))
            texts.append(b" ".join(kept).decode("utf-8", "surrogatepass"))
        yield pa.RecordBatch.from_arrays([
            batch["doc_id"], pa.array(before, pa.string()), pa.array(texts, pa.string()), pa.array(n_removed, pa.int64()), pa.array(digests, pa.string()),
            pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
        ], names=["doc_id", "kept_sha256", "kept_text", "n_removed", "cut_sha256", "spans"])


def _with(fn: Callable, *args: object) -> Callable:
    return lambda batches: fn(batches, *args)


def _homes(size: int) -> int:
    """Homes of documents follow the input alone: buckets and homes exchange as many blocks as there are pairs of them."""
    return max(1, -(-size // BUCKET_BYTES))


def _buckets(spark: SparkSession, size: int) -> int:
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), _homes(size))


def repeated_windows(docs: DataFrame, n: int = 13) -> DataFrame:
    """Cuts words that repeat from `docs (doc_id, text)`.

    Words are `[^\\x20\\x09-\\x0D]+`, unchanged. A window is n consecutive words of one document. Every word
    covered by a window whose words also start in a document with a smaller doc_id is removed; windows are
    judged on the input. Equality is that of 64-bit hashes of 64-bit word hashes.

    Levels: half-length windows that occur in several documents are the only ones extended to n words, windows of n words that repeat
    the only ones extended to 2n, and so on until no window is left. At the first level only the smallest-hash window inside each window of n
    words is looked up, which no repeat can miss. The level of n decides what is removed, the levels above give `longest`, the longest
    tried length (n, 2n, ...) that repeats.

    Result, one row per input row: `doc_id`, `n_words`, `n_removed`, `kept_sha256` (kept words joined by one space, UTF-8), `kept_text`
    (null where nothing was removed), `spans` (removed word ranges), `longest` (0 if nothing repeats). A null text has no words. A row with
    a null doc_id is left alone. Rows that share a doc_id are one document for comparison and never cut each other; windows found
    in any of them are then cut by position, where they fit, in each. No rows give no rows. Other columns are not used.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    before = spark.conf.get(BATCH_KEY)
    spark.conf.set(BATCH_KEY, BATCH_ROWS)
    try:
        cut, top = _levels(docs, n)
    finally:
        spark.conf.set(BATCH_KEY, before)
    done = docs.mapInArrow(_counted, "doc_id bigint, n_words bigint, kept_sha256 string")
    return done.join(cut.join(top, "doc_id"), ["doc_id", "kept_sha256"], "left").select(
        "doc_id", "n_words", F.coalesce("n_removed", F.lit(0).cast("bigint")).alias("n_removed"),
        F.coalesce("cut_sha256", "kept_sha256").alias("kept_sha256"),
        F.when(F.col("n_removed") > 0, F.col("kept_text")).alias("kept_text"), "spans", F.coalesce("longest", F.lit(0)).alias("longest"),
    )


def _levels(docs: DataFrame, n: int) -> tuple[DataFrame, DataFrame]:
    """What the level of n words cuts out of each text that has repeats, and the longest tried length that repeats in each document."""
    spark = docs.sparkSession
    named = docs.where("doc_id is not null")
    size = named.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    # First the half-length windows that stand for the others: a fifth to a quarter of all windows.
    quarter, whole = _buckets(spark, size // 4), _buckets(spark, size)
    anchors = stored(_repeated(named.mapInArrow(_with(_text_anchors, n, quarter), MESSAGE), _homes(size // 4)), "anchors")
    # Texts are not written again: they are read once more through a filter of the ids that a level found.
    texts = lambda ids: named.select("doc_id", "text").mapInArrow(_with(_chosen, id_filter(ids, "doc_id")), "doc_id bigint, text string")
    windows = texts(anchors).join(anchors, "doc_id").mapInArrow(_with(_anchored_windows, n, whole), MESSAGE)
    level = stored(_repeated(windows, _homes(size)), "repeats")
    released(anchors)
    cut = stored(texts(level).join(level, "doc_id").mapInArrow(
        _with(_cut, n), "doc_id bigint, kept_sha256 string, kept_text string, n_removed bigint, cut_sha256 string, spans array<struct<start: bigint, end: bigint>>",
    ), "cut")
    longest, length = stored(level.select("doc_id", F.lit(n).alias("length")), "lengths"), n
    while True:
        size = level.agg(F.sum(F.expr("aggregate(parts, 0L, (total, part) -> total + octet_length(part.hashes))"))).first()[0]
        if not size:
            break
        buckets = _buckets(spark, size)
        longer = stored(_repeated(level.mapInArrow(_with(_longer_windows, length, buckets), MESSAGE), _homes(size)), "repeats")
        released(level)
        level, length = longer, 2 * length
        longest = longest.unionByName(stored(level.select("doc_id", F.lit(length).alias("length")), "lengths"))
    top = longest.groupBy("doc_id").agg(F.max("length").alias("longest"))
    # Rows that repeat an id and a text are cut alike, and joined once.
    return cut.dropDuplicates(["doc_id", "kept_sha256"]), top
