"""Repeated runs of lines, found by prefix doubling over line-id sequences."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.llm.shared import id_filter, in_filter, stored

MIN_LINES = 2
# Texts that a task holds in Python at a time.
SLICE_ROWS = 256
BLANK = " \t\n\x0b\x0c\r"
# A place of a line with its ranks.
SPOT_BYTES = 40


def _named(groups: DataFrame, order: list[str]) -> DataFrame:
    """Ranks: integers in the sorted order of `order`, written so that they never change."""
    ranged = groups.repartitionByRange(*order).sortWithinPartitions(*order)
    return stored(ranged.withColumn("rank", F.monotonically_increasing_id()), "ranks")


def suffix_ranks(spots: DataFrame, most: int) -> list[tuple[int, DataFrame]]:
    """Prefix doubling over `spots (row, pos, n, h1, h2)`: for h = 1, 2, 4, ... the ranks of the suffixes by their first h lines.

    The table of h has `row, pos, n, rank` of the suffixes that share their first h lines with another; equal ranks are the suffix
    array's intervals with a longest common prefix of h lines or more, and ranks are in its order. A suffix that has
    become unique keeps its place and is dropped from later rounds, so the rounds shrink to what repeats. At most `most` lines are told apart.
    The table of one line has the other columns of `spots` as well.
    """
    lines = spots.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("copies")).where("copies > 1").drop("copies")
    state = stored(spots.join(_named(lines, ["h1", "h2"]), ["h1", "h2"]).drop("h1", "h2"), "suffixes")
    levels, h, size = [], 1, SPOT_BYTES * state.count()
    while h <= most and not state.isEmpty():
        levels.append((h, state))
        if 2 * h > most:
            break
        after = state.select(F.col("row").alias("r"), (F.col("pos") - h).alias("p"), F.col("rank").alias("second"))
        pairs = state.join(after, (F.col("row") == F.col("r")) & (F.col("pos") == F.col("p"))).where(F.col("pos") + 2 * h <= F.col("n"))
        pairs = stored(pairs.select("row", "pos", "n", F.col("rank").alias("first"), "second"), "pairs", size)
        groups = pairs.groupBy("first", "second").agg(F.count(F.lit(1)).alias("copies")).where("copies > 1").drop("copies")
        state = stored(pairs.join(_named(groups, ["first", "second"]), ["first", "second"]).select("row", "pos", "n", "rank"), "suffixes", size)
        h *= 2
    return levels


def _later_copies(level: tuple[int, DataFrame], spots: DataFrame, min_lines: int, size: int) -> DataFrame:
    """`row`, `pos` of the suffixes whose interval of at least `min_lines` common lines has an earlier one."""
    h, ranks = level
    if h < min_lines:
        # Two prefixes of h lines that overlap make one of min_lines.
        tail = ranks.select(F.col("row").alias("r"), (F.col("pos") - (min_lines - h)).alias("p"), F.col("rank").alias("tail"))
        ranks = ranks.join(tail, (F.col("row") == F.col("r")) & (F.col("pos") == F.col("p"))).drop("r", "p")
    else:
        ranks = ranks.withColumn("tail", F.lit(0).cast("bigint"))
    rows = spots.select("row", "place").distinct()
    members = stored(ranks.join(rows, "row").select("row", "pos", "rank", "tail", F.struct("place", "row", "pos").alias("at")), "members", size)
    first = members.groupBy("rank", "tail").agg(F.min("at").alias("first"))
    return members.join(first, ["rank", "tail"]).where("at > first").select("row", "pos")


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, len(batch), SLICE_ROWS):
            yield batch.slice(at, SLICE_ROWS)


def _with_deletions(batches: Iterator[pa.RecordBatch], chosen: np.ndarray) -> Iterator[pa.RecordBatch]:
    for batch in _slices(batches):
        yield batch.filter(pa.array(in_filter(chosen, batch["row"].to_pylist()), pa.bool_()))


def _rebuilt(batches: Iterator[pa.RecordBatch], min_lines: int, without: np.ndarray | None = None) -> Iterator[pa.RecordBatch]:
    """Documents without the runs at `starts` and the lines at `lone`; with a filter, those outside it as they are."""
    for batch in _slices(batches):
        if without is not None:
            batch = batch.filter(pc.invert(pa.array(in_filter(without, batch["row"].to_pylist()), pa.bool_())))
        texts, removed = [], []
        runs, lone = ([batch[c].to_pylist() if without is None else [None] * len(batch) for c in ("starts", "lone")])
        for text, starts, single in zip(batch["text"].to_pylist(), runs, lone, strict=True):
            if not starts and not single:
                texts.append(text)
                removed.append(0)
                continue
            gone = {s + i for s in starts for i in range(min_lines)}.union(single)
            kept, number = [], -1
            for line in text.split("\n"):
                number += bool(line.strip(BLANK))
                if not line.strip(BLANK) or number not in gone:
                    kept.append(line)
            texts.append("\n".join(kept))
            removed.append(len(gone))
        digests = [hashlib.sha256((t or "").encode("utf-8", "surrogatepass")).hexdigest() for t in texts]
        yield pa.RecordBatch.from_arrays(
            [batch["row"], batch["doc_id"], batch["rest"], batch["n"], pa.array(removed, pa.int64()), pa.array(texts, pa.string()), pa.array(digests, pa.string())],
            names=["row", "doc_id", "rest", "n_lines", "n_removed", "text", "kept_sha256"])


def line_ids(lines: Column, min_words: int | None = None) -> Column:
    def named(line: Column) -> Column:
        long = [] if min_words is None else [line.rlike(rf"^[\x20\x09-\x0D]*+(?:[^\x20\x09-\x0D]++[\x20\x09-\x0D]++){{{max(0, min_words - 1)}}}[^\x20\x09-\x0D]").alias("long")]
        return F.struct(F.xxhash64(line).alias("h1"), F.xxhash64(F.lit(1), line).alias("h2"), *long)

    return F.transform(lines, named)


def _lone_copies(level: tuple[int, DataFrame]) -> DataFrame:
    """`row`, `pos` of the long lines that an earlier place has."""
    members = level[1].where("long").select("row", "pos", "rank", F.struct("place", "row", "pos").alias("at"))
    first = members.groupBy("rank").agg(F.min("at").alias("first"))
    return members.join(first, "rank").where("at > first").select("row", "pos")


def repeated_lines(docs: DataFrame, min_lines: int = MIN_LINES, carry: tuple[str, ...] = (), min_words: int | None = None) -> DataFrame:
    """Deletes later copies of repeated runs of `min_lines` lines or more from `docs (doc_id, text)`.

    Lines are parts between `\\n`; lines without a word (ASCII white space only) are never part of a run, never deleted and do not interrupt one. A
    line is identified by two 64-bit hashes. Every line in a run of `min_lines` lines that also starts at an earlier place is deleted;
    places are ordered by doc_id, then by row, then by line, so that the first copy of the corpus stays. Runs are
    judged on the input. With `min_words`, a single line of so many words (`[^\\x20\\x09-\\x0D]+`) or more is a run as well, whatever its neighbours are.

    Result, one row per input row: `row` (any number), `doc_id`, `n_lines` (lines with a word), `n_removed`, `text` (null stays null), `kept_sha256`
    (of the kept text, null as empty), `rest` (a struct of the input's columns in `carry`). Other columns are not used. Rows with a null doc_id come after all others;
    rows that share a doc_id are documents of their own. No rows give no rows.
    """
    words = F.filter(F.split("text", "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    held = stored(docs.select(
        F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("bigint").alias("doc_id"), "text",
        F.struct(F.lit(0).alias("none"), *carry).alias("rest"), line_ids(F.coalesce(words, F.array().cast("array<string>")), min_words).alias("ids"),
    ).withColumn("n", F.size("ids").cast("bigint")), "lines")
    place = F.coalesce("doc_id", F.lit((1 << 63) - 1)).alias("place")
    spots = held.select("row", place, "n", F.posexplode("ids").alias("pos", "id")).select("row", "place", F.col("pos").cast("bigint").alias("pos"), "n", "id.*")
    levels = suffix_ranks(spots if min_words is not None else spots.drop("place"), min_lines)
    size = SPOT_BYTES * levels[0][1].count() if levels else 0
    later = held.select("row", F.lit(0).cast("bigint").alias("pos")).limit(0)
    if levels and 2 * levels[-1][0] > min_lines:
        later = _later_copies(levels[-1], held.select("row", place), min_lines, size)
    later = later.withColumn("alone", F.lit(False))
    if levels and min_words is not None:
        later = later.unionByName(_lone_copies(levels[0]).withColumn("alone", F.lit(True)))
    later = later.groupBy("row").agg(*[F.sort_array(F.collect_list(F.when(c, F.col("pos")))).alias(name) for name, c in (("starts", ~F.col("alone")), ("lone", F.col("alone")))])
    later, told = stored(later, "later", size), held.select("row", "doc_id", "rest", "text", "n")
    rest = held.schema["rest"].dataType.simpleString()
    out = f"row bigint, doc_id bigint, rest {rest}, n_lines bigint, n_removed bigint, text string, kept_sha256 string"
    # Only texts that lose lines meet their lines, in a shuffle at every size: the list grows with the input.
    chosen = id_filter(later, "row")
    open_texts = told.mapInArrow(partial(_with_deletions, chosen=chosen), told.schema).join(later.hint("merge"), "row", "left")
    cut = open_texts.mapInArrow(partial(_rebuilt, min_lines=min_lines), out)
    return cut.unionByName(told.mapInArrow(partial(_rebuilt, min_lines=min_lines, without=chosen), out))
