"""Files read as pieces by byte range, and what a range passes on to the next.

A task reads a range of a file without knowing in what state it begins: within a quoted field, within a JSON string, at some
depth. Each range therefore first yields its effect on every state it may begin in; a prefix over the ranges of a file tells where
each one begins, and a second pass cuts the records. Only the parts of records that cross a range are shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, WindowSpec
from pyspark.sql import functions as F

from tidewell.session import settled

# Ranges whose states are sent to all tasks; beyond, pieces are dealt and sorted by range.
MOST_RANGES = 200_000
# What a part of a record is: all of it, its end, its begin, or the middle of one that fills the range.
WHOLE, END, BEGIN, MIDDLE = range(4)
PARTS = "file string, begin bigint, at bigint, part int, text string"


def pieces(spark: SparkSession, paths: str | Sequence[str], separator: str = "\n", glob: str | None = None, recursive: bool = False) -> DataFrame:
    """`file`, `begin` (of its range), `at` and `value` of what lies between separators, in order within a range."""
    reader = spark.read.option("lineSep", separator).option("recursiveFileLookup", str(recursive).lower())
    reader = reader.option("pathGlobFilter", glob) if glob else reader
    return reader.text(paths).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("begin"), F.monotonically_increasing_id().alias("at"), "value")


def in_file() -> tuple[WindowSpec, WindowSpec]:
    """The ranges before one of the same file, and these with itself. A file has as many rows as ranges."""
    window = Window.partitionBy("file").orderBy("begin")
    return window.rowsBetween(Window.unboundedPreceding, -1), window.rowsBetween(Window.unboundedPreceding, 0)


def with_starts(found: DataFrame, starts: DataFrame) -> DataFrame:
    """Pieces with the state in which their range begins, still in order."""
    ranges = settled(starts, "range-starts")
    if ranges.count() <= MOST_RANGES:
        return found.join(F.broadcast(ranges), ["file", "begin"])
    return found.join(ranges, ["file", "begin"]).repartition("file", "begin").sortWithinPartitions("file", "begin", "at")


def by_range(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, bool, pa.RecordBatch]]:
    """Slices of consecutive rows of one range, with its file and begin, and whether it is a new one."""
    last = None
    for batch in batches:
        if not len(batch):
            continue
        files, begin = batch["file"].dictionary_encode(), batch["begin"].to_numpy()
        codes, names = files.indices.to_numpy(), files.dictionary
        edges = np.flatnonzero(np.concatenate([[True], (codes[1:] != codes[:-1]) | (begin[1:] != begin[:-1])]))
        for a, b in zip(edges, [*edges[1:], len(batch)], strict=True):
            key = names[int(codes[a])].as_py(), int(begin[a])
            yield *key, key != last, batch.slice(a, b - a)
            last = key


def part_rows(rows: list[tuple[str, int, int, int, str]]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[]] * 5
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["file", "begin", "at", "part", "text"])


def joined(parts: DataFrame, separator: str, others: Sequence[str] = ()) -> DataFrame:
    """`file`, `begin`, `at` (its place, by range), `text` and `others` of all records; those that cross ranges are put together, and have the place
    of their first part. One record is held by one task."""
    crossing = settled(parts.where(F.col("part") != WHOLE), "crossing")
    # The end of a record comes before the begin of the next one of the same range.
    window = Window.partitionBy("file").orderBy("begin", "part").rowsBetween(Window.unboundedPreceding, 0)
    numbered = crossing.withColumn("record", F.count(F.when(F.col("part") == BEGIN, 1)).over(window))
    together = numbered.groupBy("file", "record").agg(F.sort_array(F.collect_list(F.struct("begin", "part", "at", *others, "text"))).alias("texts"))
    first = F.col("texts")[0]
    together = together.select("file", first["begin"].alias("begin"), first["at"].alias("at"), *[first[c].alias(c) for c in others], F.array_join("texts.text", separator).alias("text"))
    return parts.where(F.col("part") == WHOLE).drop("part").unionByName(together)
