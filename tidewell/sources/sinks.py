"""Parquet output."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.operators.ordering import with_position

# Codec names a job may ask for -> names of the Parquet writer.
CODECS = {"none": "uncompressed", "snappy": "snappy", "gzip": "gzip", "lz4": "lz4", "zstd": "zstd"}
INDEX = "__index_level_0__"


def write_parquet(
    df: DataFrame,
    path: str,
    codec: str = "snappy",
    partition_by: Sequence[str] = (),
    rows_per_file: int | None = None,
    mode: str = "overwrite",
    rows_per_group: int | None = None,
) -> None:
    """Write a table. `rows_per_group` bounds the rows of a row group, `rows_per_file` those of a file; without them files are as
    large as their tasks and row groups follow `parquet.block.size`.

    Partitioned output is rebalanced first: each value goes to few files, and a value that holds
    much of the table is spread over several tasks.
    """
    if codec == "brotli":
        raise ValueError("brotli needs a codec library that Spark does not ship; use zstd or gzip")
    if codec not in CODECS:
        raise ValueError(f"unknown codec {codec!r}, expected one of {sorted(CODECS)}")
    columns = [c.strip() for c in partition_by]
    if columns:
        df = df.hint("rebalance", *[F.col(c) for c in columns])
    writer = df.write.mode(mode).option("compression", CODECS[codec])
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    if rows_per_group:
        # The writer looks at its size, and at the bound, only every so many rows: as often as the bound needs.
        writer = writer.option("parquet.block.row.count.limit", rows_per_group)
    (writer.partitionBy(*columns) if columns else writer).parquet(path)


def row_groups(spark: SparkSession, path: str) -> DataFrame:
    """`file`, `row_group`, `rows` of written Parquet files. Spark hands each task whole files, whose footers it reads."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").load(path)

    def footers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch["path"].to_pylist(), batch["content"], strict=True):
                footer = pq.ParquetFile(pa.BufferReader(content.as_buffer())).metadata
                n = footer.num_row_groups
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * n, pa.string()), pa.array(range(n), pa.int32()), pa.array([footer.row_group(i).num_rows for i in range(n)], pa.int64())], names=["file", "row_group", "rows"])

    return files.select("path", "content").mapInArrow(footers, "file string, row_group int, rows bigint")


def with_file_index(df: DataFrame, name: str = INDEX) -> DataFrame:
    """Number the rows of each file in file order, from 0. `df` must come straight from the file scan, or have the places of its rows."""
    read = df if "__file" in df.columns else df.select(
        "*", F.col("_metadata.file_path").alias("__file"), F.col("_metadata.file_block_start").alias("__block_start"),
        F.monotonically_increasing_id().alias("__line"))
    return with_position(read, ["__block_start", "__line"], ["__file"], name=name).drop("__file", "__block_start", "__line")
