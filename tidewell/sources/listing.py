"""File listings as tables: formats, support, selection, and what is still to convert."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewell.functions.paths import detect_format, is_supported, output_name

OUTPUT = "__output"


def list_files(spark: SparkSession, path: str, recursive: bool = False) -> DataFrame:
    """Path, path relative to the root, size and format of each file; file contents are not read."""
    root = path.rstrip("/")
    bare = root.split("://", 1)[-1] if "://" in root else root.removeprefix("file:")
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower()).load(root)
        .select("path", F.col("length").alias("size"), F.col("modificationTime").alias("modified"))
    )
    under = F.locate(bare + "/", F.col("path"))
    relative = F.when(under > 0, F.expr("substring(path, __at)")).otherwise(F.element_at(F.split("path", "/"), -1))
    listing = files.withColumn("__at", (under + len(bare) + 1).cast("int")).withColumn("relative", relative)
    return classified(listing.drop("__at"))


def classified(files: DataFrame, path: str = "path") -> DataFrame:
    kind = detect_format(F.col(path))
    return files.withColumn("format", kind).withColumn("supported", is_supported(F.col("format")))


def support_counts(listing: DataFrame) -> DataFrame:
    return listing.groupBy("supported", "format").agg(F.count(F.lit(1)).alias("files"))


def select_files(
    listing: DataFrame,
    include: Iterable[str] | None = None,
    exclude: Iterable[str] | None = None,
    limit: int | None = None,
    order: str = "path",
) -> DataFrame:
    """Keep or drop formats; `limit` keeps the first files in path order."""
    if include is not None:
        listing = listing.filter(F.col("format").isin(list(include)))
    if exclude is not None:
        listing = listing.filter(~F.col("format").isin(list(exclude)))
    return listing if limit is None else listing.orderBy(order).limit(limit)


def existing_outputs(spark: SparkSession, folder: str) -> DataFrame:
    """Names of the Parquet tables in an output folder; unfinished writes do not show."""
    try:
        parts = list_files(spark, folder, recursive=True)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "output string")
    # Tables that were written together lie under their names as values of a partition column.
    folder_name = F.split("relative", "/")[0]
    written = F.url_decode(F.replace(F.replace(folder_name, F.lit(f"{OUTPUT}="), F.lit("")), F.lit("+"), F.lit("%2B")))
    return parts.select(F.when(folder_name.startswith(f"{OUTPUT}="), written).otherwise(folder_name).alias("output")).distinct()


def without_existing(listing: DataFrame, existing: DataFrame, on: str) -> DataFrame:
    """Files whose output is not there yet."""
    return listing.join(existing, on, "left_anti")


def to_convert(listing: DataFrame, existing: DataFrame | None) -> DataFrame:
    """Supported files with their output name, without those already converted.

    Files that differ only in their ending carry it in the output name.
    """
    named = listing.filter("supported").withColumn("output", output_name(F.col("relative")))
    ending = F.concat(F.lit("__"), F.regexp_extract("relative", r"\.([^./]+)$", 1), F.lit(".parquet"))
    # As many rows per name as a stem has endings.
    same = F.count(F.lit(1)).over(Window.partitionBy("output"))
    named = named.withColumn("__same", same).withColumn(
        "output", F.when(F.col("__same") > 1, F.regexp_replace("output", r"\.parquet$", ending)).otherwise(F.col("output"))
    ).drop("__same")
    return named if existing is None else without_existing(named, existing, "output")


def size_totals(files: DataFrame, size: str, converted: str, done: str) -> DataFrame:
    """Files, converted files, source and converted megabytes, and their ratio (1.0 without input)."""
    totals = files.agg(
        F.count(F.lit(1)).alias("files"),
        F.count_if(F.col(done)).alias("converted"),
        F.coalesce(F.sum(size), F.lit(0)).alias("__in"),
        F.coalesce(F.sum(F.when(F.col(done), F.col(converted))), F.lit(0)).alias("__out"),
    )
    ratio = F.coalesce(F.try_divide("__out", "__in"), F.lit(1.0))
    return totals.select(
        "files", "converted",
        F.round(F.col("__in") / 1048576, 2).alias("source_mb"),
        F.round(F.col("__out") / 1048576, 2).alias("parquet_mb"),
        ratio.alias("ratio"),
    )
