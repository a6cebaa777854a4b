"""Conversion of very many delimited files: the number of jobs follows the headers and types there are, not the files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.plans.ingest import REPORT, SEPARATORS, Options, typed_column
from tidewell.session import settled, shared_folder
from tidewell.sources import tabular
from tidewell.sources.listing import OUTPUT, existing_outputs, list_files, to_convert
from tidewell.sources.sinks import write_parquet
from tidewell.sources.types import checked_type, type_checks

REJECTS = "__rejects"


def _place(path: Column) -> Column:
    """One spelling of a path for `file:/a` and `file:///a`."""
    return F.regexp_replace(path, r"^([A-Za-z][A-Za-z0-9+.-]*):/+", "$1:/")


def convert_many(
    spark: SparkSession, path: str, folder: str, kind: str = "csv", ending: str | None = None, options: Options = Options(), recursive: bool = False, force: bool = False
) -> DataFrame:
    """Converts the delimited files of a folder, each to a table of its own with its own types, and reports on each.

    The files are cut into records together, and the records are dealt by header once. Then the types of all files of a header come from one aggregate, and all files with equal
    types are written in one job, partitioned by source: the table of a file is `<folder>/__output=<name>`. No list of files reaches the driver. What is
    collected are the distinct headers, and for each the distinct lists of types. Too long lines go to `<folder>/__rejects/__output=<name>`; with `rejects="fail"` their
    file is a failed row of the report and has no table, like a file without a header. The report is that of `ingest.convert`.
    """
    if options.preserve_index or options.readers:
        raise ValueError("files that are converted together have no index and no readers of their own")
    sep, glob = SEPARATORS[kind], f"*.{ending or kind}"
    listing = list_files(spark, path, recursive).where(F.col("format") == kind).where(F.lower(F.regexp_extract("path", r"\.([^./]+)$", 1)) == (ending or kind).lower())
    asked = to_convert(listing, None if force else existing_outputs(spark, folder))
    asked = settled(asked.select("relative", _place(F.col("path")).alias("place"), "size", "output"), "bulk-files")
    shapes = tabular.file_shapes(spark, path, sep, glob, recursive).where(F.trim("header") != "")
    shapes = shapes.select(_place(F.url_decode(F.replace("file", F.lit("+"), F.lit("%2B")))).alias("place"), "header", F.xxhash64("header").alias("h"))
    files = settled(asked.join(shapes, "place", "left"), "bulk-headers")
    records = tabular.quoted_records(spark, path, sep, glob, recursive)
    records = records.withColumn("place", _place(F.url_decode(F.replace("file", F.lit("+"), F.lit("%2B"))))).join(files.select("place", "h", "output"), "place")
    staged = shared_folder(spark, "bulk-records")
    records.select(F.col("output").alias("file"), "begin", "at", "text", "h").write.partitionBy("h").parquet(staged)
    told = None
    for h, header in sorted((r["h"], r["header"]) for r in files.where("h is not null").select("h", "header").distinct().collect()):
        names = tabular.header_names(header, sep)
        rows = spark.read.schema("file string, begin bigint, at bigint, text string, h bigint").parquet(staged).where(F.col("h") == h).drop("h")
        report = _convert_header(tabular.record_columns(rows, names, sep), names, files.where(F.col("h") == h), folder, options)
        told = report if told is None else told.unionByName(report)
    none = files.where("h is null").select("output", *[F.lit(0).cast("bigint").alias(c) for c in ("rows", "short", "bad")], F.lit(None).cast("map<string,string>").alias("schema"))
    told = none if told is None else told.unionByName(none)
    return _report(spark, files.join(told, "output"), folder, kind, options)


def _convert_header(raw: DataFrame, names: list[str], files: DataFrame, folder: str, options: Options) -> DataFrame:
    """Writes all files of one header; `output`, `rows`, `short`, `bad` and `schema` of each."""
    source, too_long, short = F.col(tabular.PLACE[0]).alias("output"), F.col(tabular.LONG), F.col(tabular.RAW).isNotNull()
    # Values of lines that do not fit have no say in the types.
    fitting = raw.select(source, too_long.alias("bad"), short.alias("short"), *[F.when(~too_long, F.col(f"`{c}`")).alias(c) for c in names])
    found = fitting.groupBy("output").agg(F.count_if(~F.col("bad")).alias("rows"), F.count_if(F.col("short") & ~F.col("bad")).alias("short"), F.count_if("bad").alias("bad"), *type_checks(names))
    kinds = F.array(*[checked_type(i) for i in range(len(names))])
    # A file with nothing but its header is a table without rows.
    blank = F.transform(F.sequence(F.lit(1), F.lit(len(names))), lambda _: F.lit("double"))
    found = files.select("output").join(found, "output", "left").select(
        "output", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("rows", "short", "bad")], F.when(F.col("rows").isNotNull(), kinds).otherwise(blank).alias("kinds"))
    found = settled(found, "bulk-kinds")
    kept = found if options.rejects == "apart" else found.where("bad = 0")
    placed = raw.withColumnRenamed(tabular.PLACE[0], OUTPUT)
    for kinds in sorted(tuple(r["kinds"]) for r in kept.select("kinds").distinct().collect()):
        same = kept.where(F.col("kinds") == F.array(*map(F.lit, kinds))).select(F.col("output").alias(OUTPUT))
        fits = placed.where(~F.col(tabular.LONG)).join(same, OUTPUT, "left_semi")
        typed = fits.select(OUTPUT, *[typed_column(c, k) for c, k in zip(names, kinds, strict=True)])
        write_parquet(typed, folder, options.codec, [OUTPUT, *options.partition_by], options.rows_per_file, mode="append")
    if not found.where("bad > 0").isEmpty():
        lost = placed.where(F.col(tabular.LONG)).select(OUTPUT, F.col(tabular.RAW).alias("line"))
        write_parquet(lost, f"{folder.rstrip('/')}/{REJECTS}", options.codec, [OUTPUT], mode="append")
    return found.select("output", "rows", "short", "bad", F.map_from_arrays(F.array(*map(F.lit, names)), "kinds").alias("schema"))


def _report(spark: SparkSession, files: DataFrame, folder: str, kind: str, options: Options) -> DataFrame:
    """A row per file, with the bytes of its table."""
    written = list_files(spark, folder, recursive=True).where(F.col("relative").startswith(f"{OUTPUT}=")).withColumn("table", F.split("relative", "/")[0])
    sizes = written.groupBy("table").agg(F.sum("size").alias("parquet_bytes"))
    name = F.url_decode(F.replace(F.replace("table", F.lit(f"{OUTPUT}="), F.lit("")), F.lit("+"), F.lit("%2B")))
    sizes = sizes.select(name.alias("output"), "parquet_bytes", F.concat(F.lit(folder.rstrip("/") + "/"), "table").alias("path"))
    error = F.when(F.col("schema").isNull(), "no header line")
    if options.rejects == "fail":
        error = error.when(F.col("bad") > 0, F.concat(F.col("bad").cast("string"), F.lit(" lines with too many fields")))
    done, size = error.isNull(), F.col("size").cast("bigint")
    values = {
        "source": F.col("relative"), "format": F.lit(kind), "output": F.col("output"), "path": F.col("path"), "source_bytes": size, "parquet_bytes": F.when(done, F.coalesce("parquet_bytes", F.lit(0))),
        "rows": F.when(done, F.col("rows")), "rejected": F.when(done, F.col("bad")), "short": F.when(done, F.col("short")), "schema": F.when(done, F.col("schema")),
        "compression_ratio": F.when(done, F.coalesce(F.try_divide("parquet_bytes", size), F.lit(1.0))), "partition_cols": F.when(done, F.array(*map(F.lit, options.partition_by)).cast("array<string>")),
        "finished": F.current_timestamp(), "status": F.when(done, "completed").otherwise("failed"), "error": error,
    }
    kinds = dict(f.split(" ", 1) for f in REPORT.split(", "))
    return settled(files.join(sizes, "output", "left").select(*[values[c].cast(k).alias(c) for c, k in kinds.items()]), "bulk-report")
