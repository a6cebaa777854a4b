"""Conversion of files to Parquet tables, with a report per source."""

from __future__ import annotations

import datetime
from collections.abc import Iterable, Iterator, Sequence
from concurrent.futures import FIRST_COMPLETED, Future, ThreadPoolExecutor, wait
from dataclasses import dataclass, field, replace
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidewell.session import shared_folder
from tidewell.sources import json_docs, tabular
from tidewell.sources.listing import existing_outputs, list_files, size_totals, to_convert, without_existing
from tidewell.sources.sinks import INDEX, with_file_index, write_parquet
from tidewell.sources.types import infer_types, nulls_out, typed

REPORT = (
    "source string, format string, output string, path string, source_bytes bigint, parquet_bytes bigint, "
    "rows bigint, rejected bigint, short bigint, schema map<string,string>, compression_ratio double, partition_cols array<string>, "
    "finished timestamp, status string, error string"
)

REPORTS_AT_ONCE = 1_000


class UnsupportedFormat(ValueError):
    """The format has no reader."""


@dataclass(frozen=True)
class Options:
    """How a source is read and written."""

    codec: str = "snappy"
    partition_by: Sequence[str] = ()
    rows_per_file: int | None = None
    preserve_index: bool = False
    # Lines that do not fit: to a table beside the output (`apart`), or the source fails (`fail`).
    rejects: str = "apart"
    readers: dict[str, Any] = field(default_factory=dict)


@dataclass(frozen=True)
class Source:
    """One table to convert: a file, or the files of one format in a folder."""

    name: str
    path: str
    format: str
    size: int
    output: str
    glob: str | None = None
    files: tuple[str, ...] = ()
    # Of `files`, where a scan has told them: the header line, and whether a quoted field runs over a line end.
    header: str | None = None
    quoted: bool | None = None

    @property
    def paths(self) -> str | list[str]:
        return list(self.files) or self.path


SEPARATORS = {"csv": ",", "tsv": "\t"}


def read_source(spark: SparkSession, source: Source, options: Options = Options()) -> DataFrame:
    """Read by format."""
    if source.format in options.readers:
        return options.readers[source.format](spark, source.path)
    if source.format in SEPARATORS:
        return tabular.read_delimited(spark, source.paths, SEPARATORS[source.format], glob=source.glob, rejects=options.rejects)
    if source.format == "json":
        return json_docs.read_json(spark, source.paths, source.glob)
    if source.format == "parquet":
        return spark.read.option("pathGlobFilter", source.glob or "*").parquet(source.path)
    raise UnsupportedFormat(f"no reader for format {source.format}")


def convert(spark: SparkSession, source: Source, folder: str, options: Options = Options()) -> dict[str, Any]:
    """Convert one source and report on it.

    Rows and the lines that do not fit are counted while they are written. Lines with too many fields go to the table
    `<output>__rejects`; damaged JSON lines stay in the table, in `_corrupt_record`; both are `rejected` in the report.
    Short lines are filled with nulls and counted as `short`.
    """
    path = f"{folder.rstrip('/')}/{source.output}"
    seen, none = Observation(), F.lit(0).cast("bigint")
    rejects = None
    if source.format in SEPARATORS and source.format not in options.readers:
        raw = tabular.read_text_columns(spark, source.paths, SEPARATORS[source.format], source.quoted, source.glob, source.header)
        kept = tabular.fitting(raw, options.rejects)
        names = tabular.value_columns(raw)
        kinds = infer_types(kept.select(*[f"`{c}`" for c in names]))
        typed = [typed_column(c, kinds[c]) for c in names]
        too_long, short = F.col(tabular.LONG), F.col(tabular.RAW).isNotNull()
        counts = [F.count_if(~too_long).alias("rows"), F.count_if(short & ~too_long).alias("short"), F.count_if(too_long).alias("bad")]
        # The index needs the file scan right below it, so its rows are counted after the lines that do not fit are gone.
        counted = with_file_index(kept, INDEX).observe(seen, *counts) if options.preserve_index else tabular.fitting(raw.observe(seen, *counts), options.rejects)
        df = counted.select(*typed, *([INDEX] if options.preserve_index else []))
        rejects = tabular.rejected(raw)
    else:
        df = read_source(spark, source, options)
        bad = F.count_if(F.col("_corrupt_record").isNotNull()) if "_corrupt_record" in df.columns else F.max(none)
        df = (with_file_index(df, INDEX) if options.preserve_index else df).observe(seen, F.count(F.lit(1)).alias("rows"), bad.alias("bad"))
    write_parquet(df, path, options.codec, options.partition_by, options.rows_per_file)
    written = list_files(spark, path, recursive=True).agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    counts = seen.get or {"rows": 0}
    bad = counts.get("bad") or 0
    if rejects is not None and options.rejects == "apart" and (bad or options.preserve_index):
        lost = Observation()
        rejects.observe(lost, F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(f"{path.removesuffix('.parquet')}__rejects")
        bad = lost.get["n"]
    ratio = 1.0 if source.format == "parquet" or not source.size else written / source.size
    return _report(source, path, "completed", parquet_bytes=written, rows=counts["rows"], rejected=bad, short=counts.get("short") or 0,
                   schema=dict(df.dtypes), compression_ratio=ratio, partition_cols=list(options.partition_by))


def typed_column(name: str, kind: str) -> Column:
    return typed(nulls_out(F.col(f"`{name}`")), kind).alias(name)


def _report(source: Source, path: str, status: str, **values: Any) -> dict[str, Any]:
    blank = {"parquet_bytes": None, "rows": None, "rejected": None, "short": None, "schema": None, "compression_ratio": None,
             "partition_cols": None, "error": None}
    return {"source": source.name, "format": source.format, "output": source.output, "path": path,
            "source_bytes": source.size, "finished": datetime.datetime.now(), "status": status, **blank, **values}


def _attempt(spark: SparkSession, source: Source, folder: str, options: Options) -> dict[str, Any]:
    path = f"{folder.rstrip('/')}/{source.output}"
    try:
        return convert(spark, source, folder, options)
    except UnsupportedFormat as error:
        return _report(source, path, "unsupported", error=str(error))
    except Exception as error:  # one bad source must not stop the batch
        return _report(source, path, "failed", error=str(error).strip().splitlines()[0] if str(error) else repr(error))


def sources_by_file(listing: DataFrame) -> Iterator[Source]:
    """One source per listed file, streamed from the listing."""
    rows = listing.select("relative", "path", "format", "size", "output").toLocalIterator()
    return (Source(r["relative"], r["path"], r["format"], r["size"], r["output"]) for r in rows)


def folders(listing: DataFrame) -> DataFrame:
    """Folder, format and file ending of listed files, with an output name each."""
    split = listing.select(
        F.regexp_replace("path", r"/[^/]*$", "").alias("path"),
        F.regexp_extract("relative", r"^(.*)/[^/]*$", 1).alias("relative"),
        F.regexp_extract("path", r"\.([^./]+)$", 1).alias("ending"), "format", "size")
    grouped = split.groupBy("path", "relative", "ending", "format").agg(F.sum("size").alias("size"))
    name = F.when(F.col("relative") != "", F.col("relative")).otherwise(F.element_at(F.split("path", "/"), -1))
    return grouped.withColumn("name", name).withColumn("output", F.concat(
        F.replace("name", F.lit("/"), F.lit("__")), F.lit("__"), "ending", F.lit(".parquet")))


def sources_by_folder(spark: SparkSession, found: DataFrame) -> Iterator[Source]:
    """One source per folder and file ending; delimited files with different headers become sources of their own.

    The sources of a folder with several headers list their files; all but the first carry the header's number in the output.
    """
    for r in found.toLocalIterator():
        source = Source(r["name"], r["path"], r["format"], r["size"], r["output"], f"*.{r['ending']}")
        if r["format"] not in SEPARATORS:
            yield source
            continue
        shapes = tabular.file_shapes(spark, source.path, SEPARATORS[source.format], source.glob)
        groups = shapes.groupBy("header").agg(F.sort_array(F.collect_list("file")).alias("files"), F.bool_or("quoted").alias("quoted")).orderBy("header").collect()
        if len(groups) <= 1:
            yield source
            continue
        for i, group in enumerate(groups):
            own = source if not i else replace(source, name=f"{source.name}#{i}", output=source.output.removesuffix(".parquet") + f"__{i}.parquet")
            yield replace(own, glob=None, files=tuple(group["files"]), header=group["header"], quoted=group["quoted"])


def convert_all(
    spark: SparkSession,
    sources: Iterable[Source],
    folder: str,
    options: Options = Options(),
    parallel: int = 4,
) -> DataFrame:
    """Convert sources, a few Spark jobs at a time, and return one report row each.

    Spark parallelises inside each job; a few jobs at once keep the executors busy when the
    sources are small. A source that fails becomes a report row. Reports go to a table in the
    shared folder, so the driver holds only a few of them.
    """
    table, ready, pending = shared_folder(spark, "reports"), [], set()
    names = [f.split()[0] for f in REPORT.split(", ")]

    def drain(done: set[Future], last: bool = False) -> None:
        ready.extend(tuple(r[n] for n in names) for r in (f.result() for f in done))
        if last or len(ready) >= REPORTS_AT_ONCE:
            spark.createDataFrame(ready, REPORT).coalesce(1).write.mode("append").parquet(table)
            ready.clear()

    with ThreadPoolExecutor(max_workers=parallel) as pool:
        for source in sources:
            pending.add(pool.submit(_attempt, spark, source, folder, options))
            if len(pending) >= 2 * parallel:
                done, pending = wait(pending, return_when=FIRST_COMPLETED)
                drain(done)
        drain(pending, last=True)
    return spark.read.schema(REPORT).parquet(table)


def convert_folder(
    spark: SparkSession,
    path: str,
    folder: str,
    options: Options = Options(),
    recursive: bool = False,
    force: bool = False,
    by_folder: bool = False,
    parallel: int = 4,
) -> DataFrame:
    """Convert the supported files of a folder that have no output yet, or all with `force`."""
    listing = list_files(spark, path, recursive)
    existing = None if force else existing_outputs(spark, folder)
    if by_folder:
        found = folders(listing.filter("supported"))
        sources = sources_by_folder(spark, found if existing is None else without_existing(found, existing, "output"))
    else:
        sources = sources_by_file(to_convert(listing, existing))
    return convert_all(spark, sources, folder, options, parallel)


def batch_totals(report: DataFrame) -> DataFrame:
    """Files done, source and Parquet megabytes, and the overall ratio (1.0 without input)."""
    return size_totals(report.withColumn("__done", F.col("status") == "completed"), "source_bytes", "parquet_bytes", "__done")
