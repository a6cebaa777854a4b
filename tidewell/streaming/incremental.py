"""Conversion of newly arrived files as a stream."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidewell.session import shared_folder
from tidewell.sources.sinks import CODECS
from tidewell.sources.tabular import RAW

LISTING_KEY = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
LISTING_WAVES = 4


def arriving(
    spark: SparkSession, path: str, kind: str, schema: T.StructType | str, files_per_batch: int = 1000, rejects: bool = False,
    bytes_per_batch: int | None = None, **options: str
) -> DataFrame:
    """A stream over the files of a folder. Its schema is fixed, later files cannot change it.

    A batch takes `files_per_batch` files; with `bytes_per_batch` instead as many as have that size together, so that the number of batches follows
    the data and not the number of files.

    Text that does not fit the schema fails the run, which can be repeated once the file is mended; `mode` says otherwise. With `rejects`, lines
    of CSV or JSON that do not fit come along in `__raw_line`, for `convert_with_rejects`; short CSV lines are filled with nulls, as in a batch.
    """
    bound = {"maxBytesPerTrigger": bytes_per_batch} if bytes_per_batch else {"maxFilesPerTrigger": files_per_batch}
    if rejects:
        if kind not in ("csv", "json"):
            raise ValueError("only lines of csv or json can be put apart")
        columns = spark.createDataFrame([], schema).schema
        lines = spark.readStream.format(kind).schema(T.StructType([*columns, T.StructField(RAW, T.StringType())])).options(**bound)
        found = lines.options(**{"mode": "PERMISSIVE", "columnNameOfCorruptRecord": RAW, "escape": '"', **options}).load(path)
        return _filled(found, columns, options) if kind == "csv" else found
    options = {"mode": "FAILFAST", **options} if kind in ("csv", "json") else options
    reader = spark.readStream.format(kind).schema(schema).options(**bound)
    return reader.options(**options).load(path)


def _filled(found: DataFrame, columns: T.StructType, options: dict[str, str]) -> DataFrame:
    """Short lines with empty fields at their end, read again; what still does not fit stays as it is."""
    sep = options.get("sep", ",")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in [*columns, T.StructField(RAW, T.StringType())])
    parse = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": RAW, "escape": '"', "sep": sep}
    missing = F.sequence(F.lit(1), F.lit(max(1, len(columns) - 1)))
    tried = F.transform(missing, lambda n: F.from_csv(F.concat(F.col(RAW), F.repeat(F.lit(sep), n)), schema, parse))
    fits = F.when(F.col(RAW).isNotNull(), F.get(F.filter(tried, lambda r: r[RAW].isNull()), F.lit(0)))
    again = F.col("__fits").isNotNull()
    kept = [F.when(again, F.col("__fits")[f.name]).otherwise(F.col(f"`{f.name}`")).alias(f.name) for f in columns]
    return found.withColumn("__fits", fits).select(*kept, F.when(~again, F.col(RAW)).alias(RAW))


@contextmanager
def _few_listing_tasks(spark: SparkSession) -> Iterator[None]:
    """Meanwhile Spark looks up the files of a batch in a few tasks per core; by default it takes a task for each of up to 10,000 files."""
    before = spark.conf.get(LISTING_KEY, None)
    most = LISTING_WAVES * spark.sparkContext.defaultParallelism
    spark.conf.set(LISTING_KEY, str(min(int(before or most), most)))
    try:
        yield
    finally:
        spark.conf.set(LISTING_KEY, before) if before else spark.conf.unset(LISTING_KEY)


def convert_with_rejects(stream: DataFrame, out: str, rejects: str, checkpoint: str | None = None, codec: str = "snappy") -> StreamingQuery:
    """Appends what fits to the table at `out` and the `line` of what does not to the one at `rejects`, then stops.

    Each batch is a folder `batch=<number>` of both tables and overwrites it, so a batch that is run again adds nothing. How many lines a
    batch put apart is the number of its rows in `rejects`.
    """
    place = checkpoint or shared_folder(stream.sparkSession, "stream-checkpoint")

    def write(batch: DataFrame, number: int) -> None:
        batch.persist()
        for path, rows in ((out, batch.where(F.col(RAW).isNull()).drop(RAW)), (rejects, batch.where(F.col(RAW).isNotNull()).select(F.col(RAW).alias("line")))):
            rows.write.mode("overwrite").option("compression", CODECS[codec]).parquet(f"{path.rstrip('/')}/batch={number}")
        batch.unpersist()

    with _few_listing_tasks(stream.sparkSession):
        query = stream.writeStream.foreachBatch(write).trigger(availableNow=True).option("checkpointLocation", place).start()
        query.awaitTermination()
    return query


def convert_new_files(
    stream: DataFrame, out: str, checkpoint: str | None = None, codec: str = "snappy", partition_by: tuple[str, ...] = ()
) -> StreamingQuery:
    """Append everything that has arrived since the last run to a Parquet table, then stop.

    The checkpoint remembers which files are done, so running again converts only new ones and a
    lost run is picked up where it ended.
    """
    place = checkpoint or shared_folder(stream.sparkSession, "stream-checkpoint")
    writer = (
        stream.writeStream.format("parquet").outputMode("append").trigger(availableNow=True)
        .option("checkpointLocation", place).option("compression", CODECS[codec])
    )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    with _few_listing_tasks(stream.sparkSession):
        query = writer.start(out)
        query.awaitTermination()
    return query
