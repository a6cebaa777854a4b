"""Status of files that are on their way, kept from one run of a stream to the next."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from tidewell.session import shared_folder

PROVIDER_KEY = "spark.sql.streaming.stateStore.providerClass"
# State in RocksDB under the checkpoint: it is not held in memory, and survives lost executors.
PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
KEPT = "progress double, reached double, status string"


class _Status(StatefulProcessor):
    """Per file the last progress, the progress and the status that it has reached."""

    def __init__(self, names: Sequence[str], order: Sequence[str], event: str, progress: str) -> None:
        self.names, self.order, self.event, self.progress = list(names), list(order), event, progress

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.kept = handle.getValueState("kept", KEPT)

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues: object) -> Iterator[Row]:
        told_row = Row(*self.names)
        last, reached, status = self.kept.get() if self.kept.exists() else (0.0, 0.0, None)
        # Rows of one file in one batch.
        for row in sorted(rows, key=lambda r: tuple(r[c] for c in self.order)):
            kind, value = row[self.event], row[self.progress]
            told = "completed" if value is not None and value >= 100 else "in_progress" if value is not None and value > 0 else None
            if value is not None and last is not None and int(last / 10) < int(value / 10):
                yield told_row(*key, *(row[c] for c in self.order), "milestone", value, last, told)
            last = value
            status = (told if kind == "progress" else kind) or status
            reached = 100.0 if kind in ("completed", "skipped") else value if kind == "progress" and value is not None else reached
        self.kept.update((last, reached, status))
        yield told_row(*key, *[None] * len(self.order), "status", reached, None, status or "pending")

    def close(self) -> None:
        pass


def running_status(log: DataFrame, key: Sequence[str], order: Sequence[str], event: str, progress: str) -> DataFrame:
    """Milestones and the status of each file, from a stream of log rows that arrive in order.

    A row with `what` = `milestone` is an update that passes a multiple of ten percent, told once, with its place in `order` and the progress before it; also over several
    runs of the stream. A row with `what` = `status` has the status and progress of a file after a batch that named it. `event` and `progress` are those of `catalog.latest_status`.
    """
    fields = {f.name: f.dataType for f in log.schema}
    columns = [T.StructField(c, fields[c]) for c in (*key, *order)]
    out = T.StructType([*columns, T.StructField("what", T.StringType()), T.StructField("progress", T.DoubleType()),
                        T.StructField("old_progress", T.DoubleType()), T.StructField("status", T.StringType())])
    asked = log.select(*dict.fromkeys([*key, *order, event]), F.col(progress).cast("double").alias(progress))
    return asked.groupBy(*key).transformWithState(_Status(out.names, order, event, progress), out, "Append", "None")


def follow(status: DataFrame, out: str, checkpoint: str | None = None) -> StreamingQuery:
    """Writes what has happened since the last run, a folder `batch=<number>` per batch, then stops. A batch that is run again overwrites its folder."""
    spark = status.sparkSession
    place = checkpoint or shared_folder(spark, "stream-checkpoint")

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out.rstrip('/')}/batch={number}")

    before = spark.conf.get(PROVIDER_KEY, None)
    spark.conf.set(PROVIDER_KEY, PROVIDER)
    try:
        query = status.writeStream.foreachBatch(write).outputMode("append").trigger(availableNow=True).option("checkpointLocation", place).start()
        query.awaitTermination()
    finally:
        spark.conf.set(PROVIDER_KEY, before) if before else spark.conf.unset(PROVIDER_KEY)
    return query


def latest(followed: DataFrame, key: Sequence[str]) -> DataFrame:
    """The status of each file after the last batch that named it, out of the table that `follow` writes."""
    told = followed.where("what = 'status'").groupBy(*key).agg(F.max_by(F.struct("status", "progress"), "batch").alias("last"))
    return told.select(*key, "last.*")
