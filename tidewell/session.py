"""Session settings shared by jobs, tests and the benchmark."""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile
import uuid
import weakref

from pyspark.sql import DataFrame, SparkSession

# Rows that one ordered task may hold. Groups above it are split by `operators.ordering`.
TASK_ROWS_KEY = "spark.tidewell.taskRows"
TASK_ROWS = 1_000_000
# Bytes of text that one ordered task may hold: wide rows are split earlier.
TASK_BYTES_KEY = "spark.tidewell.taskBytes"
TASK_BYTES = 64 << 20

_roots: dict[str, str] = {}
_places: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()


def build_session(app: str = "tidewell", master: str | None = None, **conf: str) -> SparkSession:
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        **conf,
    }
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def task_rows(spark: SparkSession) -> int:
    return int(spark.conf.get(TASK_ROWS_KEY, str(TASK_ROWS)))


def task_bytes(spark: SparkSession) -> int:
    return int(spark.conf.get(TASK_BYTES_KEY, str(TASK_BYTES)))


def _own_root(app: str) -> str:
    """One folder per application of a plain local master, removed when Python ends."""
    if app not in _roots:
        _roots[app] = tempfile.mkdtemp(prefix="run-")
        atexit.register(shutil.rmtree, _roots[app], ignore_errors=True)
    return _roots[app]


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder for written tables and streaming checkpoints.

    It lies under `spark.checkpoint.dir`, which a cluster points at shared storage. Only a plain local
    master, whose tasks all run in the driver's process, gets a folder of its own without that setting.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors can reach")
        root = _own_root(spark.sparkContext.applicationId)
    return os.path.join(root, f"{purpose}-{uuid.uuid4().hex[:12]}")


def _place(spark: SparkSession, path: str) -> tuple[object, object]:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def removed_at_end(spark: SparkSession, path: str) -> None:
    """Lets the driver's JVM remove a folder when the application ends."""
    files, place = _place(spark, path)
    files.deleteOnExit(place)


def settled(df: DataFrame, purpose: str) -> DataFrame:
    """An intermediate result as a table in the shared folder, which goes when the application ends.

    Spark then knows its true size before it plans a join: a small one is broadcast under the usual
    threshold and the large side is not shuffled at all; a large one takes the shuffle join. It also
    survives lost executors without being computed again.
    """
    path = shared_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    removed_at_end(df.sparkSession, path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    _places[table] = path
    return table


def released(*tables: DataFrame) -> None:
    """Removes `settled` tables now. Nothing that is still to be computed may read them."""
    for table in tables:
        path = _places.pop(table, None)
        if path:
            files, place = _place(table.sparkSession, path)
            files.delete(place, True)
            files.cancelDeleteOnExit(place)
