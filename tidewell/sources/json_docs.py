"""JSON files in the shapes people keep tables in."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.session import settled
from tidewell.sources import json_scan, ranges

# A longer line is not looked at as a line: it belongs to a document.
LINE_BYTES = 16 << 20


def is_document(line: Column) -> Column:
    """Whether a text is a JSON object or array."""
    text = F.trim(line)
    ends = F.concat(F.substring(text, 1, 1), F.substring(text, -1, 1))
    return ends.isin("{}", "[]") & F.try_parse_json(text).isNotNull()


def is_json_lines(lines: DataFrame, value: str = "value", group: Sequence[str] = ()) -> DataFrame:
    """Per group, whether there are non-blank lines and each one is an object or array."""
    text = F.trim(F.col(value))
    kept = lines.filter(text != "")
    return kept.groupBy(*group).agg(
        F.count(F.lit(1)).alias("lines"), F.bool_and(is_document(F.col(value))).alias("json_lines"))


def file_shapes(spark: SparkSession, path: str | Sequence[str], glob: str | None = None) -> DataFrame:
    """`file` and `shape` of each file with text, from all its lines of up to `LINE_BYTES`.

    `lines`: at least half of the lines are documents, the others are damaged. `scalars`: every line is a list of scalars. `list` and
    `object`: one document over several lines, or on one that is longer. `none`: no document.
    """
    text = F.trim("value")
    lines = _text(spark, path, glob, LINE_BYTES).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("begin"), F.monotonically_increasing_id().alias("line"), text.alias("value"),
    ).where("value <> ''")
    document = is_document(F.col("value"))
    found = lines.groupBy("file").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(document).alias("documents"),
        F.bool_and(document & F.col("value").rlike(r"^\[\s*[^\s{\[\]]")).alias("scalars"),
        F.substring(F.min_by("value", F.struct("begin", "line")), 1, 1).alias("first"))
    shape = (
        F.when(F.col("scalars"), "scalars").when(2 * F.col("documents") >= F.col("n"), "lines")
        .when(F.col("first") == "{", "object").when(F.col("first") == "[", "list").otherwise("none"))
    found = found.select("file", shape.alias("shape"))
    large = _large_files(spark, path, glob)
    if large.isEmpty():
        return found
    found = settled(found, "json-shapes")
    long = settled(large.join(found, "file", "left_anti"), "long-lines")
    if long.isEmpty():
        return found
    # Files of long lines alone are told by how they begin.
    heads = ranges.pieces(spark, path, ",", glob).where("begin = 0").join(long, "file", "left_semi").groupBy("file").agg(F.substring(F.trim(F.min_by("value", "at")), 1, 1).alias("head"))
    shape = F.when(F.col("head") == "{", "object").when(F.col("head") == "[", "list").otherwise("none")
    return found.unionByName(heads.where("head <> ''").select("file", shape.alias("shape")))


def _text(spark: SparkSession, path: str | Sequence[str], glob: str | None, longest: int | None = None) -> DataFrame:
    reader = _reader(spark, glob)
    if not longest:
        return reader.text(path)
    # Hadoop's reader of lines leaves out those that are longer, but hands on the beginning of one that runs over the end of its range.
    return reader.option("mapreduce.input.linerecordreader.line.maxlength", longest).text(path).where(F.octet_length("value") < longest)


def _reader(spark: SparkSession, glob: str | None) -> DataFrameReader:
    return spark.read.option("pathGlobFilter", glob) if glob else spark.read


def _large_files(spark: SparkSession, path: str | Sequence[str], glob: str | None) -> DataFrame:
    """`file`: those that may have a line of more than `LINE_BYTES`; only their sizes are read."""
    return _reader(spark, glob).format("binaryFile").load(path).where(F.col("length") > LINE_BYTES).select(F.col("_metadata.file_path").alias("file"))


def _lines_alone(spark: SparkSession, path: str | Sequence[str], glob: str | None) -> DataFrame | None:
    """The rows, if every line of every file is a document: one pass finds that and the types. None if it is not so."""
    large = _large_files(spark, path, glob)
    if not large.isEmpty():
        short = _text(spark, path, glob, LINE_BYTES).select(F.col("_metadata.file_path").alias("file")).distinct()
        if not large.join(short, "file", "left_anti").isEmpty():
            return None
    schema = _reader(spark, glob).json(path).schema
    damaged = spark.conf.get("spark.sql.columnNameOfCorruptRecord", "_corrupt_record")
    if not schema.names or damaged in schema.names:
        return None
    return _reader(spark, glob).schema(schema).json(path)


def read_json(spark: SparkSession, path: str | Sequence[str], glob: str | None = None) -> DataFrame:
    """Rows of JSON lines, an array of records, columns of lists, one object, or a list of scalars.

    The shape is decided per file, over all its lines; files of several shapes are read apart and their columns united.
    Damaged lines of a file of lines stay in `_corrupt_record`. A document that runs over several lines is cut into its elements by ranges; damage in it, or
    anything after it, fails.
    """
    lines = _lines_alone(spark, path, glob)
    if lines is not None:
        return lines
    # Written once: their number and the files of each shape come from it, and all files are read for it.
    shapes = settled(file_shapes(spark, path, glob), "file-shapes")
    kinds = {r["shape"]: r["n"] for r in shapes.groupBy("shape").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not kinds or "none" in kinds:
        raise ValueError(f"no JSON document in {path}")
    frames = []
    for kind in sorted(kinds):
        # One read of the whole path where all files have one shape; else the files of each shape.
        chosen = path if len(kinds) == 1 else [r["file"] for r in shapes.where(F.col("shape") == kind).select("file").collect()]
        try:
            frames += _read_shape(spark, chosen, glob if len(kinds) == 1 else None, kind)
        except PySparkException as error:
            # Raised in a task, told like damage that the driver finds.
            damage = re.search(r"damaged JSON document in \S+", str(error))
            if damage:
                raise ValueError(damage.group()) from error
            raise
    return _united(frames)


def _read_shape(spark: SparkSession, path: str | Sequence[str], glob: str | None, kind: str) -> list[DataFrame]:
    if kind == "lines":
        return [_reader(spark, glob).json(path)]
    if kind == "scalars":
        return [scalars_to_rows(_text(spark, path, glob).where(F.trim("value") != ""))]
    if kind == "object":
        try:
            return [_from_lines(json_scan.rows_of_columns(spark, path, glob))]
        except json_scan.UnevenColumns as error:
            # The document is sound, its rows are not: whoever asks for them is told.
            return [spark.range(1).select(F.raise_error(F.lit(str(error))).cast("string").alias("value"))]
    # Cut and checked once; types are found, and rows read, from the lines.
    values = settled(json_scan.values_of_lists(spark, path, glob), "json-values")
    record = F.substring(F.regexp_replace("text", r"^\s+", ""), 1, 1) == "{"
    mixed = settled(values.groupBy("file").agg(F.bool_and(record).alias("records")).where("not records").select("file"), "scalar-files")
    if mixed.isEmpty():
        return [_from_lines(values)]
    scalars = scalars_to_rows(values.join(mixed, "file", "left_semi").select(F.concat(F.lit("["), "text", F.lit("]")).alias("value")))
    records = values.join(mixed, "file", "left_anti")
    return [scalars] if records.isEmpty() else [_from_lines(records), scalars]


def _from_lines(texts: DataFrame) -> DataFrame:
    return texts.sparkSession.read.option("mode", "FAILFAST").json(json_scan.as_lines(texts))


def _united(frames: list[DataFrame]) -> DataFrame:
    """Rows of all frames; a column of different types is double if all are numbers, else text."""
    kinds: dict[str, list[T.DataType]] = {}
    for field in (f for frame in frames for f in frame.schema):
        kinds.setdefault(field.name, []).append(field.dataType)
    out = None
    for frame in frames:
        columns = []
        for name in frame.columns:
            col, own = F.col(f"`{name}`"), kinds[name]
            if any(k != own[0] for k in own):
                numbers = all(isinstance(k, T.NumericType) for k in own)
                nested = isinstance(frame.schema[name].dataType, (T.ArrayType, T.StructType))
                col = col.cast("double") if numbers else F.to_json(col) if nested else col.cast("string")
            columns.append(col.alias(name))
        part = frame.select(*columns)
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out


def scalars_to_rows(texts: DataFrame) -> DataFrame:
    """A list of scalars as the column `value`, typed by all its elements."""
    parsed = F.coalesce(
        F.from_json("value", "array<variant>"), F.raise_error(F.lit("damaged JSON document")).cast(T.NullType()))
    values = texts.select(F.explode(parsed).alias("v"))
    kind = values.agg(F.schema_of_variant_agg("v")).first()[0] or "STRING"
    if kind.startswith(("DECIMAL", "FLOAT", "DOUBLE")):
        kind = "DOUBLE"
    elif kind in ("VOID", "VARIANT"):
        kind = "STRING"
    return values.select(F.col("v").cast(kind).alias("value"))
