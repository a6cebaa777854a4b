"""Feature records: rows of `map<name, struct<kind, bytes, floats, ints>>`, and their statistics.

`kind` is `bytes_list`, `float_list` or `int64_list`; only the list of that kind is filled. This is
the row form of the TFRecord reader, and `to_records` gives any table the same form.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.operators.ordering import quoted

FEATURE = "struct<kind:string,bytes:array<binary>,floats:array<float>,ints:array<bigint>>"
RECORD = f"map<string,{FEATURE}>"
# Kind name -> field of the struct that holds its list.
KINDS = {"bytes_list": "bytes", "float_list": "floats", "int64_list": "ints"}

_INTS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_FLOATS = (T.FloatType, T.DoubleType)


def _feature(col: Column, kind: T.DataType) -> Column:
    listed, item = (col, kind.elementType) if isinstance(kind, T.ArrayType) else (F.array(col), kind)
    if isinstance(item, _INTS):
        name, items = "int64_list", listed.cast("array<bigint>")
    elif isinstance(item, _FLOATS):
        name, items = "float_list", listed.cast("array<float>")
    else:
        name, items = "bytes_list", F.transform(listed, lambda v: v.cast("string").cast("binary"))
    present = F.filter(items, lambda v: v.isNotNull())
    fields = [
        (present if KINDS[name] == field else F.lit(None)).cast(f"array<{inner}>").alias(field)
        for field, inner in (("bytes", "binary"), ("floats", "float"), ("ints", "bigint"))
    ]
    return F.struct(F.lit(name).alias("kind"), *fields)


def to_records(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Pack columns into a `record` map, one feature per column."""
    pairs = []
    for name in columns:
        pairs += [F.lit(name), _feature(F.col(quoted(name)), df.schema[name].dataType)]
    return df.select(*keep, F.create_map(*pairs).alias("record"))


def feature_kinds(records: DataFrame) -> DataFrame:
    """Name and kind of every feature that occurs in any record."""
    entries = records.select(F.explode("record").alias("feature", "value"))
    return entries.select("feature", F.col("value.kind").alias("kind")).distinct()


def _cells(field: str, inner: str) -> Column:
    """One list of a feature as structs with one field per kind."""
    def cell(v: Column) -> Column:
        return F.struct(
            (v if field == "ints" else F.lit(None)).cast("bigint").alias("i"),
            (v if field == "floats" else F.lit(None)).cast("double").alias("f"),
            (v if field == "bytes" else F.lit(None)).cast("binary").alias("b"),
        )
    return F.transform(F.coalesce(F.col(f"value.{field}"), F.array().cast(f"array<{inner}>")), cell)


def feature_statistics(
    records: DataFrame, limit: int | None = None, order: Sequence[str] = ()
) -> DataFrame:
    """Type, count, unique values, mean or mode, minimum and maximum of each feature.

    Lists are flattened. Values are counted first, so a feature is reduced to its distinct values
    before it meets in one place, and the most frequent value needs no buffer per feature.
    `limit` restricts the statistics to the first records in `order`.
    """
    if limit is not None:
        records = records.orderBy(*order).limit(limit)
    entries = records.select(F.explode("record").alias("feature", "value"))
    cells = F.concat(_cells("ints", "bigint"), _cells("floats", "float"), _cells("bytes", "binary"))
    cells = entries.select("feature", "value.kind", F.explode_outer(cells).alias("cell"))
    empty = F.col("cell.i").isNull() & F.col("cell.f").isNull() & F.col("cell.b").isNull()
    per_value = (
        cells.select("feature", F.when(~empty, F.col("kind")).alias("kind"), "cell")
        .groupBy("feature", "kind", "cell")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    text = F.col("cell.b").cast("string")
    per_value = per_value.select(
        "feature", "kind", "n", "cell.i", "cell.f",
        F.coalesce(F.col("cell.f"), F.col("cell.i").cast("double")).alias("number"),
        F.when(F.is_valid_utf8(text), text).alias("text"),
    )
    grouped = per_value.groupBy("feature", "kind").agg(
        F.sum("n").alias("n"),
        F.count(F.lit(1)).alias("distinct"),
        F.sum(F.col("number") * F.col("n")).alias("sum"),
        F.min("i").alias("min_i"), F.max("i").alias("max_i"),
        F.min("f").alias("min_f"), F.max("f").alias("max_f"),
        F.count("text").alias("decoded"),
        F.min_by("text", F.struct(-F.col("n"), "text")).alias("mode"),
    )
    # A feature with no value at all gives one N/A row; empty lists next to filled ones add nothing.
    # The window sees at most one row per feature and kind.
    grouped = grouped.withColumn("some", F.max(F.col("kind").isNotNull()).over(Window.partitionBy("feature")))
    grouped = grouped.filter(F.col("kind").isNotNull() | ~F.col("some"))
    numeric, known = F.col("kind").isin("int64_list", "float_list"), F.col("kind").isNotNull()
    mean = F.bround(F.col("sum") / F.col("n"), 4).cast("string")
    mode = F.when(F.col("decoded") == F.col("distinct"), F.col("mode"))

    def bound(side: str) -> Column:
        whole, real = F.col(f"{side}_i").cast("string"), F.col(f"{side}_f").cast("string")
        return F.coalesce(whole, real, F.lit("-")).alias(side)

    return grouped.select(
        "feature",
        F.when(numeric, "Numeric").when(known, "Bytes").otherwise("N/A").alias("type"),
        F.when(known, F.col("n")).otherwise(0).alias("count"),
        F.when(known, F.col("distinct")).otherwise(0).alias("unique"),
        F.coalesce(F.when(numeric, mean), F.when(known & ~numeric, mode), F.lit("-")).alias("mean_or_mode"),
        bound("min"),
        bound("max"),
    )


def _python_bytes(value: Column) -> Column:
    """`b'..'` with printable ASCII as it is and `\\xNN` for the rest."""
    places = F.sequence(F.lit(1), F.length(value))
    codes = F.transform(places, lambda i: F.hex(F.substring(value, i, F.lit(1))))
    shown = F.transform(codes, lambda h: F.when(
        (F.conv(h, 16, 10).cast("int").between(32, 126)) & ~h.isin("5C", "27"), F.unhex(h).cast("string")
    ).otherwise(F.concat(F.lit("\\x"), F.lower(h))))
    return F.concat(F.lit("b'"), F.when(F.length(value) > 0, F.array_join(shown, "")).otherwise(""), F.lit("'"))


def texts(feature: Column) -> Column:
    """The bytes list as text; if one element is not UTF-8 all are shown in bytes form."""
    decoded = F.transform(feature["bytes"], lambda b: b.cast("string"))
    valid = F.forall(decoded, F.is_valid_utf8)
    return F.when(valid, decoded).otherwise(F.transform(feature["bytes"], _python_bytes))


def _json_items(feature: Column) -> Column:
    quoted = F.transform(texts(feature), lambda s: F.regexp_extract(F.to_json(F.array(s)), r"(?s)^\[(.*)\]$", 1))
    return F.when(feature["kind"] == "bytes_list", quoted).when(
        feature["kind"] == "float_list", F.transform(feature["floats"], lambda v: v.cast("double").cast("string"))
    ).otherwise(feature["ints"].cast("array<string>"))


def record_json(record: Column) -> Column:
    """One record as JSON, indented by two, features in name order."""
    entries = F.array_sort(F.map_keys(record))

    def line(name: Column) -> Column:
        items = _json_items(record[name])
        body = F.when(F.size(items) > 0, F.concat(
            F.lit("[\n    "), F.array_join(items, ",\n    "), F.lit("\n  ]"))).otherwise("[]")
        return F.concat(F.lit('  "'), name, F.lit('": '), body)

    return F.when(F.size(entries) > 0, F.concat(
        F.lit("{\n"), F.array_join(F.transform(entries, line), ",\n"), F.lit("\n}"))).otherwise("{}")


def _cell(feature: Column) -> Column:
    quoted = F.transform(texts(feature), lambda s: F.concat(F.lit("'"), s, F.lit("'")))
    plain = F.when(feature["kind"] == "bytes_list", texts(feature)).when(
        feature["kind"] == "float_list", F.transform(feature["floats"], lambda v: v.cast("double").cast("string"))
    ).otherwise(feature["ints"].cast("array<string>"))
    listed = F.when(feature["kind"] == "bytes_list", quoted).otherwise(plain)
    several = F.concat(F.lit("["), F.array_join(listed, ", "), F.lit("]"))
    return F.coalesce(F.when(F.size(plain) == 1, plain[0]).otherwise(several), F.lit(""))


def flatten_records(records: DataFrame, headers: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """One text column per feature: one-element lists unwrapped, missing features empty."""
    cells = [
        F.when(F.col("record")[h].isNotNull(), _cell(F.col("record")[h])).otherwise("").alias(h)
        for h in sorted(headers)
    ]
    return records.select(*keep, *cells)


def all_headers(records: DataFrame) -> list[str]:
    """Feature names that occur in any record: the columns of the flat table.

    Names meet once per task and name; the list is as long as the table will be wide.
    """
    names = records.select(F.explode(F.map_keys("record")).alias("name")).distinct()
    return sorted(r["name"] for r in names.collect())
