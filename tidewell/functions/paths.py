"""File names, formats and dataset paths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# File suffix -> format name. Any other suffix is "other".
FORMATS = {
    "csv": "csv",
    "json": "json",
    "jsonl": "json",
    "xls": "excel",
    "xlsx": "excel",
    "tsv": "tsv",
    "parquet": "parquet",
    "avro": "avro",
    "orc": "orc",
    "xml": "xml",
    "svg": "xml",
    "html": "html",
    "htm": "html",
    "txt": "txt",
    "md": "txt",
    "rst": "txt",
}
# Formats that a conversion accepts. Workbooks are recognised but have no reader here.
SUPPORTED = ("csv", "json", "excel", "tsv", "parquet")


def base_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def file_suffix(path: Column) -> Column:
    """Lower-case text after the last dot; a leading dot alone starts no suffix."""
    return F.lower(F.regexp_extract(base_name(path), r"^.+\.([^.]+)$", 1))


def file_stem(path: Column) -> Column:
    return F.regexp_replace(base_name(path), r"(?<=.)\.[^.]*$", "")


def detect_format(path: Column) -> Column:
    suffix = file_suffix(path)
    by_format: dict[str, list[str]] = {}
    for ending, kind in FORMATS.items():
        by_format.setdefault(kind, []).append(ending)
    (kind, endings), *others = by_format.items()
    chosen = F.when(suffix.isin(endings), kind)
    for kind, endings in others:
        chosen = chosen.when(suffix.isin(endings), kind)
    return chosen.otherwise("other")


def is_supported(kind: Column) -> Column:
    return kind.isin(list(SUPPORTED))


def output_name(relative: Column) -> Column:
    """`<stem>.parquet` with the folder part kept, so equal stems in two folders do not collide."""
    stem = F.regexp_replace(relative, r"(?<=[^/])\.[^./]*$", "")
    return F.concat(F.replace(stem, F.lit("/"), F.lit("__")), F.lit(".parquet"))


def safe_name(name: Column) -> Column:
    """Letters, digits, `-` and `_` stay; every other character becomes `_`."""
    return F.regexp_replace(name, r"[^\p{L}\p{N}_-]", "_")


def dataset_path(base: str, template: str, fields: dict[str, Column], at: Column) -> Column:
    """Fill a path template such as `datasets/{dataset_name}_{timestamp}`."""
    known = {**fields, "timestamp": F.date_format(at, "yyyyMMdd_HHmmss")}
    if "dataset_name" in known:
        known["dataset_name"] = safe_name(known["dataset_name"])
    path = F.lit(f"{base.rstrip('/')}/{template}")
    for field, value in known.items():
        path = F.replace(path, F.lit("{" + field + "}"), value.cast("string"))
    return path
