"""JSON documents of any size, cut into their elements by byte range.

A document is read as pieces between commas. What a piece does is known without its surroundings but for one bit: how many unescaped quotes it
has, and how many levels it opens or closes outside strings if it begins outside one, or inside. A range adds these up for both cases;
sums over the earlier ranges of a file then tell every range whether it begins in a string, and at which depth.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.session import removed_at_end, settled, shared_folder
from tidewell.sources import ranges

# A row that has the commas of its range, by depth, and the brackets of a document that begins or ends there.
COUNTS = 9
CUT = "file string, begin bigint, at bigint, part int, key bigint, item bigint, text string"


class UnevenColumns(ValueError):
    """The lists of an object are of different lengths."""


def _levels(text: Column) -> Column:
    return F.regexp_count(text, F.lit(r"[\[{]")) - F.regexp_count(text, F.lit(r"[\]}]"))


def _scanned(spark: SparkSession, paths: str | Sequence[str], glob: str | None) -> DataFrame:
    """Pieces with `odd` (an odd number of quotes) and the levels opened if they begin outside (`outer`) or inside a string (`inner`)."""
    plain = F.when(F.contains("value", F.lit("\\")), F.regexp_replace("value", r"(?s)\\.", "")).otherwise(F.col("value"))
    read = ranges.pieces(spark, paths, ",", glob).withColumn("plain", plain).withColumn("quotes", F.regexp_count("plain", F.lit('"')))
    strings = r'"[^"]*(?:"|$)'
    outer = F.when(F.col("quotes") > 0, F.regexp_replace("plain", strings, "")).otherwise(F.col("plain"))
    inner = F.when(F.col("quotes") > 0, F.regexp_replace(F.concat(F.lit('"'), "plain"), strings, "")).otherwise(F.lit(""))
    return read.select("file", "begin", "at", "value", (F.col("quotes") % 2 == 1).alias("odd"), _levels(outer).alias("outer"), _levels(inner).alias("inner"))


def _state(rows: pa.RecordBatch, inside: bool, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Whether a string is open, and the depth, after each piece."""
    odd, outer, inner = (rows[c].to_numpy(zero_copy_only=False) for c in ("odd", "outer", "inner"))
    after = (np.cumsum(odd) + inside) % 2 == 1
    return after, depth + np.cumsum(np.where(after ^ odd, inner, outer))


def _effects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per range: whether it has an odd number of quotes, and the levels it opens if it begins outside or inside a string."""
    found: dict[tuple[str, int], list] = {}
    for file, begin, _, rows in ranges.by_range(batches):
        have = found.setdefault((file, begin), [False, 0, 0])
        (after, outer), (_, inner) = _state(rows, have[0], have[1]), _state(rows, not have[0], have[2])
        found[file, begin] = [bool(after[-1]), int(outer[-1]), int(inner[-1])]
    keys, values = list(found), list(found.values())
    columns = [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.int64()), pa.array([v[0] for v in values], pa.bool_()),
               pa.array([v[1] for v in values], pa.int64()), pa.array([v[2] for v in values], pa.int64())]
    yield pa.RecordBatch.from_arrays(columns, names=["file", "begin", "odd", "outer", "inner"])


def _damaged(file: str) -> ValueError:
    return ValueError(f"damaged JSON document in {file}")


def _cut(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Elements between the commas at depth 1 to `most`, without the brackets of the document.

    An element has its address in the range: the commas at depth 1 before it, and those at depth 2 since the last of them.
    """
    now, inside, depth, held, crossing, at, key, item = None, False, 0, [], False, 0, 0, 0
    place, head, tail = (0, 0), "-", "-"

    def rest() -> list[tuple]:
        kind = ranges.MIDDLE if crossing else ranges.BEGIN
        return ([(*now, at, kind, *place, ",".join(held))] if held else []) + [(*now, 1 << 62, COUNTS, key, item, head + tail)]

    def told(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True)) if rows else [[]] * 7
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["file", "begin", "at", "part", "key", "item", "text"])

    for file, begin, fresh, rows in ranges.by_range(batches):
        out = []
        if fresh:
            out += rest() if now else []
            inside, depth = bool(rows["inside"][0].as_py()), int(rows["depth"][0].as_py())
            now, held, key, item, head, tail = (file, begin), [], 0, 0, "-", "-"
            # A range begins behind a comma, or with its file.
            crossing = begin > 0 and (inside or depth > most)
        after, depths = _state(rows, inside, depth)
        before = np.concatenate([[depth], depths[:-1]])
        pieces, places = rows["value"].to_pylist(), rows["at"].to_pylist()
        # Behind a comma that cuts, or at the end of the document.
        ends = ~after & (depths <= most)
        if (~after & (depths < 0)).any() or (before[1:] == 0).any() or (begin > 0 or not fresh) and before[0] == 0:
            raise _damaged(file)
        if not depths[-1] and not after[-1]:
            pieces[-1] = pieces[-1].rstrip()
            tail, pieces[-1] = pieces[-1][-1:], pieces[-1][:-1]
        if begin == 0 and fresh:
            first = pieces[0].removeprefix("\ufeff").lstrip()
            head, pieces[0] = first[:1], first[1:]
        if most == 1 and not held and not crossing and (ends & (depths == 1)).all():
            # Every piece is an element, as in a list of numbers.
            out += [(file, begin, p, ranges.WHOLE, key + i, 0, text) for i, (p, text) in enumerate(zip(places, pieces, strict=True))]
            key += len(pieces)
        else:
            for text, p, end, d in zip(pieces, places, ends.tolist(), depths.tolist(), strict=True):
                if not held:
                    at, place = p, (key, item)
                held.append(text)
                if end:
                    out.append((file, begin, at, ranges.END if crossing else ranges.WHOLE, *place, ",".join(held)))
                    held, crossing = [], False
                    key, item = (key + 1, 0) if d == 1 else (key, item + (d == 2))
        inside, depth = bool(after[-1]), int(depths[-1])
        yield told(out)
    if now:
        yield told(rest())


def elements(spark: SparkSession, paths: str | Sequence[str], glob: str | None = None, most: int = 1) -> DataFrame:
    """`file`, `key`, `item` and `text` of the elements of each document: what is between commas at depth 1, or up to depth 2.

    `key` counts the elements at depth 1 of a document, `item` those at depth 2 within one (0 if not cut there). The brackets of the document are taken off; that the texts are JSON
    is left to the reader. A document that does not close what it opens, or goes on behind its end, fails. One element is held by one task.
    """
    scanned = _scanned(spark, paths, glob)
    effects = settled(scanned.select("file", "begin", "odd", "outer", "inner").mapInArrow(_effects, "file string, begin bigint, odd boolean, outer bigint, inner bigint"), "json-ranges")
    earlier, so_far = ranges.in_file()
    sum_of = lambda c, w: F.coalesce(F.sum(c).over(w), F.lit(0))
    begun = effects.withColumn("inside", sum_of(F.col("odd").cast("int"), earlier) % 2 == 1).withColumn("opened", F.when(F.col("inside"), F.col("inner")).otherwise(F.col("outer")))
    begun = begun.withColumn("depth", sum_of("opened", earlier))
    ends = begun.groupBy("file").agg(F.max_by(F.struct((F.col("inside") != F.col("odd")).alias("open"), (F.col("depth") + F.col("opened")).alias("depth")), "begin").alias("last"))
    wrong = ends.where("last.open or last.depth <> 0").select("file").first()
    if wrong:
        raise _damaged(wrong["file"])
    parts = ranges.with_starts(scanned, begun.select("file", "begin", "inside", "depth")).mapInArrow(partial(_cut, most=most), CUT)
    # Written once, as the commas of the earlier ranges of a file are counted before its elements have their places.
    parts = settled(parts, "json-parts")
    counts = parts.where(F.col("part") == COUNTS)
    brackets = counts.groupBy("file").agg(F.concat(F.max(F.substring("text", 1, 1)), F.max(F.substring("text", 2, 1))).alias("ends"))
    wrong = brackets.where(~F.col("ends").isin("[]", "{}")).select("file").first()
    if wrong:
        raise _damaged(wrong["file"])
    counts = counts.select("file", "begin", F.col("key").alias("keys"), F.col("item").alias("items"))
    # Commas at depth 2 of all ranges so far, and what they were at the last comma at depth 1.
    counts = counts.withColumn("key0", sum_of("keys", earlier)).withColumn("total", sum_of("items", so_far))
    last = F.last(F.when(F.col("keys") > 0, F.col("total") - F.col("items")), ignorenulls=True).over(earlier)
    counts = counts.withColumn("item0", F.col("total") - F.col("items") - F.coalesce(last, F.lit(0))).select("file", "begin", "key0", "item0")
    texts = parts.where(F.col("part") != COUNTS)
    found = ranges.joined(texts.select("file", "begin", "at", "part", "text", "key", "item"), ",", ("key", "item"))
    placed = found.join(settled(counts, "json-counts"), ["file", "begin"])
    return placed.select("file", (F.col("key") + F.col("key0")).alias("key"), (F.col("item") + F.when(F.col("key") == 0, F.col("item0")).otherwise(0)).alias("item"), "text")


def checked(text: Column, file: Column) -> Column:
    """The text, if it is one JSON value; otherwise the job fails."""
    good = (F.trim(F.regexp_replace(text, r"\s", " ")) != "") & F.try_parse_json(F.concat(F.lit("["), text, F.lit("]"))).isNotNull()
    return F.when(good, text).otherwise(F.raise_error(F.concat(F.lit("damaged JSON document in "), file)).cast("string"))


def values_of_lists(spark: SparkSession, paths: str | Sequence[str], glob: str | None = None) -> DataFrame:
    """`file`, `text` of the elements of lists. A list of nothing has none."""
    found = elements(spark, paths, glob)
    # A blank element is an error, unless it is all that its list has.
    alone = found.groupBy("file").agg(F.max("key").alias("last")).where("last = 0")
    blank = found.where(F.col("key") == 0).where(F.regexp_replace("text", r"\s", "") == "").join(alone, "file", "left_semi").select("file")
    kept = found.join(settled(blank, "empty-lists"), "file", "left_anti")
    return kept.select("file", checked(F.col("text"), F.col("file")).alias("text"))


ENTRY = r'(?s)^\s*"((?:[^"\\]|\\.)*)"\s*:(.*)$'


def rows_of_columns(spark: SparkSession, paths: str | Sequence[str], glob: str | None = None) -> DataFrame:
    """`file`, `text` of the rows of objects whose values are lists, as JSON objects; single values are repeated. An object without lists is one row.

    The lists are cut as well, so no task holds a column: row i is put together from the elements i of the lists.
    """
    found = settled(elements(spark, paths, glob, most=2), "json-entries")
    entry = found.where("item = 0").select("file", "key", F.regexp_extract("text", ENTRY, 1).alias("name"), F.regexp_extract("text", ENTRY, 2).alias("rest"), "text")
    entry = settled(entry.withColumn("kind", F.substring(F.regexp_replace("rest", r"^\s+", ""), 1, 1)), "json-keys")
    # A blank entry is an error, unless it is all that its object has.
    bad = entry.groupBy("file").agg(F.count_if(F.col("kind") == "").alias("bad"), F.count_if(F.regexp_replace("text", r"\s", "") == "").alias("blank"), F.count(F.lit(1)).alias("n"))
    bad = bad.where("bad > 0 and not (n = 1 and blank = 1)").select("file").first()
    if bad:
        raise _damaged(bad["file"])
    entry = entry.where("kind <> ''")
    sizes = found.groupBy("file", "key").agg(F.max("item").alias("last"))
    told = settled(entry.join(sizes, ["file", "key"]).select("file", "key", "name", "kind", "last"), "json-columns")
    body = F.when(F.col("item") == 0, F.regexp_extract("text", ENTRY, 2)).otherwise(F.col("text"))
    valued = found.join(told, ["file", "key"]).withColumn("body", body)
    # Objects and strings that have commas at depth 2 are put together again: one value is held by one task.
    whole = valued.where("kind <> '['").groupBy("file", "key", "name").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("item", "body"))), lambda x: x["body"]), ",").alias("body"))
    listed = valued.where("kind = '['").select(
        "file", "name", "item", "last", F.when(F.col("item") == 0, F.regexp_replace("body", r"^\s*\[", "")).otherwise(F.col("body")).alias("body"))
    listed = listed.withColumn("body", F.when(F.col("item") == F.col("last"), F.regexp_replace("body", r"\]\s*$", "")).otherwise(F.col("body")))
    lists = told.where("kind = '['").groupBy("file").agg(F.min("last").alias("low"), F.max("last").alias("high"))
    uneven = lists.where("low <> high").select("file").first()
    if uneven:
        raise UnevenColumns(f"columns of a JSON document differ in length in {uneven['file']}")
    pair = lambda body: F.concat(F.lit('"'), "name", F.lit('":'), body)
    single = settled(whole.groupBy("file").agg(F.array_sort(F.collect_list(pair(checked(F.col("body"), F.col("file"))))).alias("single")), "json-single")
    # An empty list has one blank element.
    some = listed.where(~((F.col("last") == 0) & (F.regexp_replace("body", r"\s", "") == "")))
    rows = some.groupBy("file", "item").agg(F.array_sort(F.collect_list(pair(checked(F.col("body"), F.col("file"))))).alias("pairs"))
    rows = rows.join(single, "file", "left").select("file", F.concat("pairs", F.coalesce("single", F.array().cast("array<string>"))).alias("pairs"))
    alone = single.join(lists, "file", "left_anti").select("file", F.col("single").alias("pairs"))
    return rows.unionByName(alone).select("file", F.concat(F.lit("{"), F.array_join("pairs", ","), F.lit("}")).alias("text"))


def as_lines(texts: DataFrame, column: str = "text") -> str:
    """A folder with one line per value, which Spark reads in ranges. Line ends are white space between the parts of a value."""
    out = shared_folder(texts.sparkSession, "json-lines")
    texts.select(F.regexp_replace(column, r"[\r\n]+", " ").alias("value")).write.text(out)
    removed_at_end(texts.sparkSession, out)
    return out
