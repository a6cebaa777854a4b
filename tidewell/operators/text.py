"""Text preparation: lines, vocabularies, encoding, padding, batches, splits."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewell.operators.ordering import with_position

# The characters that count as white space at the ends of a line.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008"
    "\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
# The characters that part words.
BLANKS = " \t\n\r\f"
# Marker and padding tokens.
START, END, PAD = "[CLS]", "[SEP]", "[PAD]"
# Bytes of texts that Python looks up at once.
SLICE_BYTES = 2 << 20


def strip(col: Column) -> Column:
    return F.btrim(col, F.lit(WHITE_SPACE))


def corpus_lines(df: DataFrame, text: str, keep: Sequence[str] = ()) -> DataFrame:
    """Non-empty lines without white space at their ends, numbered from 0 in their document."""
    # Plain replacements first: splitting at one fixed character needs no regular expression.
    unix = F.replace(F.replace(F.col(text), F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n"))
    lines = df.select(*keep, F.posexplode(F.split(unix, "\n")).alias("line_no", "line"))
    return lines.withColumn("line", strip(F.col("line"))).filter(F.col("line") != "")


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """A text corpus: one trimmed, non-empty line per row."""
    return spark.read.text(path).select(strip(F.col("value")).alias("line")).filter(F.col("line") != "")


def shuffled(df: DataFrame, key: str, seed: int, name: str = "position") -> DataFrame:
    """Reproducible shuffle: each row's place in the order of its seeded key hash."""
    drawn = df.withColumn("__draw", F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string"))))
    return with_position(drawn, ["__draw", key], name=name).drop("__draw")


def split_corpus(df: DataFrame, draw: Column, shares: dict[str, float], name: str = "split") -> DataFrame:
    """Name the split of each row. `draw` is a number in [0, 1) that depends on the key alone."""
    bound, chosen = 0.0, None
    for split, share in shares.items():
        bound += share
        test = draw < F.lit(round(bound, 9))
        chosen = F.when(test, split) if chosen is None else chosen.when(test, split)
    return df.withColumn(name, chosen)


def hash_draw(key: str, seed: int = 0) -> Column:
    return F.pmod(F.xxhash64(F.col(key), F.lit(seed)), F.lit(1_000_000)) / 1_000_000


def _sliced(limit: int) -> Callable[[pa.Array], Iterator[pa.Array]]:
    """Cuts an array of texts into runs of rows with at most `limit` bytes; a longer text is a run of its own."""
    def runs(texts):
        import numpy as np
        import pyarrow.compute as pc

        ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < len(texts):
            before = int(ends[at - 1]) if at else 0
            to = max(at + 1, int(np.searchsorted(ends, before + limit, "right")))
            yield texts.slice(at, to - at)
            at = to

    return runs


def _character(code: Column) -> Column:
    return F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")


def char_vocabulary(df: DataFrame, text: str) -> DataFrame:
    """Sorted distinct characters with ids from 0: at most one row per Unicode code point.

    Each task reduces its texts to their distinct code points before anything is shuffled.
    """
    sliced = _sliced(SLICE_BYTES)

    def distinct_codes(batches):
        import numpy as np
        import pyarrow as pa

        seen = np.zeros(0x110000, dtype=bool)
        for batch in batches:
            for part in sliced(batch.column(0)):
                whole = "".join(t for t in part.to_pylist() if t is not None)
                seen[np.frombuffer(whole.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)] = True
        yield pa.RecordBatch.from_pydict({"code": np.flatnonzero(seen).astype(np.int32)})

    codes = df.select(F.col(text).cast("string")).mapInArrow(distinct_codes, "code int").distinct()
    place = F.row_number().over(Window.orderBy("code")) - 1
    return codes.select(_character(F.col("code")).alias("ch"), place.alias("id"))


def vocabulary_size(vocabulary: DataFrame) -> DataFrame:
    """The boundary id (number of characters) and the size with the boundary included."""
    return vocabulary.agg(F.count(F.lit(1)).alias("boundary_id")).withColumn("vocab_size", F.col("boundary_id") + 1)


@dataclass(frozen=True)
class CharCodec:
    """Literal lookup tables of a vocabulary; Unicode bounds them at 1,114,112 entries."""

    chars: tuple[str, ...]

    @classmethod
    def of(cls, vocabulary: DataFrame) -> "CharCodec":
        return cls(tuple(row["ch"] for row in sorted(vocabulary.collect(), key=lambda r: r["id"])))

    @property
    def boundary(self) -> int:
        return len(self.chars)

    def encode(self, text: Column) -> Column:
        """Ids of the characters with the boundary id on both sides; unknown characters are null.

        Some megabytes of texts are looked up at once in a table over code points, however large the Arrow batches are.
        """
        boundary, codes, sliced = self.boundary, [ord(c) for c in self.chars], _sliced(SLICE_BYTES)

        @F.arrow_udf("array<int>")
        def ids(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            import numpy as np
            import pyarrow as pa

            table = np.full(max(codes, default=0) + 2, -1, dtype=np.int32)
            table[codes] = np.arange(len(codes), dtype=np.int32)

            def looked_up(texts):
                plain = texts.to_pylist()
                flat = np.frombuffer("".join(t or "" for t in plain).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
                found = table[np.minimum(flat, len(table) - 1)]
                sizes = np.array([0 if t is None else len(t) + 2 for t in plain], dtype=np.int64)
                ends = np.cumsum(sizes)
                edge = np.zeros(int(ends[-1]) if len(ends) else 0, dtype=bool)
                some = sizes > 0
                edge[ends[some] - 1] = edge[(ends - sizes)[some]] = True
                values = np.full(len(edge), boundary, dtype=np.int32)
                values[~edge] = found
                offsets = np.concatenate([[0], ends]).astype(np.int32)
                return pa.ListArray.from_arrays(offsets, pa.array(values, mask=values < 0), mask=pa.array(~some))

            for texts in batches:
                for part in sliced(texts):
                    yield looked_up(part)

        return ids(text)

    def decode(self, ids: Column) -> Column:
        """Text of the ids after an opening boundary, up to the next boundary."""
        table = F.from_json(F.lit(json.dumps(self.chars)), "array<string>")
        opened = F.when(F.get(ids, F.lit(0)) == self.boundary, F.slice(ids, 2, F.greatest(F.size(ids) - 1, F.lit(0)))).otherwise(ids)
        end = F.array_position(opened, self.boundary)
        body = F.when(end > 0, F.slice(opened, F.lit(1), end.cast("int") - 1)).otherwise(opened)
        return F.array_join(F.transform(body, lambda i: F.get(table, i)), "")


def next_token_pairs(df: DataFrame, tokens: str, block_size: int, keep: Sequence[str] = ()) -> DataFrame:
    """(block, position, token, target): consecutive blocks of `block_size` tokens with the token after each.

    Every token but the first of a text is the target of exactly one row; positions count within the block.
    """
    ids = F.col(tokens)
    pairs = F.arrays_zip(F.slice(ids, F.lit(1), F.size(ids) - 1).alias("token"), F.slice(ids, F.lit(2), F.size(ids) - 1).alias("target"))
    told = df.filter(F.size(ids) > 1).select(*keep, F.posexplode(pairs).alias("at", "pair"))
    return told.select(
        *keep, F.floor(F.col("at") / block_size).cast("int").alias("block"), (F.col("at") % block_size).alias("position"), "pair.token", "pair.target")


def words(text: Column) -> Column:
    """White-space separated tokens; empty text has none."""
    trimmed = F.btrim(text, F.lit(BLANKS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, f"[{BLANKS}]+"))


def word_count(text: Column) -> Column:
    """The number of `words`, without an array of them."""
    return F.regexp_count(text, F.lit(f"[^{BLANKS}]+"))


def with_markers(tokens: Column, start: str | None = START, end: str | None = END) -> Column:
    parts = [F.array(F.lit(start))] if start else []
    parts.append(tokens)
    if end:
        parts.append(F.array(F.lit(end)))
    return F.concat(*parts)


def padded(tokens: Column, length: Column, pad: str = PAD, truncate: bool = False) -> Column:
    """`input` padded to `length` and `mask` with 1 on tokens and 0 on padding.

    Longer sequences stay whole unless `truncate` is set.
    """
    kept = F.slice(tokens, F.lit(1), length) if truncate else tokens
    gap = F.greatest(length - F.size(kept), F.lit(0))
    ones = F.array_repeat(F.lit(1), F.size(kept))
    return F.struct(
        F.concat(kept, F.array_repeat(F.lit(pad), gap)).alias("input"),
        F.concat(ones, F.array_repeat(F.lit(0), gap)).alias("mask"),
    )


def max_length(df: DataFrame, tokens: str) -> DataFrame:
    return df.agg(F.coalesce(F.max(F.size(tokens)), F.lit(0)).alias("max_length"))


def save_settings(spark: SparkSession, path: str, **settings: object) -> None:
    """Keep tokenizer settings, such as the maximum length, as a table of names and JSON values."""
    rows = [(name, json.dumps(value)) for name, value in settings.items()]
    spark.createDataFrame(rows, "name string, value string").coalesce(1).write.mode("overwrite").parquet(path)


def load_settings(spark: SparkSession, path: str) -> dict[str, object]:
    return {row["name"]: json.loads(row["value"]) for row in spark.read.parquet(path).collect()}


def with_batches(df: DataFrame, order: Sequence[str], size: int = 32, name: str = "batch") -> DataFrame:
    """Number consecutive runs of `size` rows."""
    placed = with_position(df, order, name="__at")
    return placed.withColumn(name, F.floor(F.col("__at") / size)).drop("__at")


def padded_batches(
    df: DataFrame, tokens: str | Column, order: Sequence[str], size: int = 32, pad: str = PAD, out: str = "padded"
) -> DataFrame:
    """Mini-batches with each row padded to the longest of its own batch: one long text widens one batch only.

    `tokens` may be an expression, which is worked out once, when the rows are in their batches.
    """
    # A batch is dealt to one task, many batches to each.
    dealt = with_batches(df, order, size).repartition("batch")
    told = dealt.withColumn("__tokens", F.col(tokens) if isinstance(tokens, str) else tokens)
    sized = told.withColumn("__width", F.max(F.size("__tokens")).over(Window.partitionBy("batch")))
    return sized.withColumn(out, padded(F.col("__tokens"), F.col("__width"), pad)).drop("__tokens", "__width")
