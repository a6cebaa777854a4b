"""Helpers of the text operators: word hashes in numpy, fixed-size id filters, connected components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.session import settled

BASE = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
LEFT, RIGHT, THIRD = np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9), np.uint64(0x27D4EB2F165667C5)
# Bytes of text that are hashed at a time. A longer text is hashed in parts that end at a word.
PART_BYTES = 1 << 21
SPACES = b"\x20\x09\x0a\x0b\x0c\x0d"
IS_SPACE = np.zeros(256, bool)
IS_SPACE[list(SPACES)] = True
FILTER_BITS = 23
# Bytes of narrow rows for which a task of their own is worth while. Every file that a task writes costs an executor a few
# helper processes where Hadoop sets permissions by a command.
FILE_BYTES = 1 << 20
# An edge, or an id and its component.
EDGE_BYTES = 16

_powers: dict[str, np.ndarray] = {}


CLEANUP_KEY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def in_files(df: DataFrame, size: int) -> DataFrame:
    """`df` in no more partitions than `size` bytes fill, whatever the number of shuffle partitions; never in more than it has."""
    return df.coalesce(max(1, -(-size // FILE_BYTES)))


def stored(df: DataFrame, purpose: str, size: int | None = None) -> DataFrame:
    """`settled`, after which the shuffle files behind the written table are removed at once.

    With `size`, about the bytes it has at most, no more files are written than these fill.
    """
    conf = df.sparkSession.conf
    df = df if size is None else in_files(df, size)
    before = conf.get(CLEANUP_KEY, "false")
    conf.set(CLEANUP_KEY, "true")
    try:
        return settled(df, purpose)
    finally:
        conf.set(CLEANUP_KEY, before)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _power(base: np.uint64, name: str, n: int) -> np.ndarray:
    have = _powers.get(name)
    if have is None or len(have) < n:
        steps = np.full(max(n, PART_BYTES + 4096), base, np.uint64)
        steps[0] = 1
        have = _powers[name] = np.cumprod(steps)
    return have


def _hash_part(part: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and hash of every word of a byte array."""
    space = IS_SPACE[part]
    edge = np.flatnonzero(np.diff(space, prepend=True, append=True))
    start, end = edge[::2], edge[1::2]
    if not len(start):
        return start, np.zeros(0, np.uint64)
    total = np.zeros(len(part) + 1, np.uint64)
    np.cumsum((part.astype(np.uint64) + np.uint64(1)) * _power(BASE, "up", len(part))[: len(part)], out=total[1:])
    value = (total[end] - total[start]) * _power(INVERSE, "down", len(part))[start]
    return start, mix(value + (end - start).astype(np.uint64) * LEFT)


def word_hashes(texts: list[str | None], lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words `[^\\x20\\x09-\\x0D]+` of the texts, and the offset of each text's first word.

    `lower` lower-cases A-Z only. A null text has no words.
    """
    raw = [b"" if t is None else t.encode("utf-8", "surrogatepass") for t in texts]
    sizes = np.array([len(r) + 1 for r in raw], np.int64)
    joined = b"\n".join(raw) + b"\n"
    joined = joined.lower() if lower else joined
    data = np.frombuffer(joined, np.uint8)
    starts, hashes, at = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)], 0
    while at < len(data):
        to = min(len(data), at + PART_BYTES)
        while to < len(data) and not IS_SPACE[data[to - 1]]:
            to += 1
        start, value = _hash_part(data[at:to])
        starts.append(start + at)
        hashes.append(value)
        at = to
    first = np.concatenate([[0], np.cumsum(sizes)])
    return np.concatenate(hashes), np.searchsorted(np.concatenate(starts), first)


def pair(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return mix(left * LEFT + right * RIGHT)


def by_bytes(ids: list, texts: list, limit: int = 4 * PART_BYTES) -> Iterator[tuple[list, list]]:
    """Consecutive rows with at most `limit` characters together, one row at least."""
    begin = size = 0
    for i, text in enumerate(texts):
        n = len(text or "")
        if size and size + n > limit:
            yield ids[begin:i], texts[begin:i]
            begin, size = i, 0
        size += n
    if begin < len(ids):
        yield ids[begin:], texts[begin:]


def packed(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """A binary column whose row i holds the bytes of `values[bounds[i]:bounds[i + 1]]`."""
    values = np.ascontiguousarray(values)
    offsets = (np.asarray(bounds, np.int64) * values.itemsize)
    return pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(values)]).cast(pa.binary())


def id_filter(ids: DataFrame, column: str) -> np.ndarray:
    """A bitmap of 2^23 bits (1 MB, whatever the input) that has the bit of every id.

    It keeps rows that nobody asked for out of a shuffle; false positives are removed by the join that follows.
    """
    bit = F.pmod(F.xxhash64(F.col(column).cast("bigint")), F.lit(1 << FILTER_BITS))
    words = (
        ids.select(bit.alias("bit"))
        .groupBy(F.shiftright("bit", 5).alias("word"))
        .agg(F.expr("bit_or(shiftleft(1L, cast(bit & 31 as int)))").alias("mask"))
    )
    out = np.zeros(1 << (FILTER_BITS - 5), np.uint32)
    for word, mask in words.collect():
        out[word] = mask
    return out


def in_filter(bitmap: np.ndarray, ids: list[int]) -> list[bool]:
    out = []
    for i in ids:
        value = xxhash.xxh64_intdigest(int(i).to_bytes(8, "little", signed=True), 42) & ((1 << FILTER_BITS) - 1)
        out.append(bool((int(bitmap[value >> 5]) >> (value & 31)) & 1))
    return out


def components(edges: DataFrame) -> DataFrame:
    """Connected components of undirected `edges (a, b)`: `id`, `component` (the smallest id reachable).

    Rounds of large-star and small-star: every node's neighbours are joined to its smallest neighbour,
    so the number of edges never grows and hubs are only joined, never gathered. `edges` is read twice.
    """
    size = EDGE_BYTES * edges.count()
    state = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges", size)
    while True:
        # Done when every node has one edge, to a node that has none of its own.
        ends = state.select(F.col("u").alias("k"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
            state.select(F.col("v").alias("k"), F.lit(0).alias("up"), F.lit(1).alias("down")))
        if ends.groupBy("k").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up + down > 1 and up > 0").isEmpty():
            break
        both = state.unionByName(state.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("low")).select(F.col("u").alias("k"), F.least("u", "low").alias("low"))
        large = both.join(low, both["u"] == low["k"]).where("v > u").select(F.col("v").alias("u"), F.col("low").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("low")).withColumnRenamed("u", "k")
        small = large.join(least, large["u"] == least["k"]).select(
            F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("low").alias("v")), F.struct(F.col("u"), F.col("low").alias("v")))).alias("e")
        ).select("e.*").where("u <> v")
        state = stored(small.distinct(), "edges", size)
    found = state.select(F.col("u").alias("id"), F.col("v").alias("component"))
    return in_files(found.unionByName(found.select(F.col("component").alias("id"), "component").distinct()), 2 * size)
