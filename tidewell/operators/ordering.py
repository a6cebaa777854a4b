"""Ordered work (positions, lags, frames) that survives a group holding a third of all rows.

A plain window keeps one group in one task. Here the group sizes are measured first: groups within the
per-task limit use the plain window. The rows of larger ones are dealt by range over the group and all
order columns, whatever their types, so that a range holds about half the limit; the ranges are written once, and
the place of a row is its place in the range plus the rows of its group in earlier ranges.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.session import settled, task_bytes, task_rows

_CHUNK = "__chunk"
_POS = "__pos"
ROW = "__row"
# Rows of a range are numbered from here on in steps of one, by `monotonically_increasing_id`.
RANGE_BITS = 33


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _text_bytes(df: DataFrame) -> Column | None:
    """Bytes of the texts of a row, which are what makes rows wide; None without text columns."""
    sizes = []
    for f in df.schema:
        col, kind = F.col(quoted(f.name)), f.dataType
        if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StringType):
            col, kind = F.array_join(col, " "), kind.elementType
        if isinstance(kind, (T.StringType, T.BinaryType)):
            sizes.append(F.coalesce(F.octet_length(col), F.lit(0)).cast("bigint"))
    return sum(sizes[1:], sizes[0]) if sizes else None


def hot_groups(df: DataFrame, group: Sequence[str], whole: bool = False) -> tuple[DataFrame, int] | None:
    """Groups too large for one task (`__g0`, ..., `__rows`) and their rows together, or None when there are none.

    One counting job over the group columns alone, and a second one where there are hot groups: their list is written, so
    Spark knows its size when it joins it. Without group columns the whole frame is the group.

    With `whole` the task gets whole rows: the texts are measured too, and wide rows count as several (`task_bytes` of them as `task_rows`).
    """
    limit, rows = task_rows(df.sparkSession), F.count(F.lit(1))
    wide = _text_bytes(df) if whole else None
    if wide is not None:
        rows = F.greatest(rows, F.ceil(F.sum(wide) * (limit / task_bytes(df.sparkSession))))
    sizes = df.groupBy(*map(quoted, group)).agg(rows.alias("__rows"))
    if (sizes.agg(F.max("__rows")).first()[0] or 0) <= limit:
        return None
    keys = [F.col(quoted(g)).alias(f"__g{i}") for i, g in enumerate(group)]
    hot = settled(sizes.filter(F.col("__rows") > limit).select(*keys, "__rows"), "hot-groups")
    return hot, hot.agg(F.sum("__rows")).first()[0]


def split_hot(df: DataFrame, hot: DataFrame, group: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """The rows of hot groups, and the other rows."""
    same = [F.col(quoted(g)).eqNullSafe(F.col(f"__g{i}")) for i, g in enumerate(group)]
    keys = hot.drop("__rows")
    return df.join(keys, same, "left_semi"), df.join(keys, same, "left_anti")


def ranged(df: DataFrame, order: Sequence[str], group: Sequence[str], rows: int) -> DataFrame:
    """`df` written in ranges of (group, order), with `__row`: rising along the order, gapless within a range."""
    columns = [F.col(quoted(c)) for c in [*group, *order]]
    ranges = max(1, -(-2 * rows // task_rows(df.sparkSession)))
    return settled(df.repartitionByRange(ranges, *columns).sortWithinPartitions(*columns).withColumn(ROW, F.monotonically_increasing_id()), "ranges")


def range_starts(placed: DataFrame, group: Sequence[str]) -> DataFrame:
    """Per group and range: `__g0`, ..., `__range`, `__first` (its first `__row`), `__n`, and `__start`, the rows of the group in earlier ranges."""
    keys = [F.col(quoted(g)).alias(f"__g{i}") for i, g in enumerate(group)]
    names = [f"__g{i}" for i in range(len(group))]
    parts = placed.select(*keys, ROW, F.shiftright(ROW, RANGE_BITS).alias("__range")).groupBy(*names, "__range").agg(
        F.min(ROW).alias("__first"), F.count(F.lit(1)).alias("__n"))
    # As many rows per group as it has ranges.
    earlier = Window.partitionBy(*names).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    return settled(parts.withColumn("__start", F.coalesce(F.sum("__n").over(earlier), F.lit(0))), "range-starts")


def with_position(
    df: DataFrame, order: Sequence[str], group: Sequence[str] = (), name: str = "pos"
) -> DataFrame:
    """Add the 0-based rank of each row in its group. `order` must be a total order."""
    return _positions(df, order, group, name, hot_groups(df, group, whole=True))


def _positions(
    df: DataFrame, order: Sequence[str], group: Sequence[str], name: str, found: tuple[DataFrame, int] | None
) -> DataFrame:
    window = Window.partitionBy(*map(quoted, group)).orderBy(*map(quoted, order))
    plain = lambda rows: rows.withColumn(name, F.row_number().over(window).cast("bigint") - 1)
    if found is None:
        return plain(df)
    hot, rows = found
    large, small = split_hot(df, hot, group) if group else (df, None)
    placed = ranged(large, order, group, rows)
    starts = range_starts(placed, group)
    same = [F.col(quoted(g)).eqNullSafe(F.col(f"__g{i}")) for i, g in enumerate(group)]
    joined = placed.join(starts, [*same, F.shiftright(ROW, RANGE_BITS) == F.col("__range")])
    place = (F.col(ROW) - F.col("__first") + F.col("__start")).alias(name)
    out = joined.select(*[F.col(quoted(c)) for c in df.columns if c != name], place)
    return out if small is None else out.unionByName(plain(small).select(*map(quoted, out.columns)))


def over_frames(
    df: DataFrame,
    order: Sequence[str],
    group: Sequence[str],
    compute: Callable[[DataFrame, WindowSpec], DataFrame],
    back: int = 0,
    ahead: int = 0,
) -> DataFrame:
    """Run window columns that look at most `back` rows behind and `ahead` rows in front.

    `compute` adds columns and keeps the rows. Where a group is too large for one task it is cut
    into runs of consecutive positions, and each run also receives the few neighbour rows its
    frames need, so that no task holds a whole group.
    """
    found = hot_groups(df, group)
    if found is None:
        return compute(df, Window.partitionBy(*map(quoted, group)).orderBy(*map(quoted, order)))
    run = max(task_rows(df.sparkSession), back + ahead, 1)
    placed = _positions(df, order, group, _POS, found)
    home = F.floor(F.col(_POS) / run)
    within = F.col(_POS) % run
    runs = F.array(home)
    if back:
        runs = F.concat(runs, F.when(within >= run - back, F.array(home + 1)).otherwise(F.array().cast("array<bigint>")))
    if ahead:
        runs = F.concat(runs, F.when(within < ahead, F.array(home - 1)).otherwise(F.array().cast("array<bigint>")))
    copies = placed.withColumn(_CHUNK, F.explode(runs))
    window = Window.partitionBy(*map(quoted, group), _CHUNK).orderBy(_POS)
    return compute(copies, window).filter(F.col(_CHUNK) == home).drop(_CHUNK, _POS)
