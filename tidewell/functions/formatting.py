"""Text forms of durations and sizes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def elapsed_text(seconds: Column) -> Column:
    """`H:MM:SS` of half-even rounded seconds, with `N day(s), ` in front from 24 hours on."""
    total = F.bround(seconds.cast("double"), 0).cast("bigint")
    days = F.floor(total / 86400)
    rest = total - days * 86400
    clock = F.format_string(
        "%d:%02d:%02d", F.floor(rest / 3600), F.floor(rest / 60) % 60, rest % 60
    )
    unit = F.when(F.abs(days) == 1, " day, ").otherwise(" days, ")
    return F.when(days == 0, clock).otherwise(F.concat(days.cast("string"), unit, clock))


def megabytes(size: Column) -> Column:
    return F.round(size / F.lit(1048576.0), 2)


def megabytes_text(size: Column) -> Column:
    return F.concat(F.format_string("%.2f", size / F.lit(1048576.0)), F.lit(" MB"))
