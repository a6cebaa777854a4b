"""Calendar columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def parse_datetime(text: Column, pattern: str | None = None) -> Column:
    """Timestamp from text; text that is no timestamp becomes null."""
    return F.try_to_timestamp(text, F.lit(pattern)) if pattern else F.try_to_timestamp(text)


def with_calendar(df: DataFrame, date: str) -> DataFrame:
    """Add month (1-12), day of month and day_of_week (0 = Monday)."""
    col = F.col(date)
    return df.withColumns(
        {"month": F.month(col), "day": F.dayofmonth(col), "day_of_week": F.weekday(col)}
    )


def iso_timestamp(col: Column) -> Column:
    """ISO 8601 text; microseconds are left out when they are zero."""
    whole = F.date_format(col, "yyyy-MM-dd'T'HH:mm:ss")
    micros = F.date_format(col, "SSSSSS")
    return F.when(micros == "000000", whole).otherwise(F.concat_ws(".", whole, micros))
