"""The exploration job: read a fact, add calendar columns, join its dimension, summarise."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidewell.functions.calendar import with_calendar
from tidewell.operators.explore import box_stats, enrich


def sales(orders: DataFrame, customer: DataFrame) -> DataFrame:
    """Orders with calendar columns and their customer's attributes."""
    return enrich(
        with_calendar(orders, "o_orderdate"), customer.withColumnRenamed("c_custkey", "o_custkey"), "o_custkey"
    )


def monthly_boxes(orders: DataFrame, customer: DataFrame) -> DataFrame:
    return box_stats(sales(orders, customer), ["month"], "o_totalprice")
