"""Gap-free calendar series."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def days_between(bounds: DataFrame, first: Column, last: Column, name: str) -> DataFrame:
    """Every day from ``first`` to ``last`` of a one-row frame."""
    return bounds.select(F.explode(F.sequence(first, last, F.expr("interval 1 day"))).alias(name))


def month_series(spark: SparkSession, first: str, last: str, name: str = "month") -> DataFrame:
    """Every month start from ``first`` to ``last``, both included."""
    start, end = F.lit(first).cast("date"), F.lit(last).cast("date")
    return spark.range(1).select(
        F.explode(F.sequence(start, end, F.expr("interval 1 month"))).alias(name)
    )
