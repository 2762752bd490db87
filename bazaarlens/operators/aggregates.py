"""Aggregation through dimensions: sum per foreign key first, look the key up later."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

DELIVERED = "delivered"
# Minutes a delivery can plausibly take, and the promised maximum; fixed values.
VALID_MINUTES = (1, 180)
PROMISED_MINUTES = 45


def delivered(orders: DataFrame) -> DataFrame:
    return orders.filter(F.col("status") == DELIVERED)


def timed_deliveries(orders: DataFrame, valid: tuple[int, int] = VALID_MINUTES) -> DataFrame:
    """Delivered orders with a plausible delivery time."""
    return delivered(orders).filter(F.col("delivery_time_minutes").between(*valid))


def count_where(condition: Column) -> Column:
    return F.count_if(condition)


def sums(names: Sequence[str]) -> list[Column]:
    """Add up partial sums and counts under their own names."""
    return [F.sum(n).alias(n) for n in names]


def per_key(fact: DataFrame, key: str | Sequence[str], measures: dict[str, Column]) -> DataFrame:
    """One row per foreign key. Tasks combine before the shuffle, so a key that
    holds a large share of the rows still sends one row per task."""
    keys = [key] if isinstance(key, str) else list(key)
    return fact.groupBy(*keys).agg(*[m.alias(n) for n, m in measures.items()])


def sum_by_dimension(
    fact: DataFrame,
    dim: DataFrame,
    key: str,
    by: Sequence[str],
    measures: dict[str, Column],
    how: str = "inner",
) -> DataFrame:
    """Additive measures of ``fact`` grouped by attributes of ``dim``.

    Only one row per key meets the dimension, so the join stays small whether
    Spark finds the dimension small enough to broadcast or not.
    """
    keyed = per_key(fact, key, measures)
    return keyed.join(dim.select(key, *by), key, how).groupBy(*by).agg(*sums(list(measures)))
