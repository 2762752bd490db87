"""One-row and top-five figures for the front page."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from bazaarlens.functions.numeric import average_money, cents, mean, money, percent, sum_if
from bazaarlens.operators.aggregates import (
    PROMISED_MINUTES,
    count_where,
    delivered,
    sum_by_dimension,
    timed_deliveries,
)
from bazaarlens.plans.revenue import orders_and_revenue, status_counts


def row_count(df: DataFrame) -> Column:
    """Number of rows, as a scalar subquery."""
    return df.agg(F.count("*").alias("n")).scalar()


def kpi_topline(customers: DataFrame, restaurants: DataFrame, orders: DataFrame) -> DataFrame:
    """Totals of the platform in one pass over the orders."""
    done = F.col("status") == "delivered"
    paid = orders.agg(
        F.count("*").alias("total_orders"),
        count_where(done).alias("delivered_orders"),
        sum_if(done, cents("total_amount")).alias("cents"),
        F.count(F.when(done, F.col("total_amount"))).alias("priced"),
    )
    return paid.select(
        row_count(customers).alias("customers"),
        row_count(restaurants).alias("restaurants"),
        "total_orders",
        "delivered_orders",
        F.round(money("cents"), 0).alias("total_revenue"),
        average_money("cents", "priced").alias("avg_order_value"),
    )


def kpi_cancel_refund(orders: DataFrame) -> DataFrame:
    counts = orders.agg(*[c.alias(n) for n, c in status_counts().items()])
    return counts.select(
        percent("cancelled", "total_orders").alias("cancel_rate_pct"),
        percent("refunded", "total_orders").alias("refund_rate_pct"),
    )


def kpi_on_time(orders: DataFrame, promised: int = PROMISED_MINUTES) -> DataFrame:
    minutes = F.col("delivery_time_minutes")
    timing = timed_deliveries(orders).agg(
        F.count("*").alias("valid_deliveries"),
        F.sum(minutes).alias("minutes"),
        count_where(minutes <= promised).alias("on_time"),
    )
    return timing.select(
        "valid_deliveries",
        percent("on_time", "valid_deliveries").alias("on_time_pct"),
        mean("minutes", "valid_deliveries", 1).alias("avg_delivery_minutes"),
    )


def top_by_revenue(orders: DataFrame, restaurants: DataFrame, attribute: str, k: int = 5) -> DataFrame:
    """Cities or cuisines with the most delivered revenue."""
    groups = sum_by_dimension(delivered(orders), restaurants, "restaurant_id", [attribute], orders_and_revenue())
    return (
        groups.orderBy(F.desc_nulls_first("cents"), attribute)
        .limit(k)
        .select(attribute, "orders", F.round(money("cents"), 0).alias("revenue"))
    )
