"""Acquisition cohorts, retention, churn, and new against returning revenue."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from bazaarlens.functions.dates import month_of, months_apart
from bazaarlens.functions.numeric import cents, money, percent
from bazaarlens.operators.aggregates import count_where, delivered, per_key
from bazaarlens.session import cut_lineage

CHURN_DAYS = 90


def customer_months(orders: DataFrame) -> DataFrame:
    """One row per customer and month with a delivered order, with the customer's first month.

    Grouping comes first, so the window sees at most one row per month for any
    customer, however many orders there are.
    """
    active = per_key(
        delivered(orders).select("customer_id", month_of("order_timestamp").alias("month"), "total_amount"),
        ["customer_id", "month"],
        {"cents": F.sum(cents("total_amount"))},
    )
    return active.withColumn("cohort_month", F.min("month").over(Window.partitionBy("customer_id")))


def new_vs_returning(orders: DataFrame) -> DataFrame:
    """Revenue per month from customers in their first month and from all others."""
    first = F.col("month") == F.col("cohort_month")
    months = customer_months(orders).groupBy("month").agg(
        F.sum(F.when(first, F.col("cents"))).alias("new"),
        F.sum(F.when(~first, F.col("cents"))).alias("back"),
        F.sum("cents").alias("all"),
    )
    return months.select(
        "month",
        money("new").alias("new_revenue"),
        money("back").alias("returning_revenue"),
        percent("back", "all").alias("pct_returning"),
    ).orderBy("month")


def returning_share(orders: DataFrame) -> DataFrame:
    """Share of all revenue from customers past their first month."""
    back = F.when(F.col("month") != F.col("cohort_month"), F.col("cents"))
    sums = customer_months(orders).agg(F.sum(back).alias("back"), F.sum("cents").alias("all"))
    return sums.select(percent("back", "all").alias("pct_revenue_returning"))


def cohort_sizes(orders: DataFrame) -> DataFrame:
    """Customers by month of their first delivered order."""
    first = per_key(delivered(orders), "customer_id", {"first": F.min("order_timestamp")})
    return (
        first.groupBy(month_of("first").alias("cohort_month"))
        .agg(F.count("*").alias("new_customers"))
        .orderBy("cohort_month")
    )


def _cohort_activity(orders: DataFrame) -> DataFrame:
    """Active customers per cohort and month offset; at offset 0 that is the cohort itself."""
    offset = months_apart(F.col("month"), F.col("cohort_month"))
    return (
        customer_months(orders)
        .groupBy("cohort_month", offset.alias("month_offset"))
        .agg(F.count("*").alias("active_customers"))
    )


def _at_start(window) -> Column:
    return F.max(F.when(F.col("month_offset") == 0, F.col("active_customers"))).over(window)


def cohort_retention_matrix(orders: DataFrame) -> DataFrame:
    """Share of each cohort active again after so many months."""
    return (
        _cohort_activity(orders)
        .withColumn("cohort_size", _at_start(Window.partitionBy("cohort_month")))
        .select(
            "cohort_month",
            "cohort_size",
            "month_offset",
            "active_customers",
            percent("active_customers", "cohort_size").alias("retention_pct"),
        )
        .orderBy("cohort_month", "month_offset")
    )


def cohort_matrix_pivot(orders: DataFrame, offsets: list[int] | None = None) -> DataFrame:
    """The retention matrix with one column per month offset, from 0 to the last one in the data.

    ``offsets`` states the columns instead; offsets of the data outside of them are an error.
    """
    matrix = cut_lineage(cohort_retention_matrix(orders))
    last = matrix.agg(F.max("month_offset")).first()[0]
    if offsets is None:
        offsets = list(range((last or 0) + 1))
    elif not matrix.filter(~F.col("month_offset").isin(offsets)).isEmpty():
        raise ValueError(f"the data have month offsets outside of {offsets[0]} to {offsets[-1]}")
    wide = matrix.groupBy("cohort_month", "cohort_size").pivot("month_offset", offsets).agg(F.first("retention_pct"))
    return wide.select(
        "cohort_month", "cohort_size", *[F.col(f"`{n}`").alias(f"month_{n}") for n in offsets]
    ).orderBy("cohort_month")


def retention_curve(orders: DataFrame) -> DataFrame:
    """All cohorts pooled: share of all customers active again after so many months."""
    pooled = _cohort_activity(orders).groupBy("month_offset").agg(
        F.sum("active_customers").alias("active_customers")
    )
    return pooled.select(
        "month_offset",
        "active_customers",
        percent("active_customers", _at_start(Window.partitionBy())).alias("pct_of_all_customers"),
    ).orderBy("month_offset")


def _last_orders(orders: DataFrame) -> DataFrame:
    """Date of each customer's last delivered order, and the days from there to the last one of all.

    The latest date is taken from the rows per customer, whose exchange both uses share: orders are read once.
    """
    last = per_key(delivered(orders), "customer_id", {"last": F.max("order_timestamp")})
    latest = last.agg(F.max("last").cast("date").alias("as_of")).scalar()
    return last.select("customer_id", F.col("last").cast("date").alias("last_order_date")).withColumn(
        "days_since_last_order", F.datediff(latest, "last_order_date")
    )


def churn_flag(orders: DataFrame, customers: DataFrame, days: int = CHURN_DAYS) -> DataFrame:
    """Customers marked churned when their last delivered order is more than ``days`` old."""
    status = F.when(F.col("days_since_last_order") > days, "churned").otherwise("active")
    return (
        _last_orders(orders)
        .join(customers.select("customer_id", "name", "segment"), "customer_id")
        .select(
            "customer_id",
            "name",
            "segment",
            "last_order_date",
            "days_since_last_order",
            status.alias("churn_status"),
        )
        .orderBy(F.desc_nulls_first("days_since_last_order"), "customer_id")
    )


def churn_rate(orders: DataFrame, days: int = CHURN_DAYS) -> DataFrame:
    """Customers with a delivered order, how many of them churned, and the rate."""
    counts = _last_orders(orders).agg(
        F.count("*").alias("customers_with_orders"),
        count_where(F.col("days_since_last_order") > days).alias("churned"),
    )
    return counts.withColumn("churn_rate_pct", percent("churned", "customers_with_orders"))
