"""Metric layer queries and the data sets behind each dashboard visual."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from bazaarlens.functions.dates import month_of
from bazaarlens.functions.numeric import TOTAL, cents, money
from bazaarlens.operators.aggregates import count_where, per_key
from bazaarlens.operators.metrics import Dimension, customer_metrics, metric, revenue_label, review_metrics
from bazaarlens.plans.customers import customer_months

OVERVIEW = (
    "total_orders",
    "delivered_orders",
    "total_revenue",
    "average_order_value",
    "discount_given",
    "items_sold",
    "valid_deliveries",
    "avg_delivery_time",
    "on_time_orders",
    "on_time_rate",
    "cancelled_orders",
    "cancellation_rate",
    "active_customers",
    "revenue_per_customer",
)


def metrics_overall(fact_orders: DataFrame) -> DataFrame:
    """Every additive, ratio and customer metric for the whole platform."""
    return metric(fact_orders, OVERVIEW)


def metrics_by_month(fact_orders: DataFrame, dim_date: DataFrame) -> DataFrame:
    """The same metrics by calendar month."""
    dims = {"year_month": Dimension(dim_date, "date_key")}
    return metric(fact_orders, OVERVIEW, by=["year_month"], dims=dims).orderBy("year_month")


def daily_revenue(
    order_facts: DataFrame,
    dim_date: DataFrame,
    dims: Mapping[str, Dimension] | None = None,
    slicers: Mapping[str, Sequence] | None = None,
) -> DataFrame:
    """Delivered revenue on every day of the calendar; NULL on days without any.

    ``slicers`` keep facts by attributes other than the date; see ``metric``.
    """
    revenue = metric(order_facts, ["total_revenue"], by=["date_key"], dims=dims, slicers=slicers)
    return dim_date.select("date_key", "year", "year_month").join(revenue, "date_key", "left")


def metrics_mtd_ytd(
    order_facts: DataFrame,
    dim_date: DataFrame,
    selection: Column | None = None,
    dims: Mapping[str, Dimension] | None = None,
    slicers: Mapping[str, Sequence] | None = None,
) -> DataFrame:
    """Revenue to date within the month, within the year, and within the selected days.

    ``dim_date`` is the whole calendar. ``selection`` picks its days last (by ``date_key``,
    ``year`` or ``year_month``): month and year to date reach back before it, only the running
    sum begins with it.
    """
    month = Window.partitionBy("year_month").orderBy("date_key")
    year = Window.partitionBy("year").orderBy("date_key")
    selected = Window.orderBy("date_key")  # one row per day of the calendar
    revenue = F.sum("total_revenue")
    to_date = daily_revenue(order_facts, dim_date, dims, slicers).select(
        "date_key",
        "year",
        "year_month",
        "total_revenue",
        revenue.over(month).cast(TOTAL).alias("revenue_mtd"),
        revenue.over(year).cast(TOTAL).alias("revenue_ytd"),
    )
    shown = to_date if selection is None else to_date.filter(selection)
    return shown.select(
        "date_key",
        "total_revenue",
        "revenue_mtd",
        "revenue_ytd",
        revenue.over(selected).cast(TOTAL).alias("running_revenue"),
    ).orderBy("date_key")


def metrics_mom_yoy(
    order_facts: DataFrame,
    dim_date: DataFrame,
    selection: Column | None = None,
    dims: Mapping[str, Dimension] | None = None,
    slicers: Mapping[str, Sequence] | None = None,
) -> DataFrame:
    """Revenue of each calendar month against the month and the year before.

    The comparison is by calendar, not by the previous row: a month without
    revenue still counts as the previous month. ``dim_date`` is the whole calendar;
    ``selection`` picks months last (by ``month``), so the months before it are still seen.
    """
    months = (
        daily_revenue(order_facts, dim_date, dims, slicers)
        .groupBy(F.trunc("date_key", "MM").alias("month"))
        .agg(F.sum("total_revenue").cast(TOTAL).alias("total_revenue"))
    )

    def shifted(by: int, name: str) -> DataFrame:
        return months.select(F.add_months("month", by).alias("month"), F.col("total_revenue").alias(name))

    def change(name: str) -> Column:
        zero = F.lit(0).cast(TOTAL)
        return F.try_divide(F.coalesce("total_revenue", zero) - F.col(name), F.col(name))

    shown = months if selection is None else months.filter(selection)
    return (
        shown.join(shifted(1, "revenue_pm"), "month", "left")
        .join(shifted(12, "revenue_py"), "month", "left")
        .select(
            "month",
            "total_revenue",
            "revenue_pm",
            change("revenue_pm").alias("mom_rate"),
            "revenue_py",
            change("revenue_py").alias("yoy_rate"),
        )
        .orderBy("month")
    )


def metrics_new_returning(orders: DataFrame) -> DataFrame:
    """Customers per month: active, with their first-ever delivered order, and the rest."""
    counts = customer_months(orders).groupBy("month").agg(
        F.count("*").alias("active_customers"),
        count_where(F.col("month") == F.col("cohort_month")).alias("new_customers"),
    )
    back = F.col("active_customers") - F.col("new_customers")
    return counts.select(
        "month",
        "active_customers",
        "new_customers",
        back.alias("returning_customers"),
        F.try_divide(back.cast(TOTAL), F.col("active_customers").cast("decimal(20,0)")).alias("repeat_rate"),
    ).orderBy("month")


def metrics_new_returning_by(
    order_facts: DataFrame, dim_date: DataFrame, dim_restaurants: DataFrame, years: Sequence[int] | None = None
) -> DataFrame:
    """Customers per city: active, new in the chosen years, and returning."""
    dims = {"city": Dimension(dim_restaurants, "restaurant_id"), "year": Dimension(dim_date, "date_key")}
    slicers = None if years is None else {"year": years}
    return customer_metrics(order_facts, ["city"], dims, slicers).orderBy("city")


def metrics_reviews_by_cuisine(fact_reviews: DataFrame, dim_restaurants: DataFrame) -> DataFrame:
    """Average rating and number of ratings by cuisine."""
    dims = {"cuisine_type": Dimension(dim_restaurants, "restaurant_id")}
    return review_metrics(fact_reviews, ["cuisine_type"], dims).orderBy("cuisine_type")


def kpi_avg_rating(fact_reviews: DataFrame) -> DataFrame:
    """Average rating and number of ratings over all reviews."""
    return review_metrics(fact_reviews)


def metrics_segment(
    order_facts: DataFrame, dim_customers: DataFrame, segments: Sequence[str] | None = None
) -> DataFrame:
    """Customers and revenue by segment, for all or some segments."""
    kept = dim_customers if segments is None else dim_customers.filter(F.col("segment").isin(list(segments)))
    spent = per_key(
        order_facts.filter("is_delivered"), "customer_id", {"cents": F.sum(cents("total_amount"))}
    )
    # customer_id is unique in the dimension, so counting rows counts customers.
    return (
        kept.select("customer_id", "segment")
        .join(spent, "customer_id", "left")
        .groupBy("segment")
        .agg(F.count("customer_id").alias("customers_in_segment"), money(F.sum("cents")).alias("total_revenue"))
        .orderBy("segment")
    )


def metrics_reviews(fact_reviews: DataFrame) -> DataFrame:
    """Average rating and number of ratings by month of the review.

    The month is that of the review's own day, also where it lies outside the order calendar; with a
    calendar as dimension (``review_metrics``) such reviews fall to a blank member.
    """
    by_month = fact_reviews.withColumn("month", month_of("date_key"))
    return review_metrics(by_month, ["month"]).orderBy("month")


def metrics_label(order_facts: DataFrame) -> DataFrame:
    """Daily revenue with a short label."""
    return (
        metric(order_facts, ["total_revenue"], by=["date_key"])
        .withColumn("revenue_label", revenue_label(F.col("total_revenue")))
        .orderBy("date_key")
    )


def metric_by_city_filtered(
    order_facts: DataFrame,
    dim_restaurants: DataFrame,
    dim_date: DataFrame,
    years: Sequence[int] | None = None,
    cities: Sequence[str] | None = None,
) -> DataFrame:
    """Revenue by city for the chosen years and cities."""
    dims = {"city": Dimension(dim_restaurants, "restaurant_id"), "year": Dimension(dim_date, "date_key")}
    chosen = {name: values for name, values in (("year", years), ("city", cities)) if values is not None}
    return metric(order_facts, ["total_revenue"], by=["city"], dims=dims, slicers=chosen).orderBy("city")


SPEED = ("total_orders", "valid_deliveries", "avg_delivery_time", "on_time_rate")


def metric_by_vehicle(order_facts: DataFrame, dim_riders: DataFrame) -> DataFrame:
    """Speed by vehicle; orders without a rider form a blank member."""
    dims = {"vehicle_type": Dimension(dim_riders, "rider_id")}
    return metric(order_facts, SPEED, by=["vehicle_type"], dims=dims).orderBy(F.asc_nulls_last("vehicle_type"))


def metric_by_rider(order_facts: DataFrame, dim_riders: DataFrame) -> DataFrame:
    """Speed by rider."""
    measured = metric(order_facts, SPEED, by=["rider_id"])
    names = dim_riders.select("rider_id", "rider_name")
    return (
        measured.join(names, "rider_id", "left")
        .select("rider_id", "rider_name", *SPEED)
        .orderBy(F.asc_nulls_last("rider_id"))
    )


def rating_vs_revenue(order_facts: DataFrame, fact_reviews: DataFrame, dim_restaurants: DataFrame) -> DataFrame:
    """Average rating against revenue per restaurant: each fact is summed on its own first."""
    revenue = metric(order_facts, ["total_revenue"], by=["restaurant_id"])
    ratings = review_metrics(fact_reviews, ["restaurant_id"])
    return (
        dim_restaurants.select("restaurant_id", "restaurant_name")
        .join(revenue, "restaurant_id", "left")
        .join(ratings.withColumnRenamed("avg_rating", "avg_review"), "restaurant_id", "left")
        .select("restaurant_id", "restaurant_name", F.col("avg_review").alias("avg_rating"), "review_count", "total_revenue")
        .orderBy("restaurant_id")
    )


def items_sold(fact_order_items: DataFrame, dim_menu_items: DataFrame) -> DataFrame:
    """Units of delivered lines by menu item; read from the line fact, which carries the item."""
    sold = (
        fact_order_items.filter("is_delivered")
        .groupBy("item_id")
        .agg(F.sum("quantity").alias("items_sold"))
    )
    return (
        dim_menu_items.select("item_id", "item_name")
        .join(sold, "item_id")
        .orderBy(F.desc("items_sold"), "item_id")
    )
