"""Star schema: five dimensions and three facts over the clean tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from bazaarlens.functions.dates import iso_weekday
from bazaarlens.operators.aggregates import PROMISED_MINUTES, VALID_MINUTES
from bazaarlens.operators.series import days_between
from bazaarlens.sources.marketplace import Marketplace

UNKNOWN_CITY = "Unknown"
UNKNOWN_SEGMENT = "unknown"


def dim_date(orders: DataFrame) -> DataFrame:
    """Every day from the first to the last order."""
    bounds = orders.agg(
        F.min("order_timestamp").cast("date").alias("first"),
        F.max("order_timestamp").cast("date").alias("last"),
    )
    day = F.col("date_key")
    return days_between(bounds, F.col("first"), F.col("last"), "date_key").select(
        "date_key",
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.concat(F.lit("Q"), F.quarter(day).cast("string")).alias("quarter_name"),
        F.month(day).alias("month_no"),
        F.date_format(day, "MMM").alias("month_short"),
        F.date_format(day, "yyyy-MM").alias("year_month"),
        F.dayofmonth(day).alias("day_of_month"),
        iso_weekday(day).alias("iso_weekday"),
        F.date_format(day, "E").alias("weekday_short"),
        (iso_weekday(day) >= 6).alias("is_weekend"),
    )


def dim_customers(customers: DataFrame) -> DataFrame:
    return customers.select(
        "customer_id",
        F.col("name").alias("customer_name"),
        F.coalesce("city", F.lit(UNKNOWN_CITY)).alias("city"),
        "signup_date",
        F.date_format("signup_date", "yyyy-MM").alias("signup_month"),
        F.coalesce("segment", F.lit(UNKNOWN_SEGMENT)).alias("segment"),
    )


def dim_restaurants(restaurants: DataFrame) -> DataFrame:
    return restaurants.select(
        "restaurant_id",
        F.col("name").alias("restaurant_name"),
        "cuisine_type",
        F.coalesce("city", F.lit(UNKNOWN_CITY)).alias("city"),
        "active_since",
        "avg_rating",
    )


def dim_riders(riders: DataFrame) -> DataFrame:
    return riders.select(
        "rider_id",
        F.col("name").alias("rider_name"),
        F.coalesce("city", F.lit(UNKNOWN_CITY)).alias("city"),
        "join_date",
        "vehicle_type",
    )


def dim_menu_items(menu_items: DataFrame, restaurants: DataFrame) -> DataFrame:
    places = restaurants.select("restaurant_id", F.col("name").alias("restaurant_name"))
    return menu_items.join(places, "restaurant_id").select(
        "item_id",
        F.col("name").alias("item_name"),
        "category",
        F.col("price").alias("list_price"),
        "restaurant_id",
        "restaurant_name",
    )


def order_facts(orders: DataFrame) -> DataFrame:
    """Columns of the order fact that come from the order alone.

    ``is_on_time`` is three-valued: NULL for a delivered order without a time.
    """
    minutes, status = F.col("delivery_time_minutes"), F.col("status")
    return orders.select(
        "order_id",
        "customer_id",
        "restaurant_id",
        "rider_id",
        "order_timestamp",
        F.col("order_timestamp").cast("date").alias("date_key"),
        "status",
        "payment_method",
        "total_amount",
        "discount_applied",
        F.when(minutes.between(*VALID_MINUTES), minutes).alias("delivery_time_minutes"),
        (status == "delivered").alias("is_delivered"),
        (status == "cancelled").alias("is_cancelled"),
        ((status == "delivered") & minutes.between(1, PROMISED_MINUTES)).alias("is_on_time"),
        (F.col("discount_applied") > 0).alias("had_discount"),
    )


def fact_orders(orders: DataFrame, order_items: DataFrame) -> DataFrame:
    """One row per order, with the number of its lines and units."""
    lines = order_items.groupBy("order_id").agg(
        F.count("*").alias("item_count"), F.sum("quantity").alias("total_quantity")
    )
    return order_facts(orders).join(lines, "order_id", "left")


def fact_reviews(reviews: DataFrame, orders: DataFrame) -> DataFrame:
    placed = orders.select("order_id", "customer_id", "restaurant_id")
    return reviews.join(placed, "order_id").select(
        "review_id", "order_id", "customer_id", "restaurant_id", "rating", F.col("review_date").alias("date_key")
    )


def fact_order_items(order_items: DataFrame, orders: DataFrame) -> DataFrame:
    """One row per order line; the line id is optional in the input."""
    placed = orders.select(
        "order_id",
        F.col("order_timestamp").cast("date").alias("date_key"),
        "status",
        (F.col("status") == "delivered").alias("is_delivered"),
    )
    line = [c for c in ("order_item_id",) if c in order_items.columns]
    return order_items.join(placed, "order_id").select(
        *line,
        "order_id",
        "item_id",
        "quantity",
        "unit_price",
        (F.col("quantity") * F.col("unit_price")).alias("line_revenue"),
        "date_key",
        "status",
        "is_delivered",
    )


def star_schema(market: Marketplace) -> dict[str, DataFrame]:
    """All eight star tables by name."""
    return {
        "dim_date": dim_date(market.orders),
        "dim_customers": dim_customers(market.customers),
        "dim_restaurants": dim_restaurants(market.restaurants),
        "dim_riders": dim_riders(market.riders),
        "dim_menu_items": dim_menu_items(market.menu_items, market.restaurants),
        "fact_orders": fact_orders(market.orders, market.order_items),
        "fact_reviews": fact_reviews(market.reviews, market.orders),
        "fact_order_items": fact_order_items(market.order_items, market.orders),
    }
