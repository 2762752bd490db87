"""From raw text tables to typed, de-duplicated, referentially closed tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from bazaarlens.functions.dates import DATE_PATTERNS, parse_date
from bazaarlens.functions.text import blank_to_null, natural_key, standard_city
from bazaarlens.operators.joins import broadcast_if_small
from bazaarlens.schemas import MONEY, PRICE
from bazaarlens.sources.marketplace import Marketplace


def _number(name: str, kind) -> Column:
    """Strict cast of a required number."""
    return F.col(name).cast(kind).alias(name)


def _optional(name: str, kind) -> Column:
    """Strict cast in which a blank is NULL."""
    return F.nullif(F.col(name), F.lit("")).cast(kind).alias(name)


def _label(name: str) -> Column:
    return blank_to_null(F.col(name)).alias(name)


def dedup_customers(raw: DataFrame) -> DataFrame:
    """One row per person and city, ignoring case and padding; the lowest id wins.

    An aggregate instead of a ranking window: tasks keep one candidate per key
    before the shuffle, so many copies of one person stay cheap.
    """
    columns = [F.col("customer_id").cast("bigint").alias("customer_id"), *[c for c in raw.columns if c != "customer_id"]]
    record = F.struct(*columns)
    return (
        raw.groupBy(
            natural_key(F.col("name")).alias("_name"),
            natural_key(F.coalesce("city", F.lit(""))).alias("_city"),
        )
        .agg(F.min_by(record, F.col("customer_id").cast("bigint")).alias("_first"))
        .select("_first.*")
    )


def clean_customers(raw: DataFrame, patterns: Sequence[str] = DATE_PATTERNS) -> DataFrame:
    return dedup_customers(raw).select(
        "customer_id",
        "name",
        standard_city(F.col("city")).alias("city"),
        parse_date(F.col("signup_date"), patterns).alias("signup_date"),
        _label("segment"),
    )


def clean_restaurants(raw: DataFrame, patterns: Sequence[str] = DATE_PATTERNS) -> DataFrame:
    return raw.select(
        _number("restaurant_id", "bigint"),
        "name",
        _label("cuisine_type"),
        standard_city(F.col("city")).alias("city"),
        parse_date(F.col("active_since"), patterns).alias("active_since"),
        _optional("avg_rating", "decimal(3,2)"),
    )


def clean_menu_items(raw: DataFrame) -> DataFrame:
    return raw.select(
        _number("item_id", "bigint"),
        _number("restaurant_id", "bigint"),
        "name",
        _label("category"),
        _optional("price", PRICE),
    )


def clean_riders(raw: DataFrame, patterns: Sequence[str] = DATE_PATTERNS) -> DataFrame:
    return raw.select(
        _number("rider_id", "bigint"),
        "name",
        standard_city(F.col("city")).alias("city"),
        parse_date(F.col("join_date"), patterns).alias("join_date"),
        _label("vehicle_type"),
    )


def typed_orders(raw: DataFrame) -> DataFrame:
    """Orders with types and value rules, before the check against customers and restaurants."""
    minutes = F.nullif("delivery_time_minutes", F.lit("")).cast("int")
    return raw.select(
        _number("order_id", "bigint"),
        _number("customer_id", "bigint"),
        _number("restaurant_id", "bigint"),
        _optional("rider_id", "bigint"),
        _number("order_timestamp", "timestamp_ntz"),
        "status",
        _label("payment_method"),
        _optional("total_amount", MONEY),
        F.when(minutes >= 0, minutes).alias("delivery_time_minutes"),
        F.coalesce(F.nullif("discount_applied", F.lit("")).cast(MONEY), F.lit(0).cast(MONEY)).alias(
            "discount_applied"
        ),
    )


def clean_orders(raw: DataFrame, customers: DataFrame, restaurants: DataFrame) -> DataFrame:
    """Typed orders of customers and restaurants that were kept."""
    known = broadcast_if_small(restaurants.select("restaurant_id"))
    typed = typed_orders(raw)
    return (
        typed.join(known, "restaurant_id", "left_semi")
        .join(customers.select("customer_id"), "customer_id", "left_semi")
        .select(*typed.columns)
    )


def _of_kept_orders(child: DataFrame, orders: DataFrame) -> DataFrame:
    return child.join(orders.select("order_id"), "order_id", "left_semi").select(*child.columns)


def clean_order_items(raw: DataFrame, orders: DataFrame) -> DataFrame:
    """Typed lines of orders that were kept; the line id is optional in the input."""
    line = [_number("order_item_id", "bigint")] if "order_item_id" in raw.columns else []
    typed = raw.select(
        *line,
        _number("order_id", "bigint"),
        _number("item_id", "bigint"),
        _number("quantity", "int"),
        _optional("unit_price", PRICE),
    )
    return _of_kept_orders(typed, orders)


def clean_reviews(raw: DataFrame, orders: DataFrame, patterns: Sequence[str] = DATE_PATTERNS) -> DataFrame:
    """Typed reviews of orders that were kept."""
    typed = raw.select(
        _number("review_id", "bigint"),
        _number("order_id", "bigint"),
        _optional("rating", "int"),
        "review_text",
        parse_date(F.col("review_date"), patterns).alias("review_date"),
    )
    return _of_kept_orders(typed, orders)


def clean_all(raw: dict[str, DataFrame], put: Callable[[str, DataFrame], DataFrame] = lambda name, df: df) -> Marketplace:
    """All seven tables, parents before children.

    ``put(name, df)`` may write a table that others are checked against and return it as written; without that, each
    child cleans its parents again.
    """
    customers = put("customers", clean_customers(raw["customers"]))
    restaurants = put("restaurants", clean_restaurants(raw["restaurants"]))
    orders = put("orders", clean_orders(raw["orders"], customers, restaurants))
    return Marketplace(
        customers=customers,
        restaurants=restaurants,
        menu_items=clean_menu_items(raw["menu_items"]),
        riders=clean_riders(raw["riders"]),
        orders=orders,
        order_items=clean_order_items(raw["order_items"], orders),
        reviews=clean_reviews(raw["reviews"], orders),
    )
