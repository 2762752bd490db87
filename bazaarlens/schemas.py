"""Declared schemas, keys and domains of the seven marketplace tables."""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(12, 2)
PRICE = T.DecimalType(8, 2)


def _table(*columns: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in columns])


# Tables, columns and types; fixed values of the data model.
TABLES: dict[str, T.StructType] = {
    "customers": _table(
        ("customer_id", T.LongType()),
        ("name", T.StringType()),
        ("city", T.StringType()),
        ("signup_date", T.DateType()),
        ("segment", T.StringType()),
    ),
    "restaurants": _table(
        ("restaurant_id", T.LongType()),
        ("name", T.StringType()),
        ("cuisine_type", T.StringType()),
        ("city", T.StringType()),
        ("active_since", T.DateType()),
        ("avg_rating", T.DecimalType(3, 2)),
    ),
    "menu_items": _table(
        ("item_id", T.LongType()),
        ("restaurant_id", T.LongType()),
        ("name", T.StringType()),
        ("category", T.StringType()),
        ("price", PRICE),
    ),
    "riders": _table(
        ("rider_id", T.LongType()),
        ("name", T.StringType()),
        ("city", T.StringType()),
        ("join_date", T.DateType()),
        ("vehicle_type", T.StringType()),
    ),
    "orders": _table(
        ("order_id", T.LongType()),
        ("customer_id", T.LongType()),
        ("restaurant_id", T.LongType()),
        ("rider_id", T.LongType()),
        ("order_timestamp", T.TimestampNTZType()),
        ("status", T.StringType()),
        ("payment_method", T.StringType()),
        ("total_amount", MONEY),
        ("delivery_time_minutes", T.IntegerType()),
        ("discount_applied", MONEY),
    ),
    "order_items": _table(
        ("order_item_id", T.LongType()),
        ("order_id", T.LongType()),
        ("item_id", T.LongType()),
        ("quantity", T.IntegerType()),
        ("unit_price", PRICE),
    ),
    "reviews": _table(
        ("review_id", T.LongType()),
        ("order_id", T.LongType()),
        ("rating", T.IntegerType()),
        ("review_text", T.StringType()),
        ("review_date", T.DateType()),
    ),
}

# Keys; fixed values of the data model.
PRIMARY_KEYS = {
    "customers": "customer_id",
    "restaurants": "restaurant_id",
    "menu_items": "item_id",
    "riders": "rider_id",
    "orders": "order_id",
    "order_items": "order_item_id",
    "reviews": "review_id",
}

# (child table, child column, parent table, parent column); fixed values of the data model.
FOREIGN_KEYS = [
    ("menu_items", "restaurant_id", "restaurants", "restaurant_id"),
    ("orders", "customer_id", "customers", "customer_id"),
    ("orders", "restaurant_id", "restaurants", "restaurant_id"),
    ("orders", "rider_id", "riders", "rider_id"),
    ("order_items", "order_id", "orders", "order_id"),
    ("order_items", "item_id", "menu_items", "item_id"),
    ("reviews", "order_id", "orders", "order_id"),
]

# Columns that may not be empty; fixed values of the data model.
REQUIRED = {
    "customers": ["customer_id", "name"],
    "restaurants": ["restaurant_id", "name"],
    "menu_items": ["item_id", "restaurant_id", "name"],
    "riders": ["rider_id", "name"],
    "orders": ["order_id", "customer_id", "restaurant_id", "order_timestamp", "status"],
    "order_items": ["order_item_id", "order_id", "item_id", "quantity"],
    "reviews": ["review_id", "order_id"],
}

# Allowed values; fixed values of the data model.
DOMAINS = {
    ("customers", "segment"): ["new", "regular", "premium", "vip"],
    ("riders", "vehicle_type"): ["bike", "scooter", "car", "bicycle"],
    ("orders", "status"): ["delivered", "cancelled", "refunded", "in_progress"],
    ("orders", "payment_method"): ["card", "upi", "wallet", "cash", "netbanking"],
}

# Inclusive numeric limits, ``None`` for an open end; fixed values of the data model.
RANGES = {
    ("restaurants", "avg_rating"): (0, 5),
    ("menu_items", "price"): (0, None),
    ("orders", "total_amount"): (0, None),
    ("orders", "discount_applied"): (0, None),
    ("order_items", "quantity"): (1, None),
    ("order_items", "unit_price"): (0, None),
    ("reviews", "rating"): (1, 5),
}


def as_text(table: str) -> T.StructType:
    """Staging schema: the same columns, every one a string."""
    return T.StructType([T.StructField(f.name, T.StringType(), True) for f in TABLES[table].fields])
