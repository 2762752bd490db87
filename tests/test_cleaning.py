from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from bazaarlens.operators import cleaning, quality
from bazaarlens.schemas import TABLES, as_text
from bazaarlens.sources import staging

from conftest import order, rows


def text(spark, table: str, values: list[tuple]):
    return spark.createDataFrame(values, as_text(table))


RAW_CUSTOMERS = [
    ("9", "Ann Lee", "PUNE ", "2024-01-05", "vip"),
    ("10", "ann lee ", "pune", "05/01/2024", "vip"),
    ("2", "Bob", None, "05-Nov-2024", " "),
    ("11", "Bob", "", "2024-01-01", "new"),
    ("12", "Bob", "navi mumbai", "never", "new"),
]


def test_customers_are_deduplicated_by_lowest_numeric_id(spark):
    found = rows(cleaning.clean_customers(text(spark, "customers", RAW_CUSTOMERS)).orderBy("customer_id"))
    assert found == [
        (2, "Bob", None, dt.date(2024, 11, 5), None),
        (9, "Ann Lee", "Pune", dt.date(2024, 1, 5), "vip"),
        (12, "Bob", "Navi Mumbai", None, "new"),
    ]


def test_many_copies_of_one_customer(spark):
    raw = spark.range(0, 3000, 1, 4).selectExpr(
        "string(id + 5) AS customer_id",
        "CASE WHEN id % 3 = 0 THEN 'Hot' ELSE concat('P', id % 100) END AS name",
        "CASE WHEN id % 2 = 0 THEN 'goa' ELSE ' GOA' END AS city",
        "'2024-01-01' AS signup_date",
        "'new' AS segment",
    )
    found = dict(rows(cleaning.dedup_customers(raw).select("name", "customer_id")))
    assert found["Hot"] == 5 and len(found) == 101


def test_orders_rules(spark, market):
    raw = text(
        spark,
        "orders",
        [
            ("1", "1", "10", "", "2024-01-05 10:00:00", "delivered", " card ", "12.50", "-3", ""),
            ("2", "1", "10", "2", "2024-01-05 10:00:00", "delivered", " ", "", "0", "1.5"),
            ("3", "99", "10", "2", "2024-01-05 10:00:00", "delivered", "upi", "1", "5", "0"),
            ("4", "1", "99", "2", "2024-01-05 10:00:00", "delivered", "upi", "1", None, "0"),
        ],
    )
    when = dt.datetime(2024, 1, 5, 10)
    found = cleaning.clean_orders(raw, market.customers, market.restaurants)
    assert found.columns == TABLES["orders"].names
    assert sorted(rows(found)) == [
        (1, 1, 10, None, when, "delivered", "card", Decimal("12.50"), None, Decimal("0.00")),
        (2, 1, 10, 2, when, "delivered", None, None, 0, Decimal("1.50")),
    ]
    assert dict(found.dtypes)["order_timestamp"] == "timestamp_ntz"


def test_bad_required_number_fails_the_load(spark):
    raw = text(spark, "menu_items", [("x1", "10", "naan", "Breads", "2")])
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        cleaning.clean_menu_items(raw).collect()


def test_children_follow_their_orders(spark, market):
    items = text(spark, "order_items", [("1", "1", "100", "2", ""), ("2", "77", "100", "1", "2.00")])
    reviews = text(spark, "reviews", [("1", "1", "", "ok", "13/02/2024"), ("2", "77", "5", "ok", "2024-01-01")])
    kept = cleaning.clean_order_items(items, market.orders)
    assert kept.columns == TABLES["order_items"].names and rows(kept) == [(1, 1, 100, 2, None)]
    kept = cleaning.clean_reviews(reviews, market.orders)
    assert kept.columns == TABLES["reviews"].names and rows(kept) == [(1, 1, None, "ok", dt.date(2024, 2, 13))]


def test_clean_tables_round_trip_through_text(spark, market):
    raw = {name: staging.to_text(df) for name, df in market.items()}
    cleaned = cleaning.clean_all(raw)
    for name, df in market.items():
        again = getattr(cleaned, name)
        assert again.schema.names == df.columns
        assert sorted(rows(again), key=repr) == sorted(rows(df), key=repr), name


def test_audit_counts_each_rule(make, market):
    tables = dict(market.items())
    tables["orders"] = make(
        "orders",
        [
            order(1, 1, 10, "2024-01-05T10:00:00", "-1.00", status="lost", method="gold", rider=None),
            order(1, 50, 10, "2024-01-05T10:00:00", "1.00", rider=7),
            order(1, 50, 60, "2024-01-05T10:00:00", "1.00", method=None, discount=-1),
            (None, 1, 10, None, None, "delivered", None, None, None, None),
            (None, 1, 10, None, None, "delivered", None, None, None, None),
        ],
    )
    found = {(t, r): n for t, r, n in rows(quality.constraint_audit(tables))}
    broken = {rule: n for (table, rule), n in found.items() if table == "orders" and n}
    assert broken == {
        "order_id unique": 2,
        "order_id not null": 2,
        "order_timestamp not null": 2,
        "status in domain": 1,
        "payment_method in domain": 1,
        "total_amount in range": 1,
        "discount_applied in range": 1,
        "customer_id in customers": 2,
        "restaurant_id in restaurants": 1,
        "rider_id in riders": 1,
    }
    assert found[("order_items", "order_id in orders")] == 2  # orders 3 and 5
    assert found[("customers", "segment in domain")] == 0


def test_counts_and_summary(spark, market):
    counts = dict(rows(quality.row_counts(dict(market.items()))))
    assert counts["orders"] == 7 and counts["reviews"] == 3 and len(counts) == 7
    raw = text(spark, "customers", RAW_CUSTOMERS)
    found = quality.dq_summary(raw, cleaning.clean_customers(raw), market.restaurants, market.orders, market.reviews)
    assert rows(found) == [(3, 2, 1, 1, 2, 0)]


def test_dates_that_fit_no_pattern_are_counted(spark, fixtures):
    raw = dict(fixtures.raw)
    texts = [("1", "2024/01/05"), ("2", "05/11/2024"), ("3", ""), ("4", "20240105")]
    raw["riders"] = spark.createDataFrame(texts, "rider_id string, join_date string")
    found = {r["table_name"]: (r["date_texts"], r["unparsed"]) for r in quality.unparsed_dates(raw).collect()}
    assert found["riders"] == (3, 2) and found["reviews"][1] == 0


def test_audit_with_repeated_and_far_keys(spark, make, market):
    """Repeated keys, ids below zero and far apart, and orphans among them."""
    far = 2**62
    customers = make("customers", [(k, "n", None, None, None) for k in (1, 1, 1, -5, 0, far, far)])
    orders = market.orders.withColumn("customer_id", F.expr(f"element_at(array(1L, -5L, 0L, {far}L, -{far}L, NULL, 1L), cast(order_id AS int))"))
    found = {(t, r): n for t, r, n in rows(quality.constraint_audit({"customers": customers, "orders": orders}))}
    assert found["customers", "customer_id unique"] == 3
    assert found["orders", "customer_id in customers"] == 1
    assert found["orders", "order_id unique"] == 0 and ("orders", "rider_id in riders") not in found
    assert set({(t, r): n for t, r, n in rows(quality.constraint_audit({"customers": customers.limit(0)}))}.values()) == {0}
