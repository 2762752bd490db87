"""Marketplace tables derived from the test Parquet files.

The files hold customers, suppliers, parts, orders and lines of a wholesale
data set; every function maps one of them to a marketplace table by fixed
arithmetic on its keys, so all rows of the input are used.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F

from bazaarlens.functions.dates import parse_date
from bazaarlens.sources.marketplace import Marketplace
from bazaarlens.sources.staging import to_text

DUPLICATE_OFFSET = 1_000_000_000_000

# Category tree over the part types; LARGE stays outside on purpose.
CATEGORY_TREE = [
    ("Tiered", None),
    ("Sized", None),
    ("STANDARD", "Tiered"),
    ("ECONOMY", "Tiered"),
    ("PROMO", "Tiered"),
    ("SMALL", "Sized"),
    ("MEDIUM", "Sized"),
]

# Columns read from each file; a declared schema spares a look at the footers.
FILES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int",
    "part": "p_partkey bigint, p_name string, p_type string, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,"
    " o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_quantity double",
}


class Fixtures:
    """Lazily built tables over one folder of test Parquet files."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def _read(self, table: str) -> DataFrame:
        return self.spark.read.schema(FILES[table]).parquet(f"{self.folder}/{table}.parquet")

    @cached_property
    def _suppliers(self) -> int:
        return self._read("supplier").count()

    @cached_property
    def customers(self) -> DataFrame:
        return (
            self._read("customer")
            .join(self._read("nation"), F.expr("c_nationkey = n_nationkey"))
            .selectExpr(
                "c_custkey AS customer_id",
                "c_name AS name",
                "CASE WHEN c_custkey % 25 <> 0 THEN n_name END AS city",
                "date_add(DATE '1994-06-01', int(c_custkey % 900)) AS signup_date",
                "lower(c_mktsegment) AS segment",
            )
        )

    @cached_property
    def _located_suppliers(self) -> DataFrame:
        return self._read("supplier").join(self._read("nation"), F.expr("s_nationkey = n_nationkey"))

    @cached_property
    def restaurants(self) -> DataFrame:
        return self._located_suppliers.join(
            self._read("region"), F.expr("n_regionkey = r_regionkey")
        ).selectExpr(
            "s_suppkey AS restaurant_id",
            "s_name AS name",
            "r_name AS cuisine_type",
            "n_name AS city",
            "date_add(DATE '1990-01-01', int(s_suppkey % 1500)) AS active_since",
            "CASE WHEN s_suppkey % 20 <> 7"
            " THEN cast((260 + s_suppkey * 37 % 240) / 100 AS decimal(3,2)) END AS avg_rating",
        )

    @cached_property
    def menu_items(self) -> DataFrame:
        return self._read("part").selectExpr(
            "p_partkey AS item_id",
            f"p_partkey % {self._suppliers} AS restaurant_id",
            "p_name AS name",
            "p_type AS category",
            "cast(p_retailprice AS decimal(8,2)) AS price",
        )

    @cached_property
    def riders(self) -> DataFrame:
        return self._located_suppliers.selectExpr(
            "s_suppkey AS rider_id",
            "s_name AS name",
            "n_name AS city",
            "date_add(DATE '1991-01-01', int(s_suppkey % 1900)) AS join_date",
            "array('bike', 'scooter', 'car', 'bicycle')[int(s_suppkey % 4)] AS vehicle_type",
        )

    @cached_property
    def orders(self) -> DataFrame:
        n = self._suppliers
        return self._read("orders").selectExpr(
            "o_orderkey AS order_id",
            "o_custkey AS customer_id",
            f"o_orderkey % {n} AS restaurant_id",
            f"CASE WHEN o_orderstatus <> 'O' THEN (o_orderkey div {n}) % {n} END AS rider_id",
            "o_orderdate + make_dt_interval(0, int(8 + o_orderkey % 16), int(o_orderkey * 7 % 60))"
            " AS order_timestamp",
            "CASE WHEN o_orderstatus = 'O' THEN 'cancelled'"
            " WHEN o_orderstatus = 'P' AND (o_orderkey + o_custkey) % 4 = 0 THEN 'in_progress'"
            " WHEN o_orderstatus = 'P' AND (o_orderkey + o_custkey) % 4 = 1 THEN 'refunded'"
            " ELSE 'delivered' END AS status",
            "o_orderpriority AS payment_method",
            "cast(o_totalprice AS decimal(12,2)) AS total_amount",
            "int(CASE WHEN o_orderstatus = 'O' OR o_orderkey % 199 = 0 THEN NULL"
            " WHEN o_orderkey % 201 = 0 THEN -1 - o_orderkey % 20"
            " WHEN o_orderkey % 167 = 0 THEN 300 + o_orderkey % 301"
            " ELSE 15 + (o_orderkey * 37 + o_custkey * 11) % 56 END) AS delivery_time_minutes",
            "cast(CASE WHEN o_orderkey % 20 < 7 THEN 5 * (1 + o_orderkey % 4) ELSE 0 END AS decimal(12,2))"
            " AS discount_applied",
        )

    @cached_property
    def order_items(self) -> DataFrame:
        return (
            self._read("lineitem")
            .join(self._read("part").select("p_partkey", "p_retailprice"), F.expr("l_partkey = p_partkey"))
            .selectExpr(
                "l_orderkey AS order_id",
                "l_partkey AS item_id",
                "int(l_quantity) AS quantity",
                "cast(p_retailprice AS decimal(8,2)) AS unit_price",
            )
        )

    @cached_property
    def raw_reviews(self) -> DataFrame:
        """Text level: dates in three spellings, missing ratings blank."""
        return (
            self.orders.filter("status IN ('delivered', 'refunded') AND (order_id + customer_id) % 2 = 0")
            .selectExpr(
                "order_id",
                "order_id + customer_id AS mixed",
                "date_add(date(order_timestamp), int(order_id % 11)) AS day",
            )
            .selectExpr(
                "string(order_id) AS review_id",
                "string(order_id) AS order_id",
                "CASE WHEN mixed % 40 = 2 THEN '' ELSE string(1 + mixed div 2 % 5) END AS rating",
                "'' AS review_text",
                "CASE WHEN order_id % 67 = 0 THEN date_format(day, 'dd/MM/yyyy')"
                " WHEN order_id % 53 = 0 THEN date_format(day, 'MM/dd/yyyy')"
                " ELSE date_format(day, 'yyyy-MM-dd') END AS review_date",
            )
        )

    @cached_property
    def reviews(self) -> DataFrame:
        """Typed reviews of the orders at hand."""
        return self.raw_reviews.select(
            F.expr("bigint(review_id) AS review_id"),
            F.expr("bigint(order_id) AS order_id"),
            F.expr("int(nullif(rating, '')) AS rating"),
            F.expr("nullif(review_text, '') AS review_text"),
            parse_date(F.col("review_date")).alias("review_date"),
        )

    @cached_property
    def raw_customers(self) -> DataFrame:
        """Text level: untidy cities, and some customers signed up twice."""
        untidy = self.customers.selectExpr(
            "customer_id",
            "name",
            "CASE customer_id % 33 WHEN 1 THEN lower(city) WHEN 2 THEN upper(city)"
            " WHEN 3 THEN city || ' ' ELSE city END AS city",
            "signup_date",
            "segment",
        )
        again = untidy.filter("customer_id % 61 = 5").selectExpr(
            f"customer_id + {DUPLICATE_OFFSET} AS customer_id",
            "name",
            "city",
            "CASE customer_id % 3 WHEN 0 THEN date_format(signup_date, 'dd/MM/yyyy')"
            " WHEN 1 THEN date_format(signup_date, 'MM-dd-yyyy')"
            " ELSE date_format(signup_date, 'dd-MMM-yyyy') END AS signup_date",
            "segment",
        )
        return to_text(untidy.withColumn("signup_date", F.expr("string(signup_date)")).unionByName(again))

    @cached_property
    def raw_orders(self) -> DataFrame:
        """Text level: some orders were placed under the second sign-up."""
        moved = F.expr(
            "CASE WHEN customer_id % 61 = 5 AND order_id % 7 = 3"
            f" THEN customer_id + {DUPLICATE_OFFSET} ELSE customer_id END"
        )
        return to_text(self.orders.withColumn("customer_id", moved))

    @cached_property
    def raw_restaurants(self) -> DataFrame:
        return to_text(self.restaurants)

    @cached_property
    def raw_menu_items(self) -> DataFrame:
        return to_text(self.menu_items)

    @cached_property
    def raw_riders(self) -> DataFrame:
        return to_text(self.riders)

    @cached_property
    def raw_order_items(self) -> DataFrame:
        return to_text(self.order_items)

    @property
    def raw(self) -> dict[str, DataFrame]:
        names = ("customers", "restaurants", "menu_items", "riders", "orders", "order_items", "reviews")
        return {name: getattr(self, f"raw_{name}") for name in names}

    @property
    def market(self) -> Marketplace:
        return Marketplace(
            self.customers,
            self.restaurants,
            self.menu_items,
            self.riders,
            self.orders,
            self.order_items,
            self.reviews,
        )


_OPEN: dict[tuple[str, str], Fixtures] = {}


def open_fixtures(spark: SparkSession, folder: str) -> Fixtures:
    """The tables of a folder, built once per application; DataFrames are lazy, nothing is cached."""
    key = (spark.sparkContext.applicationId, folder)
    if key not in _OPEN:
        _OPEN[key] = Fixtures(spark, folder)
    return _OPEN[key]
