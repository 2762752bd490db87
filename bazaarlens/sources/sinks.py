"""Writers: full refresh, dashboard marts, and layouts for selective or co-located reads."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from bazaarlens.functions.dates import month_of
from bazaarlens.operators import cleaning
from bazaarlens.sources.marketplace import Marketplace
from bazaarlens.sources.snapshots import Snapshot


def refresh(market: Marketplace, folder: str) -> str:
    """Replace every typed table with the given contents; the name of the new version.

    All tables become a new version beside the old one, which the contents may be read from, and which
    readers see until the last step. So a failure at any point leaves one whole version.
    """
    snapshot = Snapshot(market.orders.sparkSession, folder)
    for name, df in market.items():
        snapshot.put(name, df)
    return snapshot.commit()


def refresh_from_text(raw: dict[str, DataFrame], folder: str) -> str:
    """Clean the raw tables and replace the typed ones, parents first; the name of the new version.

    Children are checked against the parents as written, so each raw table is parsed once.
    """
    snapshot = Snapshot(raw["orders"].sparkSession, folder)
    customers = snapshot.put("customers", cleaning.clean_customers(raw["customers"]))
    restaurants = snapshot.put("restaurants", cleaning.clean_restaurants(raw["restaurants"]))
    snapshot.put("menu_items", cleaning.clean_menu_items(raw["menu_items"]))
    snapshot.put("riders", cleaning.clean_riders(raw["riders"]))
    orders = snapshot.put("orders", cleaning.clean_orders(raw["orders"], customers, restaurants))
    snapshot.put("order_items", cleaning.clean_order_items(raw["order_items"], orders))
    snapshot.put("reviews", cleaning.clean_reviews(raw["reviews"], orders))
    return snapshot.commit()


def write_marts(star: dict[str, DataFrame], folder: str) -> None:
    """Star schema for dashboards: facts split by month, dimensions plain."""
    for name, df in star.items():
        if name.startswith("fact_"):
            monthly = df.withColumn("month", month_of("date_key"))
            # A month may hold most of the rows: rebalance splits it over several
            # tasks, where repartition("month") would give it to one.
            monthly.hint("rebalance", "month").write.mode("overwrite").partitionBy("month").parquet(
                f"{folder}/{name}"
            )
        else:
            df.write.mode("overwrite").parquet(f"{folder}/{name}")


def write_lookup_layout(orders: DataFrame, path: str, key: str = "restaurant_id", also: Mapping[str, int] | None = None, group_bytes: int | None = None) -> None:
    """Orders clustered by ``key``, so a lookup of one value skips most row groups.

    Range partitioning on the key and the order id spreads a hot key over many
    files; sorting inside each file gives its row groups narrow key ranges. Further keys, in ``also`` with about how many
    different values a row group has of each, get Bloom filters, by which a lookup skips the row groups that
    don't hold its value; that pays for keys of few rows. ``group_bytes`` sets the size of a row group.
    """
    writer = orders.repartitionByRange(key, "order_id").sortWithinPartitions(key, "order_id").write.mode("overwrite")
    for other, values in (also or {}).items():
        writer = writer.option(f"parquet.bloom.filter.enabled#{other}", "true").option(f"parquet.bloom.filter.expected.ndv#{other}", str(values))
        # A dictionary would take the filter's place.
        writer = writer.option(f"parquet.enable.dictionary#{other}", "false")
    if group_bytes is not None:
        writer = writer.option("parquet.block.size", str(group_bytes))
    writer.parquet(path)


def save_bucketed(df: DataFrame, table: str, key: str, buckets: int, path: str | None = None) -> None:
    """Table bucketed and sorted by ``key``: joins of two such tables need no shuffle.

    Rows are brought together by key before the write, or every task would open a
    file in every bucket; rebalancing, unlike a plain repartition, splits a hot key. The files are in ``path``, if given, else in the warehouse.
    """
    writer = df.hint("rebalance", key).write.mode("overwrite").bucketBy(buckets, key).sortBy(key).format("parquet")
    (writer if path is None else writer.option("path", path)).saveAsTable(table)


def lookup(orders: DataFrame, key: str, value: int, status: str = "delivered") -> DataFrame:
    """Orders of one key value in one status; both filters reach the scan."""
    return orders.filter((F.col(key) == value) & (F.col("status") == status)).select(
        "order_id", "total_amount"
    )
