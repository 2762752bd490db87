"""The seven marketplace tables as lazily built DataFrames."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from bazaarlens.schemas import TABLES
from bazaarlens.sources.snapshots import current, table_path


@dataclass(frozen=True)
class Marketplace:
    customers: DataFrame
    restaurants: DataFrame
    menu_items: DataFrame
    riders: DataFrame
    orders: DataFrame
    order_items: DataFrame
    reviews: DataFrame

    def items(self) -> list[tuple[str, DataFrame]]:
        return [(name, getattr(self, name)) for name in TABLES]


def read_marketplace(spark: SparkSession, folder: str, version: str | None = None) -> Marketplace:
    """Typed tables written by :func:`bazaarlens.sources.sinks.refresh`: all of the current version, or of the one named.

    A folder without versions has its tables in it as they are.
    """
    if version is None:
        found = current(spark, folder)
        version = found["version"] if found else None
    return Marketplace(
        **{name: spark.read.schema(schema).parquet(table_path(folder, name, version)) for name, schema in TABLES.items()}
    )


def create_views(market: Marketplace, prefix: str = "") -> None:
    """Register every table as a temporary view for ``spark.sql``."""
    for name, df in market.items():
        df.createOrReplaceTempView(f"{prefix}{name}")


def create_star_views(star: dict[str, DataFrame], prefix: str = "") -> list[str]:
    """Name the dimensions and facts of a star schema, for use in SQL; returns the names."""
    for name, df in star.items():
        df.createOrReplaceTempView(f"{prefix}{name}")
    return [f"{prefix}{name}" for name in star]
