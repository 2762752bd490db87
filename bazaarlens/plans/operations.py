"""Delivery promises, speed, riders, cancellations and peak hours."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from bazaarlens.functions.numeric import mean, percent
from bazaarlens.operators.aggregates import (
    PROMISED_MINUTES,
    count_where,
    per_key,
    sum_by_dimension,
    sums,
    timed_deliveries,
)
from bazaarlens.operators.ranking import TASK_ROWS, global_ntile, measured, rank_by_value
from bazaarlens.plans.revenue import share_of_all, status_counts


def _timing(promised: int = PROMISED_MINUTES) -> dict[str, Column]:
    minutes = F.col("delivery_time_minutes")
    return {
        "deliveries": F.count("*"),
        "minutes": F.sum(minutes),
        "on_time": count_where(minutes <= promised),
    }


def sla_by_city(orders: DataFrame, restaurants: DataFrame, promised: int = PROMISED_MINUTES) -> DataFrame:
    """On-time deliveries by city, then a total row whose city is NULL."""
    keyed = per_key(timed_deliveries(orders), "restaurant_id", _timing(promised))
    city = (
        keyed.join(restaurants.select("restaurant_id", "city"), "restaurant_id")
        .rollup("city")
        .agg(*sums(["deliveries", "on_time"]), F.grouping("city").alias("is_total"))
    )
    return city.orderBy("is_total", F.asc_nulls_last("city")).select(
        "city",
        F.col("deliveries").alias("valid_deliveries"),
        "on_time",
        percent("on_time", "deliveries").alias("on_time_pct"),
    )


def delivery_percentiles(orders: DataFrame, restaurants: DataFrame) -> DataFrame:
    """Mean, median and 90th percentile of delivery minutes by city, exact.

    Minutes are counted per restaurant and value first: whole minutes in the
    valid range give at most 180 rows per restaurant, whatever the order volume.
    """
    counted = per_key(
        timed_deliveries(orders), ["restaurant_id", "delivery_time_minutes"], {"n": F.count("*")}
    )
    minutes, n = F.col("delivery_time_minutes"), F.col("n")
    city = (
        counted.join(restaurants.select("restaurant_id", "city"), "restaurant_id")
        .groupBy("city")
        .agg(
            F.sum(n).alias("deliveries"),
            F.sum(minutes * n).alias("minutes"),
            F.percentile(minutes, 0.5, n).alias("median_minutes"),
            F.percentile(minutes, 0.9, n).alias("p90_minutes"),
        )
    )
    return city.select(
        "city", "deliveries", mean("minutes", "deliveries", 1).alias("avg_minutes"), "median_minutes", "p90_minutes"
    ).orderBy(F.desc_nulls_first("avg_minutes"), "city")


# Values a sketch of minutes keeps; ranks it gives are off by less than SKETCH_ERROR of all rows (with 99 % confidence, about half of that).
SKETCH_SIZE, SKETCH_ERROR = 800, 0.01


def delivery_sketches(orders: DataFrame) -> DataFrame:
    """Valid deliveries per restaurant and month: their number and a mergeable quantile sketch of the minutes.

    Stored beside the facts, such rows give percentiles of any period and roll-up without reading orders again;
    ``delivery_percentiles`` is exact and remains the default.
    """
    keyed = timed_deliveries(orders).withColumn("month", F.trunc("order_timestamp", "MM"))
    minutes = F.col("delivery_time_minutes").cast("bigint")
    return keyed.groupBy("restaurant_id", "month").agg(F.count("*").alias("deliveries"), F.kll_sketch_agg_bigint(minutes, SKETCH_SIZE).alias("minutes_sketch"))


def percentiles_of_sketches(sketches: DataFrame, by: Sequence[str], quantiles: Mapping[str, float]) -> DataFrame:
    """Number of deliveries and the named quantiles of merged sketches for each combination of ``by``."""
    merged = sketches.groupBy(*by).agg(F.sum("deliveries").alias("deliveries"), F.kll_merge_agg_bigint("minutes_sketch", SKETCH_SIZE).alias("_sketch"))
    found = [F.kll_sketch_get_quantile_bigint("_sketch", F.lit(q)).alias(name) for name, q in quantiles.items()]
    return merged.select(*by, "deliveries", *found)


def sketched_percentiles(orders: DataFrame, restaurants: DataFrame) -> DataFrame:
    """Median and 90th percentile by city from sketches, checked against the orders.

    ``median_ok`` and ``p90_ok``: the share of deliveries up to the value and below it leave no more than
    ``SKETCH_ERROR`` to the quantile.
    """
    cities = restaurants.select("restaurant_id", "city")
    quantiles = {"median": 0.5, "p90": 0.9}
    found = percentiles_of_sketches(delivery_sketches(orders).join(cities, "restaurant_id"), ["city"], quantiles)
    counted = per_key(timed_deliveries(orders), ["restaurant_id", "delivery_time_minutes"], {"n": F.count("*")}).join(cities, "restaurant_id")
    by_city = counted.groupBy("city", "delivery_time_minutes").agg(F.sum("n").alias("n"))
    named = found.withColumnRenamed("city", "of_city")
    joined = by_city.join(named, F.col("city").eqNullSafe(F.col("of_city")))
    minutes, n = F.col("delivery_time_minutes"), F.col("n")
    checks = []
    for name, q in quantiles.items():
        below, upto = (F.sum(F.when(c, n).otherwise(0)) / F.max("deliveries") for c in (minutes < F.col(name), minutes <= F.col(name)))
        checks.append(((below <= q + SKETCH_ERROR) & (upto >= q - SKETCH_ERROR)).alias(f"{name}_ok"))
    return joined.groupBy("city").agg(F.max("deliveries").alias("deliveries"), *checks).orderBy("city")


def rider_leaderboard(orders: DataFrame, riders: DataFrame, min_deliveries: int = 30, k: int = 20) -> DataFrame:
    """Fastest riders among those with enough valid deliveries."""
    keyed = per_key(timed_deliveries(orders), "rider_id", _timing())
    return (
        keyed.filter(F.col("deliveries") >= min_deliveries)
        .join(riders, "rider_id")
        .withColumn("avg_minutes", mean("minutes", "deliveries", 1))
        .orderBy("avg_minutes", "rider_id")
        .limit(k)
        .select(
            "name",
            "city",
            "vehicle_type",
            "deliveries",
            "avg_minutes",
            percent("on_time", "deliveries").alias("on_time_pct"),
        )
    )


def rider_percentiles(
    orders: DataFrame, riders: DataFrame, min_deliveries: int = 30, task_rows: int = TASK_ROWS
) -> DataFrame:
    """Quartile, percent rank and rank of every rider by rounded average minutes."""
    keyed = per_key(
        timed_deliveries(orders).filter(F.col("rider_id").isNotNull()), "rider_id", _timing()
    ).filter(F.col("deliveries") >= min_deliveries)
    named, rows = measured(
        keyed.join(riders.select("rider_id", "name", "city"), "rider_id").select(
            "rider_id", "name", "city", "deliveries", mean("minutes", "deliveries", 1).alias("avg_minutes")
        )
    )
    order = [F.asc("avg_minutes"), F.asc("rider_id")]
    quartile = global_ntile(named, 4, order, "speed_quartile", rows, task_rows)
    ranked = rank_by_value(quartile, "avg_minutes", "fastest_rank", "share", rows, task_rows)
    share = F.round((100 * F.col("share")).cast("decimal(18,6)"), 1)
    return ranked.orderBy("avg_minutes", "rider_id").select(
        "name", "city", "deliveries", "avg_minutes", "speed_quartile", share.alias("pct_rank"), "fastest_rank"
    )


def cancel_refund_by_city(orders: DataFrame, restaurants: DataFrame) -> DataFrame:
    """Orders by outcome, with cancellation and refund rates, by city."""
    city = sum_by_dimension(orders, restaurants, "restaurant_id", ["city"], status_counts())
    return city.select(
        "city",
        *status_counts(),
        percent("cancelled", "total_orders").alias("cancel_rate_pct"),
        percent("refunded", "total_orders").alias("refund_rate_pct"),
    ).orderBy(F.desc_nulls_first("cancel_rate_pct"), "city")


def vehicle_performance(orders: DataFrame, riders: DataFrame) -> DataFrame:
    """Delivery time and on-time rate by vehicle type."""
    vehicles = sum_by_dimension(timed_deliveries(orders), riders, "rider_id", ["vehicle_type"], _timing())
    return vehicles.select(
        "vehicle_type",
        "deliveries",
        mean("minutes", "deliveries", 1).alias("avg_minutes"),
        percent("on_time", "deliveries").alias("on_time_pct"),
    ).orderBy("avg_minutes", "vehicle_type")


def peak_hours(orders: DataFrame) -> DataFrame:
    """Orders in any status by hour of day, with their share."""
    hours = per_key(orders.select(F.hour("order_timestamp").alias("hour_of_day")), "hour_of_day", {"orders": F.count("*")})
    return hours.withColumn("pct_of_orders", share_of_all("orders")).orderBy("hour_of_day")
