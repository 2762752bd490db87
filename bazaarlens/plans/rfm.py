"""Recency, frequency and monetary scoring."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from bazaarlens.functions.numeric import average_money, cents, mean, money
from bazaarlens.operators.aggregates import delivered, per_key
from bazaarlens.operators.ranking import TASK_ROWS, ntiles_by_bounds
from bazaarlens.plans.revenue import share_of_all
from bazaarlens.session import cut_lineage

QUANTILES = 5

# Segments, fixed values: name, then lowest and highest score for recency,
# frequency and monetary; the first that fits decides.
ANY = (None, None)
LAPSED_SPENDERS = "Cant Lose Them"
OTHER_SEGMENT = "Needs Attention"
SEGMENTS = [
    ("Champions", (4, None), (4, None), (4, None)),
    ("Loyal", (4, None), (3, None), ANY),
    ("New / Promising", (4, None), (None, 2), ANY),
    ("Potential Loyalist", (3, 3), (3, None), ANY),
    ("At Risk", (None, 2), (4, None), ANY),
    (LAPSED_SPENDERS, (None, 2), (3, None), (4, None)),
    ("Hibernating / Lost", (None, 2), (None, 2), ANY),
]


def rfm_base(orders: DataFrame) -> DataFrame:
    """Date of the last delivered order, number of orders and revenue in cents per customer."""
    keyed = per_key(
        delivered(orders),
        "customer_id",
        {"last": F.max("order_timestamp"), "frequency": F.count("*"), "cents": F.sum(cents("total_amount"))},
    )
    return keyed.select(
        "customer_id",
        F.col("last").cast("date").alias("last_day"),
        "frequency",
        "cents",
    )


def rfm_scored(orders: DataFrame, buckets: int = QUANTILES, task_rows: int = TASK_ROWS) -> DataFrame:
    """Quantile scores ``r``, ``f``, ``m``; the highest bucket is the best on each axis.

    Orders are read once: number of customers and latest date come from the written rows per customer.
    """
    base = cut_lineage(rfm_base(orders))
    rows, latest = base.agg(F.count("*"), F.max("last_day")).first()
    recency = F.datediff(F.lit(latest).cast("date"), "last_day").alias("recency_days")
    scored = base.select("customer_id", recency, "frequency", "cents")
    axes = [("recency_days", "r", True), ("frequency", "f", False), ("cents", "m", False)]
    return ntiles_by_bounds(scored, buckets, axes, "customer_id", rows, task_rows)


def rfm_scores(orders: DataFrame, **options: int) -> DataFrame:
    """Scores per customer, the three digits as one code, and their sum."""
    axes = ("r", "f", "m")
    return (
        rfm_scored(orders, **options)
        .select(
            "customer_id",
            "recency_days",
            "frequency",
            money("cents").alias("monetary"),
            *[F.col(a).alias(f"{a}_score") for a in axes],
            F.concat(*[F.col(a).cast("string") for a in axes]).alias("rfm_cell"),
            (F.col("r") + F.col("f") + F.col("m")).alias("rfm_total"),
        )
        .orderBy(F.desc_nulls_first("rfm_total"), "customer_id")
    )


def _within(axis: str, bounds: tuple[int | None, int | None]) -> Column:
    low, high = bounds
    inside = F.lit(True)
    if low is not None:
        inside = inside & (F.col(axis) >= low)
    if high is not None:
        inside = inside & (F.col(axis) <= high)
    return inside


def segment_label(with_lapsed_spenders: bool = True) -> Column:
    """Marketing segment of a score triple ``r``, ``f``, ``m``."""
    label = F.lit(OTHER_SEGMENT)
    for name, *bounds in reversed(SEGMENTS):
        if name == LAPSED_SPENDERS and not with_lapsed_spenders:
            continue
        fits = reduce(Column.__and__, [_within(axis, b) for axis, b in zip("rfm", bounds)])
        label = F.when(fits, name).otherwise(label)
    return label


def rfm_segments(orders: DataFrame, **options: int) -> DataFrame:
    """Scores and segment per customer."""
    return (
        rfm_scored(orders, **options)
        .withColumn("segment", segment_label())
        .select("customer_id", "recency_days", "frequency", money("cents").alias("monetary"), "r", "f", "m", "segment")
        .orderBy("segment", F.desc_nulls_first("monetary"), "customer_id")
    )


def _by_segment(orders: DataFrame, label: Column, options: dict[str, int]) -> DataFrame:
    return (
        rfm_scored(orders, **options)
        .groupBy(label.alias("segment"))
        .agg(
            F.count("*").alias("customers"),
            F.sum("cents").alias("cents"),
            F.sum("frequency").alias("orders"),
            F.count("cents").alias("priced"),
        )
    )


def rfm_rollup(orders: DataFrame, **options: int) -> DataFrame:
    """Size, revenue, shares and averages per segment."""
    return (
        _by_segment(orders, segment_label(), options)
        .select(
            "segment",
            "customers",
            share_of_all("customers").alias("pct_customers"),
            money("cents").alias("total_revenue"),
            share_of_all("cents").alias("pct_revenue"),
            average_money("cents", "priced").alias("avg_revenue_per_customer"),
            mean("orders", "customers", 1).alias("avg_orders"),
        )
        .orderBy(F.desc_nulls_first("total_revenue"), "segment")
    )


def rfm_rollup_headline(orders: DataFrame, **options: int) -> DataFrame:
    """Headline variant: seven segments, without the one for lapsed high spenders."""
    return (
        _by_segment(orders, segment_label(with_lapsed_spenders=False), options)
        .select("segment", "customers", share_of_all("cents").alias("pct_revenue"))
        .orderBy(F.desc_nulls_first("pct_revenue"), "segment")
    )
