"""Named business metrics over the order fact, for any grouping and filter.

A metric is a sum or count that adds up across groups, a distinct count of
customers, or a formula over those. ``metric`` uses that: it sums per foreign
key first, looks dimension attributes up on the much smaller result, filters,
and sums again, so neither a large dimension nor a key with a large share of
the orders makes the fact table itself go through a join. With distinct
customers the first sum would be per key and customer and save little, so then
the dimensions are joined directly, and one sum per group and customer follows.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from bazaarlens.functions.numeric import TOTAL, cents, money, sum_if
from bazaarlens.operators.aggregates import count_where, sums
from bazaarlens.operators.joins import broadcast_if_small

_DONE = "is_delivered"


def _divide(numerator: str, denominator: str) -> Callable[[], Column]:
    """Blank where the divisor is zero or missing."""
    return lambda: F.try_divide(_value(numerator).cast(TOTAL), F.col(denominator).cast("decimal(20,0)"))


# Metrics that add up: name -> aggregate over the order fact; money in cents.
ADDITIVE: dict[str, Callable[[], Column]] = {
    "total_orders": lambda: F.count("*"),
    "delivered_orders": lambda: count_where(F.col(_DONE)),
    "total_revenue": lambda: sum_if(F.col(_DONE), cents("total_amount")),
    "discount_given": lambda: sum_if(F.col(_DONE), cents("discount_applied")),
    "items_sold": lambda: sum_if(F.col(_DONE), "total_quantity"),
    "valid_deliveries": lambda: count_where(F.col(_DONE) & F.col("delivery_time_minutes").isNotNull()),
    "delivery_minutes": lambda: sum_if(F.col(_DONE), "delivery_time_minutes"),
    "on_time_orders": lambda: count_where(F.col("is_on_time")),
    "cancelled_orders": lambda: count_where(F.col("is_cancelled")),
}

_MONEY = ("total_revenue", "discount_given")

ACTIVE_CUSTOMERS = "active_customers"

# Formulas: name -> (metrics needed, expression over them).
DERIVED: dict[str, tuple[tuple[str, ...], Callable[[], Column]]] = {
    "average_order_value": (("total_revenue", "delivered_orders"), _divide("total_revenue", "delivered_orders")),
    "avg_delivery_time": (("delivery_minutes", "valid_deliveries"), _divide("delivery_minutes", "valid_deliveries")),
    "on_time_rate": (("on_time_orders", "valid_deliveries"), _divide("on_time_orders", "valid_deliveries")),
    "cancellation_rate": (("cancelled_orders", "total_orders"), _divide("cancelled_orders", "total_orders")),
    "revenue_per_customer": (("total_revenue", ACTIVE_CUSTOMERS), _divide("total_revenue", ACTIVE_CUSTOMERS)),
}


@dataclass(frozen=True)
class Dimension:
    """A dimension table and the key it shares with the fact; facts without a match are kept."""

    table: DataFrame
    key: str


def _value(name: str) -> Column:
    if name in DERIVED:
        return DERIVED[name][1]()
    return money(name) if name in _MONEY else F.col(name)


def _needed(measures: Sequence[str]) -> list[str]:
    needed: list[str] = []
    for name in measures:
        for part in DERIVED[name][0] if name in DERIVED else (name,):
            if part not in needed:
                needed.append(part)
    return needed


def _slice(fact: DataFrame, attribute: str, values: Sequence, dim: Dimension | None) -> DataFrame:
    """Facts whose dimension member has one of ``values``.

    The lowest and highest matching keys are looked up first and become a range
    filter, which reaches the scan and skips row groups; ``month`` is filtered
    too where the fact is partitioned by it.
    """
    if dim is None:
        return fact.filter(F.col(attribute).isin(list(values)))
    key = dim.key
    keys = dim.table.filter(F.col(attribute).isin(list(values))).select(key)
    low, high = keys.agg(F.min(key), F.max(key)).first()
    kept = fact.filter(F.col(key).between(F.lit(low), F.lit(high)))
    if key == "date_key" and "month" in fact.columns:
        kept = kept.filter(F.col("month").between(F.trunc(F.lit(low), "MM"), F.trunc(F.lit(high), "MM")))
    return kept.join(broadcast_if_small(keys), key, "left_semi")


def _lookups(by: Sequence[str], dims: Mapping[str, Dimension]) -> list[tuple[str, DataFrame, list[str]]]:
    """One join for each dimension table used in ``by``, with its key and attributes."""
    found: dict[tuple[str, int], tuple[str, DataFrame, list[str]]] = {}
    for attribute, dim in dims.items():
        if attribute in by:
            found.setdefault((dim.key, id(dim.table)), (dim.key, dim.table, []))[2].append(attribute)
    return list(found.values())


def metric(
    fact: DataFrame,
    measures: Sequence[str],
    by: Sequence[str] = (),
    dims: Mapping[str, Dimension] | None = None,
    slicers: Mapping[str, Sequence] | None = None,
) -> DataFrame:
    """Evaluate ``measures`` for each combination of ``by``.

    ``dims`` maps attribute names used in ``by`` or ``slicers`` to the dimension
    that has them; all other names are columns of the fact. ``slicers`` keeps the
    listed values of an attribute, before anything is summed.
    """
    dims = dims or {}
    for attribute, values in (slicers or {}).items():
        fact = _slice(fact, attribute, values, dims.get(attribute))
    needed = _needed(measures)
    additive = [n for n in needed if n in ADDITIVE]
    distinct = ACTIVE_CUSTOMERS in needed
    if distinct and "delivered_orders" not in additive:
        additive.append("delivered_orders")
    joined = _lookups(by, dims)

    summed = fact
    if not distinct:
        keys = [c for c in by if c not in dims]
        keys += [k for k in dict.fromkeys(key for key, _, _ in joined) if k not in keys]
        summed = fact.groupBy(*keys).agg(*[ADDITIVE[n]().alias(n) for n in additive])
    for key, table, attributes in joined:
        summed = summed.join(table.select(key, *attributes), key, "left")
    if not distinct:
        result = summed.groupBy(*by).agg(*sums(additive))
    else:
        # One row per group and customer, so counting rows counts customers once.
        keys = [*by, *(["customer_id"] if "customer_id" not in by else [])]
        per_customer = summed.groupBy(*keys).agg(*[ADDITIVE[n]().alias(n) for n in additive])
        bought = count_where(F.col("delivered_orders") > 0).alias(ACTIVE_CUSTOMERS)
        result = per_customer.groupBy(*by).agg(*sums(additive), bought)
    return result.select(*by, *[_value(m).alias(m) for m in measures])


def review_metrics(
    fact_reviews: DataFrame,
    by: Sequence[str] = (),
    dims: Mapping[str, Dimension] | None = None,
    slicers: Mapping[str, Sequence] | None = None,
) -> DataFrame:
    """Average rating and number of ratings; missing ratings are left out.

    ``dims`` and ``slicers`` work as in ``metric``: reviews share date, customer and restaurant keys
    with their dimensions. A review of a day outside the calendar falls to a blank member.
    """
    dims = dims or {}
    for attribute, values in (slicers or {}).items():
        fact_reviews = _slice(fact_reviews, attribute, values, dims.get(attribute))
    joined = _lookups(by, dims)
    keys = [c for c in by if c not in dims]
    keys += [k for k in dict.fromkeys(key for key, _, _ in joined) if k not in keys]
    rated = fact_reviews.groupBy(*keys).agg(F.sum("rating").alias("stars"), F.count("rating").alias("review_count"))
    for key, table, attributes in joined:
        rated = rated.join(table.select(key, *attributes), key, "left")
    counted = rated.groupBy(*by).agg(F.sum("stars").alias("stars"), F.coalesce(F.sum("review_count"), F.lit(0)).alias("review_count"))
    average = F.try_divide(F.col("stars").cast(TOTAL), F.col("review_count").cast("decimal(20,0)"))
    return counted.select(*by, average.alias("avg_rating"), "review_count")


def customer_metrics(
    fact: DataFrame,
    by: Sequence[str] = (),
    dims: Mapping[str, Dimension] | None = None,
    slicers: Mapping[str, Sequence] | None = None,
) -> DataFrame:
    """Active, new and returning customers and the repeat rate, for any grouping and filter.

    A customer is new in a group if the day of the first delivered order of all, whatever the grouping and
    filters, is one of the group's days: those of the calendar that the group and the date filters
    leave, gaps and all. Where no date attribute takes part these are all days, and
    all customers are new. First days are a minimum per customer; each group sees a customer once.
    """
    dims = dims or {}
    first = fact.filter(F.col(_DONE)).groupBy("customer_id").agg(F.min("date_key").alias("_first_day"))
    calendar = [a for a, d in dims.items() if d.key == "date_key" and (a in by or a in (slicers or {}))]
    if len({id(dims[a].table) for a in calendar}) > 1:
        raise ValueError(f"{', '.join(calendar)} come from different calendars")
    dated = [a for a in by if a in calendar]
    kept = fact.filter(F.col(_DONE))
    for attribute, values in (slicers or {}).items():
        kept = _slice(kept, attribute, values, dims.get(attribute))
    active = kept.select("customer_id", *[c for c in by if c not in dims], *dict.fromkeys(k for k, _, _ in _lookups(by, dims))).distinct()
    for key, table, attributes in _lookups(by, dims):
        active = active.join(table.select(key, *attributes), key, "left")
    customers = active.select("customer_id", *by).distinct().join(first, "customer_id")
    if calendar:
        days = dims[calendar[0]].table
        for attribute, values in (slicers or {}).items():
            if attribute in calendar:
                days = days.filter(F.col(attribute).isin(list(values)))
        chosen = days.select(F.col("date_key").alias("_first_day"), *[F.col(a).alias(f"_{a}") for a in dated], F.lit(True).alias("_new"))
        same = F.col("customer._first_day") == F.col("chosen._first_day")
        for attribute in dated:
            same &= F.col(f"customer.{attribute}").eqNullSafe(F.col(f"chosen._{attribute}"))
        placed = customers.alias("customer").join(chosen.alias("chosen"), same, "left").select("customer.*", "_new")
    else:
        placed = customers.withColumn("_new", F.lit(True))
    counts = placed.groupBy(*by).agg(F.count("*").alias(ACTIVE_CUSTOMERS), count_where(F.col("_new")).alias("new_customers"))
    back = F.col(ACTIVE_CUSTOMERS) - F.col("new_customers")
    return counts.select(
        *by,
        ACTIVE_CUSTOMERS,
        "new_customers",
        back.alias("returning_customers"),
        F.try_divide(back.cast(TOTAL), F.col(ACTIVE_CUSTOMERS).cast("decimal(20,0)")).alias("repeat_rate"),
    )


def revenue_label(value: Column) -> Column:
    """Revenue in crore or lakh with two decimals, or in full below one lakh."""
    crore, lakh = F.lit(10_000_000), F.lit(100_000)  # fixed values

    def scaled(unit: Column, suffix: str) -> Column:
        amount = F.round(value / unit, 2)
        return F.concat(F.call_function("format_number", amount, F.lit("0.00")), F.lit(f" {suffix}"))

    return (
        F.when(value >= crore, scaled(crore, "Cr"))
        .when(value >= lakh, scaled(lakh, "L"))
        .otherwise(F.call_function("format_number", F.round(value, 0), F.lit("#,##0")))
    )
