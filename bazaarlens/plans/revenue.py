"""Revenue, mix, popularity and rating reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from bazaarlens.functions.dates import month_of
from bazaarlens.functions.numeric import average_money, cents, mean, money, percent
from bazaarlens.operators.aggregates import count_where, delivered, per_key, sum_by_dimension, sums
from bazaarlens.operators.ranking import TASK_ROWS, measured, sequence_in_group, top_per_group

def orders_and_revenue() -> dict[str, Column]:
    return {
        "orders": F.count("*"),
        "cents": F.sum(cents("total_amount")),
        "priced": F.count("total_amount"),  # an average leaves out missing amounts
    }


def revenue_by_city(orders: DataFrame, restaurants: DataFrame) -> DataFrame:
    """Delivered orders, revenue and average order value by restaurant city."""
    city = sum_by_dimension(delivered(orders), restaurants, "restaurant_id", ["city"], orders_and_revenue())
    return city.select(
        "city",
        F.col("orders").alias("delivered_orders"),
        money("cents").alias("revenue"),
        average_money("cents", "priced").alias("avg_order_value"),
    ).orderBy(F.desc_nulls_first("revenue"), "city")


def top_restaurants(orders: DataFrame, restaurants: DataFrame, k: int = 15) -> DataFrame:
    """Restaurants with the most delivered revenue."""
    keyed = per_key(delivered(orders), "restaurant_id", orders_and_revenue())
    return (
        restaurants.join(keyed, "restaurant_id")
        .orderBy(F.desc_nulls_first("cents"), "restaurant_id")
        .limit(k)
        .select("restaurant_id", "name", "cuisine_type", "city", "avg_rating", "orders", money("cents").alias("revenue"))
    )


def cuisine_revenue(orders: DataFrame, restaurants: DataFrame, reviews: DataFrame) -> DataFrame:
    """Delivered orders, revenue and mean review rating by cuisine.

    Ratings are combined per order before the join. An order counts once per
    rated review, as it would in a plain outer join.
    """
    rated = per_key(
        reviews.filter(F.col("rating").isNotNull()),
        "order_id",
        {"ratings": F.count("*"), "stars": F.sum("rating")},
    )
    times = F.coalesce("ratings", F.lit(1))
    joined = delivered(orders).select("order_id", "restaurant_id", "total_amount").join(rated, "order_id", "left")
    cuisine = sum_by_dimension(
        joined,
        restaurants,
        "restaurant_id",
        ["cuisine_type"],
        {
            "orders": F.sum(times),
            "cents": F.sum(cents("total_amount") * times),
            "ratings": F.sum("ratings"),
            "stars": F.sum("stars"),
        },
    )
    return cuisine.select(
        "cuisine_type",
        "orders",
        money("cents").alias("revenue"),
        mean("stars", "ratings", 2).alias("avg_review_rating"),
    ).orderBy(F.desc_nulls_first("revenue"), "cuisine_type")


def share_of_all(value: str) -> Column:
    """Percentage of the total over all rows; for small aggregated frames only."""
    return percent(value, F.sum(value).over(Window.partitionBy()))


def payment_mix(orders: DataFrame) -> DataFrame:
    """Delivered orders, share and average order value by payment method."""
    methods = per_key(
        delivered(orders).filter(F.col("payment_method").isNotNull()), "payment_method", orders_and_revenue()
    )
    # One row per payment method.
    return methods.select(
        "payment_method",
        "orders",
        share_of_all("orders").alias("pct_of_orders"),
        average_money("cents", "priced").alias("avg_order_value"),
    ).orderBy(F.desc_nulls_first("orders"), "payment_method")


def customers_without_orders(customers: DataFrame, orders: DataFrame) -> DataFrame:
    """Customers who never had an order delivered.

    Buyers are made distinct before the join, so a customer with very many
    orders reaches it once.
    """
    buyers = delivered(orders).select("customer_id").distinct()
    return (
        customers.join(buyers, "customer_id", "left_anti")
        .select("customer_id", "name", "city", "signup_date", "segment")
        .orderBy(F.asc_nulls_last("signup_date"), "customer_id")
    )


def delivered_lines(order_items: DataFrame, orders: DataFrame) -> DataFrame:
    """Order lines of delivered orders."""
    return order_items.join(delivered(orders).select("order_id"), "order_id", "left_semi")


def popular_items(
    order_items: DataFrame, orders: DataFrame, menu_items: DataFrame, restaurants: DataFrame, k: int = 20
) -> DataFrame:
    """Items with the most units sold."""
    sold = per_key(
        delivered_lines(order_items, orders),
        "item_id",
        {"units_sold": F.sum("quantity"), "cents": F.sum(F.col("quantity") * cents("unit_price"))},
    )
    menu = menu_items.select("item_id", "restaurant_id", F.col("name").alias("item"), "category")
    places = restaurants.select("restaurant_id", F.col("name").alias("restaurant"))
    return (
        sold.join(menu, "item_id")
        .join(places, "restaurant_id")
        .orderBy(F.desc_nulls_first("units_sold"), "item_id")
        .limit(k)
        .select("item", "category", "restaurant", "units_sold", money("cents").alias("item_revenue"))
    )


def restaurant_ratings(
    orders: DataFrame, restaurants: DataFrame, reviews: DataFrame, min_reviews: int = 20, k: int = 20
) -> DataFrame:
    """Best rated restaurants among those with enough rated reviews, whatever the order status."""
    rated = per_key(
        reviews.filter(F.col("rating").isNotNull()),
        "order_id",
        {"reviews": F.count("*"), "stars": F.sum("rating")},
    )
    keyed = per_key(
        orders.select("order_id", "restaurant_id").join(rated, "order_id"),
        "restaurant_id",
        {"reviews": F.sum("reviews"), "stars": F.sum("stars")},
    )
    return (
        keyed.filter(F.col("reviews") >= min_reviews)
        .join(restaurants, "restaurant_id")
        .withColumn("avg_customer_rating", mean("stars", "reviews", 2))
        .orderBy(F.desc_nulls_first("avg_customer_rating"), "restaurant_id")
        .limit(k)
        .select("name", "city", "cuisine_type", "reviews", "avg_customer_rating")
    )


def monthly_totals(orders: DataFrame) -> DataFrame:
    return per_key(
        delivered(orders).select(month_of("order_timestamp").alias("month"), "total_amount"),
        "month",
        orders_and_revenue(),
    )


def monthly_revenue(orders: DataFrame) -> DataFrame:
    """Revenue per month, running total, and change against the previous month with orders."""
    by_month = Window.orderBy("month")  # one row per month
    before = F.lag("cents").over(by_month)
    change = F.col("cents") - before
    return (
        monthly_totals(orders)
        .select(
            "month",
            money("cents").alias("revenue"),
            money(F.sum("cents").over(by_month)).alias("running_total"),
            money(change).alias("mom_change"),
            percent(change, before).alias("mom_pct"),
        )
        .orderBy("month")
    )


def best_months(orders: DataFrame, k: int = 3) -> DataFrame:
    """Months with the most revenue."""
    return (
        monthly_totals(orders)
        .orderBy(F.desc_nulls_first("cents"), "month")
        .limit(k)
        .select(F.date_format("month", "yyyy-MM").alias("month"), F.round(money("cents"), 0).alias("revenue"))
    )


def yearly_revenue_yoy(orders: DataFrame) -> DataFrame:
    """Revenue per year against the same months of the year before."""
    months = monthly_totals(orders).select(
        F.year("month").alias("year"), F.month("month").alias("m"), "orders", "cents"
    )
    earlier = months.select((F.col("year") + 1).alias("year"), "m", F.col("cents").alias("before"))
    yearly = months.join(earlier, ["year", "m"], "left").groupBy("year").agg(*sums(["orders", "cents", "before"]))
    return yearly.select(
        "year",
        "orders",
        money("cents").alias("revenue"),
        money("before").alias("revenue_same_months_last_year"),
        percent(F.col("cents") - F.col("before"), "before").alias("yoy_pct"),
    ).orderBy("year")


def month_spine(orders: DataFrame, months: DataFrame) -> DataFrame:
    """Orders in any status and delivered revenue for every month of ``months``."""
    paid = F.when(F.col("status") == "delivered", F.col("total_amount"))
    found = per_key(
        orders.select(month_of("order_timestamp").alias("month"), paid.alias("paid")),
        "month",
        {"orders": F.count("*"), "cents": F.sum(cents("paid"))},
    )
    return (
        months.join(found, "month", "left")
        .select(
            "month",
            F.coalesce("orders", F.lit(0)).alias("orders"),
            money(F.coalesce("cents", F.lit(0))).alias("revenue"),
        )
        .orderBy("month")
    )


def top_restaurants_per_city(orders: DataFrame, restaurants: DataFrame, k: int = 3) -> DataFrame:
    """Restaurants of the first ``k`` revenue ranks in each city; equal names in a city count as one."""
    named = sum_by_dimension(
        delivered(orders), restaurants, "restaurant_id", ["city", "name"], {"cents": F.sum(cents("total_amount"))}
    )
    ranked = top_per_group(named, ["city"], [F.desc_nulls_first("cents")], k, "city_rank", ties=True)
    return ranked.select("city", "name", money("cents").alias("revenue"), "city_rank").orderBy(
        F.asc_nulls_last("city"), "city_rank", "name"
    )


def item_units(order_items: DataFrame, orders: DataFrame, menu_items: DataFrame) -> DataFrame:
    """Units sold per menu item."""
    sold = per_key(delivered_lines(order_items, orders), "item_id", {"units": F.sum("quantity")})
    return sold.join(menu_items.select("item_id", "restaurant_id", F.col("name").alias("item")), "item_id")


def top_items_per_restaurant(
    order_items: DataFrame, orders: DataFrame, menu_items: DataFrame, restaurants: DataFrame, k: int = 3
) -> DataFrame:
    """Best-selling items of every restaurant."""
    ranked = top_per_group(
        item_units(order_items, orders, menu_items),
        ["restaurant_id"],
        [F.desc_nulls_first("units"), F.asc("item_id")],
        k,
        "item_rank",
    )
    places = restaurants.select("restaurant_id", F.col("name").alias("restaurant"))
    return (
        ranked.join(places, "restaurant_id")
        .select("restaurant", "item", "units", "item_rank")
        .orderBy("restaurant", "item_rank")
    )


def item_rank_all(
    order_items: DataFrame, orders: DataFrame, menu_items: DataFrame, **options: int
) -> DataFrame:
    """Rank of every sold item within its restaurant."""
    units = item_units(order_items, orders, menu_items).select("restaurant_id", "item_id", "units")
    # There are no more ranked rows than menu items; only where those are many is the result
    # written, because the size check and the ranking both read it.
    rows = menu_items.count()
    if rows > options.get("task_rows", TASK_ROWS):
        units, rows = measured(units)
    order = [F.desc_nulls_first("units"), F.asc("item_id")]
    return sequence_in_group(units, "restaurant_id", order, "item_rank", rows=rows, **options)


def order_sequence(orders: DataFrame, k: int | None = 200, **options: int) -> DataFrame:
    """Every customer's delivered orders numbered, with the days since the one before.

    The first ``k`` rows by customer and number are the first ``k`` by customer
    and time, and need no other rows, so they are picked before numbering.
    """
    placed = delivered(orders).select("customer_id", "order_id", "order_timestamp")
    order = [F.asc("order_timestamp"), F.asc("order_id")]
    if k is not None:
        placed = placed.orderBy("customer_id", *order).limit(k)
        options["rows"] = k
    dated = placed.withColumn("order_date", F.col("order_timestamp").cast("date"))
    numbered = sequence_in_group(dated, "customer_id", order, "order_seq", ("order_date", "_before"), **options)
    return numbered.select(
        "customer_id",
        "order_id",
        "order_date",
        "order_seq",
        F.datediff("order_date", "_before").alias("days_since_prev"),
    ).orderBy("customer_id", "order_seq")


def aov_vs_city(orders: DataFrame, restaurants: DataFrame, min_orders: int = 50, k: int = 25) -> DataFrame:
    """Average order value of a restaurant against the plain mean of its city's restaurants.

    The benchmark is taken over all restaurants; ``min_orders`` filters afterwards.
    """
    keyed = per_key(delivered(orders), "restaurant_id", orders_and_revenue())
    value = (money("cents") / F.col("orders").cast("decimal(20,0)")).cast("decimal(28,10)")
    places = (
        keyed.join(restaurants.select("restaurant_id", "name", "city"), "restaurant_id")
        .filter(F.col("city").isNotNull())
        .withColumn("aov", value)
    )
    city = places.groupBy("city").agg(F.sum("aov").alias("s"), F.count("*").alias("n"))
    benchmark = city.select("city", (F.col("s") / F.col("n")).cast("decimal(28,10)").alias("city_aov"))
    gap = 100 * (F.col("aov") - F.col("city_aov")) / F.nullif("city_aov", F.lit(0).cast("decimal(28,10)"))
    return (
        places.join(benchmark, "city")
        .filter(F.col("orders") >= min_orders)
        .withColumn("pct_vs_city", F.round(gap, 1))
        .orderBy(F.desc_nulls_first("pct_vs_city"), "restaurant_id")
        .limit(k)
        .select(
            "name",
            "city",
            "orders",
            F.round("aov", 2).alias("restaurant_aov"),
            F.round("city_aov", 2).alias("city_avg_aov"),
            "pct_vs_city",
        )
    )


def last_order(orders: DataFrame) -> DataFrame:
    """Time of each customer's latest delivered order."""
    return per_key(delivered(orders), "customer_id", {"last_order": F.max("order_timestamp")})


def category_revenue(order_items: DataFrame, orders: DataFrame, menu_items: DataFrame) -> DataFrame:
    return sum_by_dimension(
        delivered_lines(order_items, orders),
        menu_items,
        "item_id",
        ["category"],
        {"cents": F.sum(F.col("quantity") * cents("unit_price"))},
    )


def taxonomy_rollup(categories: DataFrame, tree: DataFrame, level: int = 1, other: str = "Uncategorised") -> DataFrame:
    """Category revenue below its department; categories outside the tree share one department."""
    leaves = tree.filter(F.col("level") == level).select(F.col("node").alias("category"), "root")
    department = Window.partitionBy("root")  # one row per category
    return (
        categories.join(leaves, "category", "left")
        .select(
            F.coalesce("root", F.lit(other)).alias("department"),
            "category",
            money("cents").alias("category_revenue"),
            money(F.sum("cents").over(department)).alias("department_revenue"),
        )
        .orderBy(F.desc_nulls_last("department_revenue"), F.desc_nulls_last("category_revenue"), "category")
    )


def status_counts() -> dict[str, Column]:
    return {
        "total_orders": F.count("*"),
        "delivered": count_where(F.col("status") == "delivered"),
        "cancelled": count_where(F.col("status") == "cancelled"),
        "refunded": count_where(F.col("status") == "refunded"),
    }
