from __future__ import annotations

import datetime as dt
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from bazaarlens.operators import star
from bazaarlens.operators.metrics import ADDITIVE, Dimension, customer_metrics, metric
from bazaarlens.plans import customers, dashboards, rfm

from conftest import order, rows


@pytest.fixture(scope="module")
def tables(market):
    return star.star_schema(market)


def test_dim_date(tables):
    days = rows(tables["dim_date"])
    assert len(days) == 62  # 5 January to 6 March of a leap year
    assert days[1] == (dt.date(2024, 1, 6), 2024, 1, "Q1", 1, "Jan", "2024-01", 6, 6, "Sat", True)


def test_dimensions_fill_missing_labels(tables):
    found = {r[0]: r for r in rows(tables["dim_customers"])}
    assert found[2] == (2, "Bob", "Unknown", dt.date(2024, 1, 1), "2024-01", "unknown")
    assert {r[3] for r in rows(tables["dim_restaurants"])} == {"Pune", "Unknown"}
    assert rows(tables["dim_menu_items"].orderBy("item_id"))[0][-1] == "Tandoor"


def test_fact_orders_guard_and_flags(tables):
    facts = {r["order_id"]: r for r in tables["fact_orders"].collect()}
    assert (facts[1]["item_count"], facts[1]["total_quantity"]) == (2, 3)
    assert facts[2]["item_count"] is None
    assert [facts[i]["is_on_time"] for i in (1, 2, 3, 4, 5, 6, 7)] == [True, True, False, None, False, False, False]
    assert facts[7]["delivery_time_minutes"] is None  # zero minutes fail the guard
    assert facts[5]["rider_id"] is None and facts[3]["had_discount"]


def test_other_facts(tables):
    assert {r[0]: r[2:4] for r in rows(tables["fact_reviews"])} == {1: (1, 10), 2: (1, 11), 3: (2, 10)}
    lines = {r[0]: r for r in rows(tables["fact_order_items"])}
    assert lines[1][5:] == (D("4.00"), dt.date(2024, 1, 5), "delivered", True)
    assert lines[4][-1] is False


def test_overall_metrics(tables):
    (found,) = dashboards.metrics_overall(tables["fact_orders"]).collect()
    assert found["total_orders"] == 7 and found["delivered_orders"] == 5 and found["active_customers"] == 2
    assert found["total_revenue"] == D("185.25") and found["discount_given"] == D("5.00")
    assert found["items_sold"] == 4 and found["valid_deliveries"] == 3 and found["on_time_orders"] == 2
    assert float(found["on_time_rate"]) == pytest.approx(2 / 3)
    assert float(found["revenue_per_customer"]) == pytest.approx(185.25 / 2)


def test_metric_keeps_facts_without_a_member(tables):
    found = {r[0]: r[1:3] for r in rows(dashboards.metric_by_vehicle(tables["fact_orders"], tables["dim_riders"]))}
    assert found == {"bike": (5, 2), "car": (1, 1), None: (1, 0)}


def test_every_metric_equals_direct_aggregation(fixtures):
    facts = star.fact_orders(fixtures.orders, fixtures.order_items)
    dim = star.dim_restaurants(fixtures.restaurants)
    names = [*ADDITIVE, "active_customers"]
    found = metric(facts, names, by=["city", "payment_method"], dims={"city": Dimension(dim, "restaurant_id")})
    direct = (
        facts.join(dim.select("restaurant_id", "city"), "restaurant_id", "left")
        .groupBy("city", "payment_method")
        .agg(
            *[ADDITIVE[n]().alias(n) for n in ADDITIVE],
            F.count_distinct(F.when(F.col("is_delivered"), F.col("customer_id"))).alias("active_customers"),
        )
    )
    for name in ("total_revenue", "discount_given"):
        direct = direct.withColumn(name, (F.col(name) / 100).cast("decimal(24,2)"))
        found = found.withColumn(name, F.col(name).cast("decimal(24,2)"))
    assert sorted(rows(found), key=repr) == sorted(rows(direct), key=repr)
    without = metric(facts, [*ADDITIVE], by=["city", "payment_method"], dims={"city": Dimension(dim, "restaurant_id")})
    assert sorted(rows(without), key=repr) == sorted(rows(found.drop("active_customers")), key=repr)


def test_slicers(tables):
    by_city = dashboards.metric_by_city_filtered
    args = (tables["fact_orders"], tables["dim_restaurants"], tables["dim_date"])
    assert rows(by_city(*args)) == [("Pune", D("135.25")), ("Unknown", D("50.00"))]
    assert rows(by_city(*args, cities=["Pune"])) == [("Pune", D("135.25"))]
    assert rows(by_city(*args, years=[2024], cities=["Unknown"])) == [("Unknown", D("50.00"))]
    assert rows(by_city(*args, years=[1999])) == []


def test_to_date_sums(tables):
    found = {r[0]: r[1:] for r in rows(dashboards.metrics_mtd_ytd(tables["fact_orders"], tables["dim_date"]))}
    assert found[dt.date(2024, 1, 31)] == (None, D("150.00"), D("150.00"), D("150.00"))
    assert found[dt.date(2024, 2, 29)] == (None, None, D("150.00"), D("150.00"))
    assert found[dt.date(2024, 3, 3)] == (D("10.00"), D("35.25"), D("185.25"), D("185.25"))


def test_calendar_change_differs_from_row_change(tables):
    months = rows(dashboards.metrics_mom_yoy(tables["fact_orders"], tables["dim_date"]))
    assert [(m[1], m[2]) for m in months] == [
        (D("150.00"), None),
        (None, D("150.00")),
        (D("35.25"), None),
    ]
    assert months[1][3] == -1 and months[2][3] is None


def test_month_end_to_date_equals_month_revenue(fixtures):
    dates = star.dim_date(fixtures.orders)
    facts = star.order_facts(fixtures.orders)
    daily = dashboards.metrics_mtd_ytd(facts, dates).withColumn("month", F.trunc("date_key", "MM"))
    ends = daily.groupBy("month").agg(F.max_by("revenue_mtd", "date_key").alias("revenue"))
    months = dashboards.metrics_mom_yoy(facts, dates).select("month", "total_revenue")
    assert sorted(rows(ends)) == sorted(rows(months))


def test_new_plus_returning_is_active(fixtures):
    found = dashboards.metrics_new_returning(fixtures.orders)
    assert found.filter("new_customers + returning_customers <> active_customers").isEmpty()


def test_segments_count_customers_without_orders(tables):
    every = dashboards.metrics_segment(tables["fact_orders"], tables["dim_customers"])
    assert rows(every) == [("new", 1, None), ("unknown", 1, D("25.25")), ("vip", 1, D("160.00"))]
    some = dashboards.metrics_segment(tables["fact_orders"], tables["dim_customers"], ["vip"])
    assert rows(some) == [("vip", 1, D("160.00"))]


def test_two_facts_do_not_multiply(tables):
    found = rows(dashboards.rating_vs_revenue(tables["fact_orders"], tables["fact_reviews"], tables["dim_restaurants"]))
    assert [(r[0], r[3], r[4]) for r in found] == [(10, 2, D("135.25")), (11, 0, D("50.00")), (12, None, None)]


def test_labels_and_items(tables, make):
    facts = star.order_facts(make("orders", [order(1, 1, 1, "2024-01-01T10:00:00", "250000")]))
    assert rows(dashboards.metrics_label(facts))[0][2] == "2.50 L"
    sold = rows(dashboards.items_sold(tables["fact_order_items"], tables["dim_menu_items"]))
    assert sold == [(100, "naan", 3), (101, "dosa", 1)]


def test_two_dimensions_on_one_key(spark, tables):
    holidays = tables["dim_date"].select("date_key", (F.col("day_of_month") == 1).alias("is_holiday"))
    dims = {"year": Dimension(tables["dim_date"], "date_key"), "is_holiday": Dimension(holidays, "date_key")}
    found = metric(tables["fact_orders"], ["total_orders"], ["year", "is_holiday"], dims)
    assert found.agg(F.sum("total_orders")).first()[0] == tables["fact_orders"].count()
    assert found.where("is_holiday is null or year is null").isEmpty()


def test_shifts_and_sums_reach_beyond_the_selection(spark, fixtures):
    facts, dates = star.order_facts(fixtures.orders), star.dim_date(fixtures.orders)
    whole = {r["month"]: r for r in dashboards.metrics_mom_yoy(facts, dates).collect()}
    for r in dashboards.metrics_mom_yoy(facts, dates, F.year("month") == 1998).collect():
        assert r == whole[r["month"]]
    days = {r["date_key"]: r for r in dashboards.metrics_mtd_ytd(facts, dates).collect()}
    sliced = dashboards.metrics_mtd_ytd(facts, dates, F.col("date_key").between("1998-03-15", "1998-04-02")).collect()
    assert len(sliced) == 19
    assert all(r["revenue_ytd"] == days[r["date_key"]]["revenue_ytd"] and r["revenue_mtd"] == days[r["date_key"]]["revenue_mtd"] for r in sliced)
    assert sliced[-1]["running_revenue"] == sum(r["total_revenue"] or 0 for r in sliced)


def test_new_customers_by_year_add_up_to_all(spark, fixtures):
    facts, dates = star.order_facts(fixtures.orders), star.dim_date(fixtures.orders)
    by_year = customer_metrics(facts, ["year"], {"year": Dimension(dates, "date_key")})
    everyone = customer_metrics(facts).first()
    assert by_year.agg(F.sum("new_customers")).first()[0] == everyone["active_customers"] == everyone["new_customers"]
    month = customer_metrics(facts, ["year_month"], {"year_month": Dimension(dates, "date_key")})
    known = {f"{r['month']:%Y-%m}": (r["active_customers"], r["new_customers"]) for r in dashboards.metrics_new_returning(fixtures.orders).collect()}
    assert {r["year_month"]: (r["active_customers"], r["new_customers"]) for r in month.collect()} == known


def test_churn_and_rfm_read_orders_once(spark, fixtures):
    for df in (customers.churn_rate(fixtures.orders), rfm.rfm_rollup(fixtures.orders)):
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        assert plan.count("FileScan") <= 1


def test_new_customers_of_years_apart(spark):
    """First seen in the year between two chosen ones is returning, in either."""
    days = [(1, "1997-05-01"), (1, "1999-05-01"), (2, "1998-06-01"), (2, "1999-06-01"), (3, "1999-07-01"), (4, "1998-01-01")]
    fact = spark.createDataFrame(days, "customer_id bigint, day string").selectExpr(
        "customer_id", "cast(day AS date) AS date_key", "true AS is_delivered"
    )
    dates = spark.sql("SELECT explode(sequence(DATE '1997-01-01', DATE '1999-12-31')) AS date_key").withColumn("year", F.year("date_key"))
    dims = {"year": Dimension(dates, "date_key")}
    assert tuple(customer_metrics(fact, [], dims, {"year": [1997, 1999]}).first())[:3] == (3, 2, 1)
    by_year = customer_metrics(fact, ["year"], dims, {"year": [1997, 1999]})
    assert sorted(tuple(r)[:4] for r in by_year.collect()) == [(1997, 1, 1, 0), (1999, 3, 1, 2)]
