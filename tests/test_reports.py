"""Reports on hand-made rows, and identities that must hold on the test tables."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from bazaarlens.operators import hierarchy, series
from bazaarlens.plans import customers, headline, operations, revenue, rfm

from conftest import order, rows


def test_revenue_by_city(market):
    found = rows(revenue.revenue_by_city(market.orders, market.restaurants))
    # The order without an amount counts, but is left out of the average.
    assert found == [("Pune", 4, D("135.25"), D("45.08")), (None, 1, D("50.00"), D("50.00"))]


def test_cuisine_revenue_counts_an_order_per_rating(make, market):
    twice = market.reviews.union(make("reviews", [(4, 1, 2, "again", None)]))
    found = {r[0]: r[1:] for r in rows(revenue.cuisine_revenue(market.orders, market.restaurants, twice))}
    assert found["north"] == (5, D("235.25"), D("3.50"))
    assert found["south"] == (1, D("50.00"), None)


def test_payment_mix_leaves_out_unknown_methods(make):
    orders = make(
        "orders",
        [order(i, 1, 1, "2024-01-01T10:00:00", "3.00", method=m) for i, m in enumerate(["card", "card", "upi", None])],
    )
    assert rows(revenue.payment_mix(orders)) == [("card", 2, D("66.7"), D("3.00")), ("upi", 1, D("33.3"), D("3.00"))]


def test_customers_without_orders(market):
    assert [r[0] for r in rows(revenue.customers_without_orders(market.customers, market.orders))] == [3]


def test_popular_items_and_rank(market):
    found = rows(revenue.popular_items(market.order_items, market.orders, market.menu_items, market.restaurants))
    assert found == [("naan", "Breads", "Tandoor", 3, D("6.00")), ("dosa", "Mains", "Dosa", 1, D("5.00"))]
    ranked = rows(revenue.item_rank_all(market.order_items, market.orders, market.menu_items))
    assert sorted(ranked) == [(10, 100, 3, 1), (11, 101, 1, 1)]


def test_restaurant_ratings_use_any_status(market):
    found = rows(revenue.restaurant_ratings(market.orders, market.restaurants, market.reviews, min_reviews=2))
    assert found == [("Tandoor", "Pune", "north", 2, D("3.00"))]


def test_monthly_change_is_by_row_and_spine_has_no_gap(spark, market):
    jan, feb, mar = (dt.date(2024, m, 1) for m in (1, 2, 3))
    found = rows(revenue.monthly_revenue(market.orders))
    assert found == [
        (jan, D("150.00"), D("150.00"), None, None),
        (mar, D("35.25"), D("185.25"), D("-114.75"), D("-76.5")),
    ]
    spine = revenue.month_spine(market.orders, series.month_series(spark, "2024-01-01", "2024-04-01"))
    assert rows(spine) == [
        (jan, 2, D("150.00")),
        (feb, 0, D("0.00")),
        (mar, 5, D("35.25")),
        (dt.date(2024, 4, 1), 0, D("0.00")),
    ]


def test_mom_percent_survives_a_zero_month(make):
    orders = make("orders", [order(1, 1, 1, "2024-01-01T10:00:00", "0"), order(2, 1, 1, "2024-02-01T10:00:00", "5")])
    assert [r[4] for r in rows(revenue.monthly_revenue(orders))] == [None, None]


def test_yearly_growth_compares_the_same_months(make):
    orders = make(
        "orders",
        [
            order(1, 1, 1, "2023-01-10T10:00:00", "10"),
            order(2, 1, 1, "2023-06-10T10:00:00", "1000"),
            order(3, 1, 1, "2024-01-10T10:00:00", "15"),
        ],
    )
    assert rows(revenue.yearly_revenue_yoy(orders)) == [
        (2023, 2, D("1010.00"), None, None),
        (2024, 1, D("15.00"), D("10.00"), D("50.0")),
    ]


def test_same_named_restaurants_share_a_rank(make, market):
    twin = market.restaurants.union(make("restaurants", [(13, "Tandoor", "x", "Pune", None, None)]))
    orders = market.orders.union(make("orders", [order(9, 1, 13, "2024-01-05T10:00:00", "1.00")]))
    found = rows(revenue.top_restaurants_per_city(orders, twin))
    assert ("Pune", "Tandoor", D("136.25"), 2) in found  # a missing total ranks first in descending order
    assert ("Pune", "Thali", None, 1) in found


def test_reorder_gap_limit_equals_prefix(fixtures):
    every = rows(revenue.order_sequence(fixtures.orders, k=None))
    assert rows(revenue.order_sequence(fixtures.orders, k=50)) == every[:50]
    assert all((seq == 1) == (gap is None) for *_, seq, gap in every)


def test_aov_benchmark_ignores_the_threshold(make):
    places = make("restaurants", [(i, f"R{i}", "c", city, None, None) for i, city in ((1, "A"), (2, "A"), (3, None))])
    orders = make(
        "orders",
        [order(i, 1, r, "2024-01-01T10:00:00", a) for i, (r, a) in enumerate([(1, 10), (1, 20), (2, 30), (3, 9), (3, 9)])],
    )
    found = rows(revenue.aov_vs_city(orders, places, min_orders=2))
    assert found == [("R1", "A", 2, D("15.00"), D("22.50"), D("-33.3"))]


def test_taxonomy_walk_and_rollup(spark):
    edges = [("root", None), ("mid", "root"), ("leaf", "mid"), ("lone", None), ("a", "b"), ("b", "a")]
    tree = hierarchy.walk_tree(spark.createDataFrame(edges, "node string, parent string"))
    assert sorted(rows(tree.select("node", "level", "root"))) == [
        ("leaf", 2, "root"),
        ("lone", 0, "lone"),
        ("mid", 1, "root"),
        ("root", 0, "root"),
    ]
    sold = spark.createDataFrame([("leaf", 500), ("mid", 100), ("x", 70), ("y", 30)], "category string, cents bigint")
    assert rows(revenue.taxonomy_rollup(sold, tree, level=2)) == [
        ("root", "leaf", D("5.00"), D("5.00")),
        ("Uncategorised", "mid", D("1.00"), D("2.00")),
        ("Uncategorised", "x", D("0.70"), D("2.00")),
        ("Uncategorised", "y", D("0.30"), D("2.00")),
    ]


def test_cycle_below_a_root_raises(spark):
    edges = spark.createDataFrame([("r", None), ("a", "r"), ("a", "b"), ("b", "a")], "node string, parent string")
    with pytest.raises(ValueError, match="cycle"):
        hierarchy.walk_tree(edges)


def test_a_deep_chain_is_walked_to_its_end(spark):
    edges = [(0, None), *((k, k - 1) for k in range(1, 1501))]
    tree = hierarchy.walk_tree(spark.createDataFrame(edges, "node int, parent int"))
    assert rows(tree.select("node", "level", "root").orderBy("node")) == [(k, k, 0) for k in range(1501)]


def test_cohorts(market):
    jan, mar = dt.date(2024, 1, 1), dt.date(2024, 3, 1)
    assert rows(customers.cohort_sizes(market.orders)) == [(jan, 1), (mar, 1)]
    assert rows(customers.cohort_retention_matrix(market.orders)) == [
        (jan, 1, 0, 1, D("100.0")),
        (jan, 1, 2, 1, D("100.0")),
        (mar, 1, 0, 1, D("100.0")),
    ]
    assert rows(customers.retention_curve(market.orders)) == [(0, 2, D("100.0")), (2, 1, D("50.0"))]
    wide = customers.cohort_matrix_pivot(market.orders, [0, 1, 2])
    assert wide.columns == ["cohort_month", "cohort_size", "month_0", "month_1", "month_2"]
    assert rows(wide)[0][2:] == (D("100.0"), None, D("100.0"))
    assert customers.cohort_matrix_pivot(market.orders).columns == wide.columns
    with pytest.raises(ValueError, match="outside"):
        customers.cohort_matrix_pivot(market.orders, [0, 1])
    assert rows(customers.new_vs_returning(market.orders)) == [
        (jan, D("150.00"), None, None),
        (mar, D("25.25"), D("10.00"), D("28.4")),
    ]


def test_churn_is_strictly_later_than_the_limit(make, market):
    orders = make(
        "orders",
        [
            order(1, 1, 1, "2024-01-01T23:00:00", 1),
            order(2, 2, 1, "2024-01-02T01:00:00", 1),
            order(3, 3, 1, "2024-04-01T00:00:00", 1),
            order(4, 3, 1, "2025-04-01T00:00:00", 1, status="cancelled"),
        ],
    )
    found = {r[0]: r[4:] for r in rows(customers.churn_flag(orders, market.customers))}
    assert found == {1: (91, "churned"), 2: (90, "active"), 3: (0, "active")}
    assert rows(customers.churn_rate(orders)) == [(3, 1, D("33.3"))]


def test_retention_identities(fixtures):
    matrix = customers.cohort_retention_matrix(fixtures.orders)
    assert matrix.filter("month_offset = 0 AND retention_pct <> 100").isEmpty()
    assert matrix.filter("active_customers > cohort_size").isEmpty()
    sizes = customers.cohort_sizes(fixtures.orders).agg(F.sum("new_customers")).first()[0]
    assert sizes == rows(customers.churn_rate(fixtures.orders))[0][0]
    split = customers.new_vs_returning(fixtures.orders).agg(F.sum("new_revenue"), F.sum("returning_revenue")).first()
    assert sum(split) == revenue.monthly_revenue(fixtures.orders).agg(F.sum("revenue")).first()[0]


def test_rfm_identities(fixtures):
    scores = rfm.rfm_scores(fixtures.orders)
    assert rows(scores.orderBy("customer_id")) == rows(rfm.rfm_scores(fixtures.orders, task_rows=0).orderBy("customer_id"))
    counts = [n for _, n in rows(scores.groupBy("m_score").count())]
    assert max(counts) - min(counts) <= 1
    for report in (rfm.rfm_rollup, rfm.rfm_rollup_headline):
        shares = [float(r["pct_revenue"]) for r in report(fixtures.orders).collect()]
        assert abs(sum(shares) - 100) < 0.5
    assert "Cant Lose Them" not in {r[0] for r in rows(rfm.rfm_rollup_headline(fixtures.orders))}


@pytest.mark.parametrize(
    ("score", "label", "headline_label"),
    [
        ((5, 5, 5), "Champions", None),
        ((4, 5, 3), "Loyal", None),
        ((5, 2, 5), "New / Promising", None),
        ((3, 3, 1), "Potential Loyalist", None),
        ((3, 2, 5), "Needs Attention", None),
        ((2, 4, 1), "At Risk", None),
        ((1, 3, 4), "Cant Lose Them", "Needs Attention"),
        ((1, 3, 3), "Needs Attention", None),
        ((2, 2, 5), "Hibernating / Lost", None),
    ],
)
def test_segment_labels(spark, score, label, headline_label):
    df = spark.createDataFrame([score], "r int, f int, m int")
    found = rows(df.select(rfm.segment_label(), rfm.segment_label(with_lapsed_spenders=False)))[0]
    assert found == (label, headline_label or label)


def test_sla_total_is_told_from_a_missing_city(market):
    assert rows(operations.sla_by_city(market.orders, market.restaurants)) == [
        ("Pune", 2, 1, D("50.0")),
        (None, 1, 1, D("100.0")),
        (None, 3, 2, D("66.7")),
    ]


def test_percentiles_interpolate(make):
    places = make("restaurants", [(1, "R", "c", "A", None, None), (2, "S", "c", "A", None, None)])
    minutes = [10, 20, 30, 41, 181, 0, -5, None]
    orders = make("orders", [order(i, 1, 1 + i % 2, "2024-01-01T10:00:00", 1, minutes=m) for i, m in enumerate(minutes)])
    ((city, n, mean, median, p90),) = rows(operations.delivery_percentiles(orders, places))
    assert (city, n, mean, median) == ("A", 4, D("25.3"), 25.0)
    assert p90 == pytest.approx(37.7)


def test_rider_reports(market):
    found = rows(operations.rider_percentiles(market.orders, market.riders, min_deliveries=1))
    assert found == [("Ria", "Pune", 2, D("37.5"), 1, D("0.0"), 1), ("Raj", None, 1, D("46.0"), 2, D("100.0"), 2)]
    assert rows(operations.rider_leaderboard(market.orders, market.riders, min_deliveries=2)) == [
        ("Ria", "Pune", "bike", 2, D("37.5"), D("100.0"))
    ]
    assert rows(operations.vehicle_performance(market.orders, market.riders))[1] == ("car", 1, D("46.0"), D("0.0"))


def test_outcomes_and_hours(market):
    found = {r[0]: r[1:] for r in rows(operations.cancel_refund_by_city(market.orders, market.restaurants))}
    assert found["Pune"] == (5, 4, 0, 1, D("0.0"), D("20.0")) and found[None] == (2, 1, 1, 0, D("50.0"), D("0.0"))
    hours = rows(operations.peak_hours(market.orders))
    assert hours[0] == (9, 4, D("57.1")) and hours[-1] == (23, 1, D("14.3"))


def test_headline_figures(market):
    assert rows(headline.kpi_topline(market.customers, market.restaurants, market.orders)) == [
        (3, 3, 7, 5, D("185"), D("46.31"))
    ]
    assert rows(headline.kpi_cancel_refund(market.orders)) == [(D("14.3"), D("14.3"))]
    assert rows(headline.kpi_on_time(market.orders)) == [(3, D("66.7"), D("40.3"))]
    assert rows(headline.top_by_revenue(market.orders, market.restaurants, "city", 1)) == [("Pune", 4, D("135"))]


def test_reports_on_empty_orders(market):
    none = market.orders.limit(0)
    assert rows(revenue.revenue_by_city(none, market.restaurants)) == []
    assert rows(customers.churn_rate(none)) == [(0, 0, None)]
    assert rows(headline.kpi_cancel_refund(none)) == [(None, None)]
    assert rows(rfm.rfm_rollup(none)) == []
    assert len(rows(revenue.customers_without_orders(market.customers, none))) == 3
