
from __future__ import annotations

import os
import sys
from collections.abc import Callable
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from bazaarlens import schemas  # noqa: E402
from bazaarlens.functions.numeric import plain_types  # noqa: E402
from bazaarlens.operators import cleaning, hierarchy, quality, rejects, series, star  # noqa: E402
from bazaarlens.operators.metrics import Dimension  # noqa: E402
from bazaarlens.plans import customers, dashboards, headline, operations, revenue, rfm  # noqa: E402
from bazaarlens.session import scratch_path  # noqa: E402
from bazaarlens.sources import sinks, staging  # noqa: E402
from bazaarlens.sources.marketplace import read_marketplace  # noqa: E402
from bazaarlens.sources.snapshots import Snapshot  # noqa: E402
from bazaarlens.sources.fixtures import CATEGORY_TREE, Fixtures, open_fixtures  # noqa: E402
from oracle.queries import ORACLE  # noqa: E402

try:  # the text operators are an optional part
    from bazaarlens.llm.oracle import ORACLE as TEXT_ORACLE
    from bazaarlens.llm.queries import QUERIES as TEXT_QUERIES
    from corpus_pipeline import run as run_pipeline

    TEXT_QUERIES = TEXT_QUERIES | {"pipeline": run_pipeline}
except ModuleNotFoundError as error:
    if error.name not in ("bazaarlens.llm", "bazaarlens.llm.oracle", "corpus_pipeline"):
        raise  # something that it needs is missing
    TEXT_ORACLE, TEXT_QUERIES = {}, {}

# Thresholds and ranges that fit the test tables.
MIN_DELIVERIES = 60
MIN_ORDERS = 75
MIN_REVIEWS = 35
SPINE = ("1994-10-01", "2001-12-01")
OFFSETS = list(range(80))  # so that the columns are the same for every table; others raise
YEARS = [1997, 1998]
YEARS_APART = [1997, 1999]
DAYS = ("1998-03-15", "1998-05-10")
CITIES = ["NATION_9", "NATION_11", "NATION_6"]
RESTAURANT = 42
CUSTOMER = 77
BUCKETS = 8
# Rows a single task may order in the queries that exercise the sliced ranking.
SLICE_ROWS = 4


def _put(f: Fixtures, folder: str) -> Callable[[str, DataFrame], DataFrame]:
    """Writes a table to a fresh folder and returns it as written."""
    path = scratch_path(f.spark, folder)

    def put(name: str, df: DataFrame) -> DataFrame:
        df.write.parquet(f"{path}/{name}")
        return f.spark.read.parquet(f"{path}/{name}")

    return put


def _taxonomy(f: Fixtures) -> DataFrame:
    edges = f.spark.createDataFrame(CATEGORY_TREE, "node string, parent string")
    found = revenue.category_revenue(f.order_items, f.orders, f.menu_items)
    return revenue.taxonomy_rollup(found, hierarchy.walk_tree(edges))


def _staged(f: Fixtures) -> DataFrame:
    path = scratch_path(f.spark, "customers.csv")
    staging.write_text(f.raw_customers, path)
    return staging.read_text(f.spark, path, schemas.as_text("customers"))


def _clean_orders(f: Fixtures) -> DataFrame:
    kept = cleaning.clean_customers(f.raw_customers)
    return cleaning.clean_orders(f.raw_orders, kept, cleaning.clean_restaurants(f.raw_restaurants))


def _parsed_dates(f: Fixtures) -> DataFrame:
    dated = cleaning.clean_reviews(f.raw_reviews, f.orders).select("review_id", "review_date")
    text = f.raw_reviews.selectExpr("cast(review_id as bigint) review_id", "review_date as date_text")
    return text.join(dated, "review_id")


def _staged_all(f: Fixtures) -> DataFrame:
    """Every raw table through CSV and back, a record per row."""
    frames = []
    for name, raw in f.raw.items():
        path = scratch_path(f.spark, f"{name}.csv")
        staging.write_text(raw, path)
        text = staging.read_text(f.spark, path, raw.schema)
        record = F.concat_ws("|", *[F.coalesce(c, F.lit("")) for c in text.columns])
        frames.append(text.select(F.lit(name).alias("table_name"), record.alias("record")))
    return reduce(DataFrame.union, frames)


def _summary(f: Fixtures) -> DataFrame:
    clean = cleaning.clean_all(f.raw, _put(f, "clean"))
    return quality.dq_summary(f.raw_customers, clean.customers, clean.restaurants, clean.orders, clean.reviews)


def _lookup_layout(f: Fixtures) -> DataFrame:
    path = scratch_path(f.spark, "lookup")
    sinks.write_lookup_layout(f.orders, path)
    return sinks.lookup(f.spark.read.parquet(path), "restaurant_id", RESTAURANT)


def _lookup_by_customer(f: Fixtures) -> DataFrame:
    """On files clustered by restaurant, whose row groups the customer's Bloom filter tells apart."""
    path = scratch_path(f.spark, "lookup")
    sinks.write_lookup_layout(f.orders, path, also={"customer_id": 20_000}, group_bytes=1 << 20)
    return sinks.lookup(f.spark.read.parquet(path), "customer_id", CUSTOMER)


def _bucketed_lines(f: Fixtures) -> DataFrame:
    """Line facts from tables bucketed by order: the join moves no rows."""
    tables = {}
    for name, df in (("orders", f.orders), ("items", f.order_items)):
        path = scratch_path(f.spark, f"bucketed_{name}")
        tables[name] = path.rsplit("/", 1)[1].replace("-", "_")
        sinks.save_bucketed(df, tables[name], "order_id", BUCKETS, path)
    return star.fact_order_items(*[f.spark.table(tables[name]).hint("merge") for name in ("items", "orders")])


def _balance(f: Fixtures) -> DataFrame:
    return rejects.balance(f.raw, rejects.sort_out(f.raw, _put(f, "tagged")))


def _refreshed(f: Fixtures) -> DataFrame:
    """Row counts after two refreshes, the second with delivered orders only, and one that never got to its commit."""
    path, market = scratch_path(f.spark, "market"), f.market
    sinks.refresh(market, path)
    read = read_marketplace(f.spark, path)
    sinks.refresh(replace(read, orders=read.orders.filter("status = 'delivered'")), path)
    broken = Snapshot(f.spark, path)
    broken.put("orders", read.orders.filter("status <> 'delivered'"))
    return quality.row_counts(dict(read_marketplace(f.spark, path).items()))


def _audited(f: Fixtures) -> DataFrame:
    tables = dict(f.market.items())
    tables["orders"] = cleaning.typed_orders(f.raw_orders)
    return quality.constraint_audit(tables)


def _facts(f: Fixtures) -> DataFrame:
    return star.order_facts(f.orders)


def _fact_orders(f: Fixtures) -> DataFrame:
    return star.fact_orders(f.orders, f.order_items)


def _fact_reviews(f: Fixtures) -> DataFrame:
    return star.fact_reviews(f.reviews, f.orders)


def _dim_restaurants(f: Fixtures) -> DataFrame:
    return star.dim_restaurants(f.restaurants)


QUERIES: dict[str, Callable[[Fixtures], DataFrame]] = {
    # joins, aggregates, filters
    "revenue_by_city": lambda f: revenue.revenue_by_city(f.orders, f.restaurants),
    "top_restaurants": lambda f: revenue.top_restaurants(f.orders, f.restaurants),
    "cuisine_revenue": lambda f: revenue.cuisine_revenue(f.orders, f.restaurants, f.reviews),
    "payment_mix": lambda f: revenue.payment_mix(f.orders),
    "customers_without_orders": lambda f: revenue.customers_without_orders(f.customers, f.orders),
    "popular_items": lambda f: revenue.popular_items(f.order_items, f.orders, f.menu_items, f.restaurants),
    "restaurant_ratings": lambda f: revenue.restaurant_ratings(f.orders, f.restaurants, f.reviews, MIN_REVIEWS),
    # windows and ranking
    "monthly_revenue": lambda f: revenue.monthly_revenue(f.orders),
    "top_restaurants_per_city": lambda f: revenue.top_restaurants_per_city(f.orders, f.restaurants),
    "rider_percentiles": lambda f: operations.rider_percentiles(f.orders, f.riders, MIN_DELIVERIES),
    "rider_percentiles_sliced": lambda f: operations.rider_percentiles(
        f.orders, f.riders, MIN_DELIVERIES, task_rows=SLICE_ROWS
    ),
    "top_items_per_restaurant": lambda f: revenue.top_items_per_restaurant(
        f.order_items, f.orders, f.menu_items, f.restaurants
    ),
    "item_rank_all": lambda f: revenue.item_rank_all(f.order_items, f.orders, f.menu_items),
    "reorder_gap": lambda f: revenue.order_sequence(f.orders),
    "reorder_gap_all": lambda f: revenue.order_sequence(f.orders, k=None),
    "reorder_gap_all_sliced": lambda f: revenue.order_sequence(f.orders, k=None, task_rows=SLICE_ROWS),
    # staged reports
    "aov_vs_city": lambda f: revenue.aov_vs_city(f.orders, f.restaurants, MIN_ORDERS),
    "new_vs_returning": lambda f: customers.new_vs_returning(f.orders),
    "taxonomy_rollup": _taxonomy,
    "month_spine": lambda f: revenue.month_spine(f.orders, series.month_series(f.spark, *SPINE)),
    # cohorts and churn
    "cohort_sizes": lambda f: customers.cohort_sizes(f.orders),
    "cohort_retention_matrix": lambda f: customers.cohort_retention_matrix(f.orders),
    "cohort_matrix_pivot": lambda f: customers.cohort_matrix_pivot(f.orders, OFFSETS),
    "retention_curve": lambda f: customers.retention_curve(f.orders),
    "churn_flag": lambda f: customers.churn_flag(f.orders, f.customers),
    "churn_rate": lambda f: customers.churn_rate(f.orders),
    "last_order": lambda f: revenue.last_order(f.orders),
    # recency, frequency, monetary
    "rfm_scores": lambda f: rfm.rfm_scores(f.orders),
    "rfm_scores_sliced": lambda f: rfm.rfm_scores(f.orders, task_rows=SLICE_ROWS),
    "rfm_segments": lambda f: rfm.rfm_segments(f.orders),
    "rfm_rollup": lambda f: rfm.rfm_rollup(f.orders),
    "rfm_rollup_headline": lambda f: rfm.rfm_rollup_headline(f.orders),
    # operations
    "sla_by_city": lambda f: operations.sla_by_city(f.orders, f.restaurants),
    "delivery_percentiles": lambda f: operations.delivery_percentiles(f.orders, f.restaurants),
    "delivery_percentiles_sketched": lambda f: operations.sketched_percentiles(f.orders, f.restaurants),
    "rider_leaderboard": lambda f: operations.rider_leaderboard(f.orders, f.riders, MIN_DELIVERIES),
    "cancel_refund_by_city": lambda f: operations.cancel_refund_by_city(f.orders, f.restaurants),
    "vehicle_performance": lambda f: operations.vehicle_performance(f.orders, f.riders),
    "peak_hours": lambda f: operations.peak_hours(f.orders),
    "selective_lookup_layout": _lookup_layout,
    "selective_lookup_customer": _lookup_by_customer,
    "selective_lookup": lambda f: sinks.lookup(f.orders, "restaurant_id", RESTAURANT),
    # headline figures
    "kpi_topline": lambda f: headline.kpi_topline(f.customers, f.restaurants, f.orders),
    "kpi_cancel_refund": lambda f: headline.kpi_cancel_refund(f.orders),
    "kpi_on_time": lambda f: headline.kpi_on_time(f.orders),
    "kpi_top_cities": lambda f: headline.top_by_revenue(f.orders, f.restaurants, "city"),
    "kpi_top_cuisines": lambda f: headline.top_by_revenue(f.orders, f.restaurants, "cuisine_type"),
    "kpi_returning_share": lambda f: customers.returning_share(f.orders),
    "best_months": lambda f: revenue.best_months(f.orders),
    "yearly_revenue_yoy": lambda f: revenue.yearly_revenue_yoy(f.orders),
    # staging, cleaning, quality
    "stage_text": _staged,
    "stage_text_all": _staged_all,
    "parse_dates": _parsed_dates,
    "dedup_customers": lambda f: cleaning.dedup_customers(f.raw_customers),
    "clean_customers": lambda f: cleaning.clean_customers(f.raw_customers),
    "clean_restaurants": lambda f: cleaning.clean_restaurants(f.raw_restaurants),
    "clean_menu_items": lambda f: cleaning.clean_menu_items(f.raw_menu_items),
    "clean_riders": lambda f: cleaning.clean_riders(f.raw_riders),
    "clean_orders": _clean_orders,
    "clean_order_items": lambda f: cleaning.clean_order_items(f.raw_order_items, _clean_orders(f)),
    "clean_reviews": lambda f: cleaning.clean_reviews(f.raw_reviews, _clean_orders(f)),
    "constraint_audit": _audited,
    "refreshed_row_counts": _refreshed,
    "row_counts": lambda f: quality.row_counts(dict(cleaning.clean_all(f.raw, _put(f, "clean")).items())),
    "dq_summary": _summary,
    "reject_balance": _balance,
    "unparsed_dates": lambda f: quality.unparsed_dates(f.raw),
    # star schema
    "dim_date": lambda f: star.dim_date(f.orders),
    "dim_customers": lambda f: star.dim_customers(f.customers),
    "dim_restaurants": _dim_restaurants,
    "dim_riders": lambda f: star.dim_riders(f.riders),
    "dim_menu_items": lambda f: star.dim_menu_items(f.menu_items, f.restaurants),
    "fact_orders": _fact_orders,
    "fact_reviews": _fact_reviews,
    "fact_order_items": lambda f: star.fact_order_items(f.order_items, f.orders),
    "fact_order_items_bucketed": _bucketed_lines,
    # metric layer and dashboards
    "metrics_overall": lambda f: dashboards.metrics_overall(_fact_orders(f)),
    "metrics_by_month": lambda f: dashboards.metrics_by_month(_fact_orders(f), star.dim_date(f.orders)),
    "metrics_mtd_ytd": lambda f: dashboards.metrics_mtd_ytd(_facts(f), star.dim_date(f.orders)),
    "metrics_mom_yoy": lambda f: dashboards.metrics_mom_yoy(_facts(f), star.dim_date(f.orders)),
    "metrics_mtd_ytd_sliced": lambda f: dashboards.metrics_mtd_ytd(
        _facts(f), star.dim_date(f.orders), F.col("date_key").between(*DAYS)
    ),
    "metrics_mom_yoy_sliced": lambda f: dashboards.metrics_mom_yoy(
        _facts(f),
        star.dim_date(f.orders),
        F.year("month") == YEARS[-1],
        {"city": Dimension(_dim_restaurants(f), "restaurant_id")},
        {"city": CITIES[:2]},
    ),
    "metrics_new_returning_by_city": lambda f: dashboards.metrics_new_returning_by(
        _facts(f), star.dim_date(f.orders), _dim_restaurants(f), YEARS
    ),
    "metrics_new_returning_by_city_apart": lambda f: dashboards.metrics_new_returning_by(
        _facts(f), star.dim_date(f.orders), _dim_restaurants(f), YEARS_APART
    ),
    "metrics_reviews_by_cuisine": lambda f: dashboards.metrics_reviews_by_cuisine(_fact_reviews(f), _dim_restaurants(f)),
    "kpi_avg_rating": lambda f: dashboards.kpi_avg_rating(_fact_reviews(f)),
    "metrics_new_returning": lambda f: dashboards.metrics_new_returning(f.orders),
    "metrics_segment": lambda f: dashboards.metrics_segment(_facts(f), star.dim_customers(f.customers)),
    "metrics_reviews": lambda f: dashboards.metrics_reviews(_fact_reviews(f)),
    "metrics_label": lambda f: dashboards.metrics_label(_facts(f)),
    "metric_by_city_filtered": lambda f: dashboards.metric_by_city_filtered(
        _facts(f), _dim_restaurants(f), star.dim_date(f.orders), YEARS, CITIES
    ),
    "metric_by_vehicle": lambda f: dashboards.metric_by_vehicle(_facts(f), star.dim_riders(f.riders)),
    "metric_by_rider": lambda f: dashboards.metric_by_rider(_facts(f), star.dim_riders(f.riders)),
    "rating_vs_revenue": lambda f: dashboards.rating_vs_revenue(_facts(f), _fact_reviews(f), _dim_restaurants(f)),
    "items_sold": lambda f: dashboards.items_sold(
        star.fact_order_items(f.order_items, f.orders), star.dim_menu_items(f.menu_items, f.restaurants)
    ),
}


def _bind(query: Callable[[Fixtures], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, folder: plain_types(query(open_fixtures(spark, folder)))


def entry(spark: SparkSession) -> DataFrame:
    """Retention of every acquisition cohort on the smallest test tables."""
    return queries()["cohort_retention_matrix"](spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Every query of the library as ``(spark, folder) -> DataFrame``."""
    return {name: _bind(query) for name, query in QUERIES.items()} | TEXT_QUERIES


def oracle_sql() -> dict[str, str]:
    """The same queries as SQL over the test tables."""
    return ORACLE | TEXT_ORACLE
