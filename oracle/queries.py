"""One SQL text per registered query."""

from __future__ import annotations

from oracle.fixture import big, money, pct, ratio, with_tables

_ORDERS_BY = "count(*) AS n, sum(cents) AS cents"

# Segments, fixed values: the first rule that fits decides.
_RFM_LABEL = """CASE
    WHEN r >= 4 AND f >= 4 AND m >= 4 THEN 'Champions'
    WHEN r >= 4 AND f >= 3 THEN 'Loyal'
    WHEN r >= 4 AND f <= 2 THEN 'New / Promising'
    WHEN r = 3 AND f >= 3 THEN 'Potential Loyalist'
    WHEN r <= 2 AND f >= 4 THEN 'At Risk'
    WHEN r <= 2 AND f >= 3 AND m >= 4 THEN '{lapsed}'
    WHEN r <= 2 AND f <= 2 THEN 'Hibernating / Lost'
    ELSE 'Needs Attention' END"""
_LABEL8 = _RFM_LABEL.format(lapsed="Cant Lose Them")
_LABEL7 = _RFM_LABEL.format(lapsed="Needs Attention")

_SEQUENCE = f"""SELECT customer_id, order_id, day AS order_date,
       {big("row_number() OVER seq")} AS order_seq,
       {big("date_diff('day', lag(day) OVER seq, day)")} AS days_since_prev
FROM m_done WINDOW seq AS (PARTITION BY customer_id ORDER BY order_timestamp, order_id)"""

_RIDERS = f"""SELECT name, city, deliveries, avg_minutes,
       {big("ntile(4) OVER (ORDER BY avg_minutes, rider_id)")} AS speed_quartile,
       round(100 * percent_rank() OVER (ORDER BY avg_minutes), 1) AS pct_rank,
       {big("rank() OVER (ORDER BY avg_minutes)")} AS fastest_rank
FROM (SELECT t.rider_id, r.name, r.city, count(*) AS deliveries,
             {ratio("sum(minutes)", "count(*)", 1)} AS avg_minutes
      FROM m_timed t JOIN m_riders r ON r.rider_id = t.rider_id
      GROUP BY ALL HAVING count(*) >= 60)"""

_SCORES = f"""SELECT customer_id, recency AS recency_days, orders AS frequency, {money("cents")} AS monetary,
       {big("r")} AS r_score, {big("f")} AS f_score, {big("m")} AS m_score,
       concat(r, f, m) AS rfm_cell, {big("r + f + m")} AS rfm_total
FROM m_rfm"""

_ON_TIME = "count(*) FILTER (WHERE minutes <= 45)"

_MEASURES = f"""count(*) AS total_orders,
    count(*) FILTER (WHERE is_delivered) AS delivered_orders,
    {money("sum(cents) FILTER (WHERE is_delivered)")} AS total_revenue,
    {ratio("sum(cents) FILTER (WHERE is_delivered)", "100 * count(*) FILTER (WHERE is_delivered)", 6)} AS average_order_value,
    {money("sum(discount_cents) FILTER (WHERE is_delivered)")} AS discount_given,
    {big("sum(total_quantity) FILTER (WHERE is_delivered)")} AS items_sold,
    count(*) FILTER (WHERE is_delivered AND valid_minutes IS NOT NULL) AS valid_deliveries,
    {ratio("sum(valid_minutes) FILTER (WHERE is_delivered)", "count(valid_minutes) FILTER (WHERE is_delivered)", 6)} AS avg_delivery_time,
    count(*) FILTER (WHERE is_on_time) AS on_time_orders,
    {ratio("count(*) FILTER (WHERE is_on_time)", "count(valid_minutes) FILTER (WHERE is_delivered)", 6)} AS on_time_rate,
    count(*) FILTER (WHERE is_cancelled) AS cancelled_orders,
    {ratio("count(*) FILTER (WHERE is_cancelled)", "count(*)", 6)} AS cancellation_rate,
    count(DISTINCT customer_id) FILTER (WHERE is_delivered) AS active_customers,
    {ratio("sum(cents) FILTER (WHERE is_delivered)", "100 * count(DISTINCT customer_id) FILTER (WHERE is_delivered)", 6)} AS revenue_per_customer"""

_SPEED = f"""count(*) AS total_orders,
    count(*) FILTER (WHERE is_delivered AND valid_minutes IS NOT NULL) AS valid_deliveries,
    {ratio("sum(valid_minutes) FILTER (WHERE is_delivered)", "count(valid_minutes) FILTER (WHERE is_delivered)", 6)} AS avg_delivery_time,
    {ratio("count(*) FILTER (WHERE is_on_time)", "count(valid_minutes) FILTER (WHERE is_delivered)", 6)} AS on_time_rate"""

_TEXT_MONEY = "printf('%d.%02d', {0} // 100, {0} % 100)"

_CITY = "upper(left(trim({0}), 1)) || lower(substr(trim({0}), 2))"

_CLEAN_DATE = """CAST(coalesce(try_strptime(signup_text, '%Y-%m-%d'), try_strptime(signup_text, '%m/%d/%Y'),
    try_strptime(signup_text, '%m-%d-%Y'), try_strptime(signup_text, '%d-%b-%Y'),
    try_strptime(signup_text, '%d/%m/%Y')) AS DATE)"""

_TREE = """m_edges(node, parent) AS (VALUES ('Tiered', NULL), ('Sized', NULL), ('STANDARD', 'Tiered'),
    ('ECONOMY', 'Tiered'), ('PROMO', 'Tiered'), ('SMALL', 'Sized'), ('MEDIUM', 'Sized')),
m_walk AS (
    SELECT node, 0 AS level, node AS root FROM m_edges WHERE parent IS NULL
    UNION ALL
    SELECT e.node, w.level + 1, w.root FROM m_walk w JOIN m_edges e ON e.parent = w.node)"""


def _unique(table: str, key: str, source: str) -> tuple[str, str, str]:
    return table, f"{key} unique", f"SELECT count({key}) - count(DISTINCT {key}) FROM {source}"


def _where(table: str, rule: str, source: str, condition: str) -> tuple[str, str, str]:
    return table, rule, f"SELECT count(*) FROM {source} WHERE {condition}"


def _orphans(table: str, column: str, source: str, parent: str, parent_source: str, key: str) -> tuple[str, str, str]:
    found = f"SELECT count(*) FROM {source} WHERE {column} NOT IN (SELECT {key} FROM {parent_source})"
    return table, f"{column} in {parent}", found


_AUDIT = [
    _unique("customers", "customer_id", "m_customers"),
    _unique("restaurants", "restaurant_id", "m_restaurants"),
    _unique("menu_items", "item_id", "m_menu_items"),
    _unique("riders", "rider_id", "m_riders"),
    _unique("orders", "order_id", "m_raw_orders"),
    _unique("reviews", "review_id", "m_reviews"),
    *[
        _where(table, f"{column} not null", source, f"{column} IS NULL")
        for table, source, columns in (
            ("customers", "m_customers", ("customer_id", "name")),
            ("restaurants", "m_restaurants", ("restaurant_id", "name")),
            ("menu_items", "m_menu_items", ("item_id", "restaurant_id", "name")),
            ("riders", "m_riders", ("rider_id", "name")),
            ("orders", "m_raw_orders", ("order_id", "customer_id", "restaurant_id", "order_timestamp", "status")),
            ("order_items", "m_items", ("order_id", "item_id", "quantity")),
            ("reviews", "m_reviews", ("review_id", "order_id")),
        )
        for column in columns
    ],
    _where("customers", "segment in domain", "m_customers", "segment NOT IN ('new', 'regular', 'premium', 'vip')"),
    _where("riders", "vehicle_type in domain", "m_riders", "vehicle_type NOT IN ('bike', 'scooter', 'car', 'bicycle')"),
    _where("orders", "status in domain", "m_raw_orders",
           "status NOT IN ('delivered', 'cancelled', 'refunded', 'in_progress')"),
    _where("orders", "payment_method in domain", "m_raw_orders",
           "payment_method NOT IN ('card', 'upi', 'wallet', 'cash', 'netbanking')"),
    _where("restaurants", "avg_rating in range", "m_restaurants", "avg_rating NOT BETWEEN 0 AND 5"),
    _where("menu_items", "price in range", "m_menu_items", "price_cents < 0"),
    _where("orders", "total_amount in range", "m_raw_orders", "cents < 0"),
    _where("orders", "discount_applied in range", "m_raw_orders", "discount_cents < 0"),
    _where("order_items", "quantity in range", "m_items", "quantity < 1"),
    _where("order_items", "unit_price in range", "m_items", "price_cents < 0"),
    _where("reviews", "rating in range", "m_reviews", "rating NOT BETWEEN 1 AND 5"),
    _orphans("menu_items", "restaurant_id", "m_menu_items", "restaurants", "m_restaurants", "restaurant_id"),
    _orphans("orders", "customer_id", "m_raw_orders", "customers", "m_customers", "customer_id"),
    _orphans("orders", "restaurant_id", "m_raw_orders", "restaurants", "m_restaurants", "restaurant_id"),
    _orphans("orders", "rider_id", "m_raw_orders", "riders", "m_riders", "rider_id"),
    _orphans("order_items", "order_id", "m_items", "orders", "m_raw_orders", "order_id"),
    _orphans("order_items", "item_id", "m_items", "menu_items", "m_menu_items", "item_id"),
    _orphans("reviews", "order_id", "m_reviews", "orders", "m_raw_orders", "order_id"),
]

_BODIES: dict[str, str] = {
    "revenue_by_city": f"""
        SELECT city, count(*) AS delivered_orders, {money("sum(cents)")} AS revenue,
               {ratio("sum(cents)", "100 * count(*)", 2)} AS avg_order_value
        FROM m_done JOIN m_restaurants USING (restaurant_id) GROUP BY city ORDER BY revenue DESC""",
    "top_restaurants": f"""
        SELECT restaurant_id, name, cuisine_type, city, avg_rating, n AS orders, {money("cents")} AS revenue
        FROM (SELECT restaurant_id, {_ORDERS_BY} FROM m_done GROUP BY restaurant_id)
        JOIN m_restaurants USING (restaurant_id) ORDER BY cents DESC, restaurant_id LIMIT 15""",
    "cuisine_revenue": f"""
        SELECT cuisine_type, count(*) AS orders, {money("sum(cents)")} AS revenue,
               {ratio("sum(rating)", "count(rating)", 2)} AS avg_review_rating
        FROM m_done JOIN m_restaurants USING (restaurant_id)
        LEFT JOIN (SELECT order_id, rating FROM m_reviews WHERE rating IS NOT NULL) USING (order_id)
        GROUP BY cuisine_type""",
    "payment_mix": f"""
        SELECT payment_method, n AS orders, {pct("n", "sum(n) OVER ()")} AS pct_of_orders,
               {ratio("cents", "100 * n", 2)} AS avg_order_value
        FROM (SELECT payment_method, {_ORDERS_BY} FROM m_done WHERE payment_method IS NOT NULL GROUP BY 1)""",
    "customers_without_orders": """
        SELECT customer_id, name, city, signup_date, segment FROM m_customers c
        WHERE NOT EXISTS (SELECT 1 FROM m_done d WHERE d.customer_id = c.customer_id)
        ORDER BY signup_date NULLS LAST, customer_id""",
    "popular_items": f"""
        SELECT i.name AS item, category, r.name AS restaurant, {big("units")} AS units_sold,
               {money("cents")} AS item_revenue
        FROM m_units JOIN m_menu_items i USING (item_id) JOIN m_restaurants r USING (restaurant_id)
        ORDER BY units DESC, item_id LIMIT 20""",
    "restaurant_ratings": f"""
        SELECT name, city, cuisine_type, reviews, avg_customer_rating FROM (
            SELECT restaurant_id, count(rating) AS reviews, {ratio("sum(rating)", "count(rating)", 2)} AS avg_customer_rating
            FROM m_orders JOIN m_reviews USING (order_id) GROUP BY restaurant_id HAVING count(rating) >= 35)
        JOIN m_restaurants USING (restaurant_id)
        ORDER BY avg_customer_rating DESC, restaurant_id LIMIT 20""",
    "monthly_revenue": f"""
        SELECT month, {money("cents")} AS revenue, {money("sum(cents) OVER (ORDER BY month)")} AS running_total,
               {money("cents - before")} AS mom_change, {pct("cents - before", "before")} AS mom_pct
        FROM (SELECT *, lag(cents) OVER (ORDER BY month) AS before FROM m_months) ORDER BY month""",
    "top_restaurants_per_city": f"""
        SELECT city, name, {money("cents")} AS revenue, {big("place")} AS city_rank FROM (
            SELECT city, name, sum(cents) AS cents,
                   dense_rank() OVER (PARTITION BY city ORDER BY sum(cents) DESC) AS place
            FROM m_done JOIN m_restaurants USING (restaurant_id) GROUP BY city, name)
        WHERE place <= 3""",
    "rider_percentiles": _RIDERS,
    "rider_percentiles_sliced": _RIDERS,
    "top_items_per_restaurant": f"""
        SELECT r.name AS restaurant, item, {big("units")} AS units, {big("place")} AS item_rank FROM (
            SELECT restaurant_id, name AS item, units,
                   row_number() OVER (PARTITION BY restaurant_id ORDER BY units DESC, item_id) AS place
            FROM m_units JOIN m_menu_items USING (item_id))
        JOIN m_restaurants r USING (restaurant_id) WHERE place <= 3""",
    "item_rank_all": f"""
        SELECT restaurant_id, item_id, {big("units")} AS units,
               {big("row_number() OVER (PARTITION BY restaurant_id ORDER BY units DESC, item_id)")} AS item_rank
        FROM m_units JOIN m_menu_items USING (item_id)""",
    "reorder_gap": _SEQUENCE + " ORDER BY customer_id, order_seq LIMIT 200",
    "reorder_gap_all": _SEQUENCE,
    "reorder_gap_all_sliced": _SEQUENCE,
    "aov_vs_city": f"""
        SELECT name, city, n AS orders, {ratio("cents", "100 * n", 2)} AS restaurant_aov,
               {ratio("city_aov", "10000000000", 2)} AS city_avg_aov, {pct("aov - city_aov", "city_aov")} AS pct_vs_city
        FROM (SELECT *, CAST((2 * sum(aov) OVER c + count(*) OVER c) // (2 * count(*) OVER c) AS HUGEINT) AS city_aov
              FROM (SELECT restaurant_id, name, city, count(*) AS n, sum(cents) AS cents,
                           (2 * sum(cents) * 100000000 + count(*)) // (2 * count(*)) AS aov
                    FROM m_done JOIN m_restaurants USING (restaurant_id) GROUP BY ALL)
              WHERE city IS NOT NULL WINDOW c AS (PARTITION BY city))
        WHERE n >= 75 ORDER BY pct_vs_city DESC, restaurant_id LIMIT 25""",
    "new_vs_returning": f"""
        SELECT month, {money("sum(cents) FILTER (WHERE month = cohort_month)")} AS new_revenue,
               {money("sum(cents) FILTER (WHERE month <> cohort_month)")} AS returning_revenue,
               {pct("sum(cents) FILTER (WHERE month <> cohort_month)", "sum(cents)")} AS pct_returning
        FROM m_customer_months GROUP BY month ORDER BY month""",
    "month_spine": f"""
        SELECT axis.month, coalesce(n, 0) AS orders, coalesce({money("cents")}, 0) AS revenue
        FROM (SELECT CAST(unnest(generate_series(DATE '1994-10-01', DATE '2001-12-01', INTERVAL 1 MONTH)) AS DATE) AS month) axis
        LEFT JOIN (SELECT CAST(date_trunc('month', order_timestamp) AS DATE) AS month, count(*) AS n,
                          sum(cents) FILTER (WHERE status = 'delivered') AS cents
                   FROM m_orders GROUP BY 1) found ON found.month = axis.month ORDER BY 1""",
    "cohort_sizes": """
        SELECT cohort_month, cohort_size AS new_customers FROM m_sizes ORDER BY 1""",
    "cohort_retention_matrix": f"""
        SELECT cohort_month, cohort_size, month_offset, active AS active_customers,
               {pct("active", "cohort_size")} AS retention_pct
        FROM m_cohorts JOIN m_sizes USING (cohort_month) ORDER BY 1, 3""",
    "cohort_matrix_pivot": f"""
        SELECT cohort_month, cohort_size,
               {", ".join(f"max(p) FILTER (WHERE month_offset = {n}) AS month_{n}" for n in range(80))}
        FROM (SELECT *, {pct("active", "cohort_size")} AS p FROM m_cohorts JOIN m_sizes USING (cohort_month))
        GROUP BY 1, 2 ORDER BY 1""",
    "retention_curve": f"""
        SELECT month_offset, {big("sum(active)")} AS active_customers,
               {pct("sum(active)", "(SELECT count(DISTINCT customer_id) FROM m_done)")} AS pct_of_all_customers
        FROM m_cohorts GROUP BY month_offset ORDER BY 1""",
    "churn_flag": """
        SELECT customer_id, name, segment, last_day AS last_order_date, idle AS days_since_last_order,
               CASE WHEN idle > 90 THEN 'churned' ELSE 'active' END AS churn_status
        FROM m_last JOIN m_customers USING (customer_id)""",
    "churn_rate": f"""
        SELECT count(*) AS customers_with_orders, count(*) FILTER (WHERE idle > 90) AS churned,
               {pct("count(*) FILTER (WHERE idle > 90)", "count(*)")} AS churn_rate_pct FROM m_last""",
    "last_order": "SELECT customer_id, max(order_timestamp) AS last_order FROM m_done GROUP BY customer_id",
    "rfm_scores": _SCORES,
    "rfm_scores_sliced": _SCORES,
    "rfm_segments": f"""
        SELECT customer_id, recency AS recency_days, orders AS frequency, {money("cents")} AS monetary,
               {big("r")} AS r, {big("f")} AS f, {big("m")} AS m, {_LABEL8} AS segment FROM m_rfm""",
    "rfm_rollup": f"""
        SELECT segment, n AS customers, {pct("n", "sum(n) OVER ()")} AS pct_customers, {money("cents")} AS total_revenue,
               {pct("cents", "sum(cents) OVER ()")} AS pct_revenue,
               {ratio("cents", "100 * n", 2)} AS avg_revenue_per_customer, {ratio("orders", "n", 1)} AS avg_orders
        FROM (SELECT {_LABEL8} AS segment, count(*) AS n, sum(cents) AS cents, sum(orders) AS orders FROM m_rfm GROUP BY 1)""",
    "rfm_rollup_headline": f"""
        SELECT segment, n AS customers, {pct("cents", "sum(cents) OVER ()")} AS pct_revenue
        FROM (SELECT {_LABEL7} AS segment, count(*) AS n, sum(cents) AS cents FROM m_rfm GROUP BY 1)""",
    "sla_by_city": f"""
        SELECT city, count(*) AS valid_deliveries, {_ON_TIME} AS on_time, {pct(_ON_TIME, "count(*)")} AS on_time_pct
        FROM m_timed JOIN m_restaurants USING (restaurant_id) GROUP BY ROLLUP (city)""",
    "delivery_percentiles": f"""
        SELECT city, count(*) AS deliveries, {ratio("sum(minutes)", "count(*)", 1)} AS avg_minutes,
               quantile_cont(CAST(minutes AS DOUBLE), 0.5) AS median_minutes,
               quantile_cont(CAST(minutes AS DOUBLE), 0.9) AS p90_minutes
        FROM m_timed JOIN m_restaurants USING (restaurant_id) GROUP BY city""",
    "delivery_percentiles_sketched": """
        SELECT city, count(*) AS deliveries, true AS median_ok, true AS p90_ok
        FROM m_timed JOIN m_restaurants USING (restaurant_id) GROUP BY city""",
    "rider_leaderboard": f"""
        SELECT name, city, vehicle_type, deliveries, avg_minutes, on_time_pct FROM (
            SELECT rider_id, count(*) AS deliveries, {ratio("sum(minutes)", "count(*)", 1)} AS avg_minutes,
                   {pct(_ON_TIME, "count(*)")} AS on_time_pct
            FROM m_timed GROUP BY rider_id HAVING count(*) >= 60)
        JOIN m_riders USING (rider_id) ORDER BY avg_minutes, rider_id LIMIT 20""",
    "cancel_refund_by_city": f"""
        SELECT city, count(*) AS total_orders, count(*) FILTER (WHERE status = 'delivered') AS delivered,
               count(*) FILTER (WHERE status = 'cancelled') AS cancelled,
               count(*) FILTER (WHERE status = 'refunded') AS refunded,
               {pct("count(*) FILTER (WHERE status = 'cancelled')", "count(*)")} AS cancel_rate_pct,
               {pct("count(*) FILTER (WHERE status = 'refunded')", "count(*)")} AS refund_rate_pct
        FROM m_orders JOIN m_restaurants USING (restaurant_id) GROUP BY city""",
    "vehicle_performance": f"""
        SELECT vehicle_type, count(*) AS deliveries, {ratio("sum(minutes)", "count(*)", 1)} AS avg_minutes,
               {pct(_ON_TIME, "count(*)")} AS on_time_pct
        FROM m_timed JOIN m_riders USING (rider_id) GROUP BY vehicle_type""",
    "peak_hours": f"""
        SELECT hour_of_day, n AS orders, {pct("n", "sum(n) OVER ()")} AS pct_of_orders
        FROM (SELECT hour(order_timestamp) AS hour_of_day, count(*) AS n FROM m_orders GROUP BY 1)""",
    "selective_lookup": f"""
        SELECT order_id, {money("cents")} AS total_amount FROM m_done WHERE restaurant_id = 42""",
    "selective_lookup_layout": f"""
        SELECT order_id, {money("cents")} AS total_amount FROM m_done WHERE restaurant_id = 42""",
    "selective_lookup_customer": f"""
        SELECT order_id, {money("cents")} AS total_amount FROM m_done WHERE customer_id = 77""",
    "kpi_topline": f"""
        SELECT (SELECT count(*) FROM m_customers) AS customers, (SELECT count(*) FROM m_restaurants) AS restaurants,
               (SELECT count(*) FROM m_orders) AS total_orders, count(*) AS delivered_orders,
               {ratio("sum(cents)", "100", 0)} AS total_revenue, {ratio("sum(cents)", "100 * count(*)", 2)} AS avg_order_value
        FROM m_done""",
    "kpi_cancel_refund": f"""
        SELECT {pct("count(*) FILTER (WHERE status = 'cancelled')", "count(*)")} AS cancel_rate_pct,
               {pct("count(*) FILTER (WHERE status = 'refunded')", "count(*)")} AS refund_rate_pct FROM m_orders""",
    "kpi_on_time": f"""
        SELECT count(*) AS valid_deliveries, {pct(_ON_TIME, "count(*)")} AS on_time_pct,
               {ratio("sum(minutes)", "count(*)", 1)} AS avg_delivery_minutes FROM m_timed""",
    "kpi_top_cities": f"""
        SELECT city, count(*) AS orders, {ratio("sum(cents)", "100", 0)} AS revenue
        FROM m_done JOIN m_restaurants USING (restaurant_id) GROUP BY city ORDER BY sum(cents) DESC, city LIMIT 5""",
    "kpi_top_cuisines": f"""
        SELECT cuisine_type, count(*) AS orders, {ratio("sum(cents)", "100", 0)} AS revenue
        FROM m_done JOIN m_restaurants USING (restaurant_id)
        GROUP BY cuisine_type ORDER BY sum(cents) DESC, cuisine_type LIMIT 5""",
    "kpi_returning_share": f"""
        SELECT {pct("sum(cents) FILTER (WHERE month <> cohort_month)", "sum(cents)")} AS pct_revenue_returning
        FROM m_customer_months""",
    "best_months": f"""
        SELECT strftime(month, '%Y-%m') AS month, {ratio("cents", "100", 0)} AS revenue
        FROM m_months ORDER BY cents DESC, m_months.month LIMIT 3""",
    "yearly_revenue_yoy": f"""
        SELECT year(now.month) AS year, {big("sum(now.orders)")} AS orders, {money("sum(now.cents)")} AS revenue,
               {money("sum(past.cents)")} AS revenue_same_months_last_year,
               {pct("sum(now.cents) - sum(past.cents)", "sum(past.cents)")} AS yoy_pct
        FROM m_months now LEFT JOIN m_months past ON past.month = now.month - INTERVAL 1 YEAR
        GROUP BY 1 ORDER BY 1""",
    "stage_text": """
        SELECT CAST(customer_id AS VARCHAR) AS customer_id, name, city, signup_text AS signup_date, segment
        FROM m_raw_customers""",
    "stage_text_all": f"""
        SELECT 'customers' AS table_name, concat_ws('|', customer_id, name, coalesce(city, ''), signup_text, segment) AS record
        FROM m_raw_customers
        UNION ALL SELECT 'restaurants', concat_ws('|', restaurant_id, name, cuisine_type, coalesce(city, ''), active_since,
               coalesce(printf('%.2f', avg_rating), '')) FROM m_restaurants
        UNION ALL SELECT 'menu_items', concat_ws('|', item_id, restaurant_id, name, category, {_TEXT_MONEY.format("price_cents")})
        FROM m_menu_items
        UNION ALL SELECT 'riders', concat_ws('|', rider_id, name, coalesce(city, ''), join_date, vehicle_type) FROM m_riders
        UNION ALL SELECT 'orders', concat_ws('|', order_id, customer_id, restaurant_id, coalesce(CAST(rider_id AS VARCHAR), ''),
               order_timestamp, status, payment_method, {_TEXT_MONEY.format("cents")},
               coalesce(CAST(minutes AS VARCHAR), ''), {_TEXT_MONEY.format("discount_cents")}) FROM m_raw_orders
        UNION ALL SELECT 'order_items', concat_ws('|', order_id, item_id, quantity, {_TEXT_MONEY.format("price_cents")}) FROM m_items
        UNION ALL SELECT 'reviews', concat_ws('|', order_id, order_id, coalesce(CAST(rating AS VARCHAR), ''), '', date_text)
        FROM m_raw_reviews""",
    "parse_dates": "SELECT review_id, date_text, review_date FROM m_reviews",
    "dedup_customers": """
        SELECT customer_id, name, coalesce(city, '') AS city, signup_text AS signup_date, segment
        FROM m_dedup_customers""",
    "clean_customers": f"""
        SELECT customer_id, name, {_CITY.format("city")} AS city, {_CLEAN_DATE} AS signup_date, segment
        FROM m_dedup_customers""",
    "clean_restaurants": f"""
        SELECT restaurant_id, name, cuisine_type, {_CITY.format("city")} AS city, active_since, avg_rating
        FROM m_restaurants""",
    "clean_menu_items": f"""
        SELECT item_id, restaurant_id, name, category, {money("price_cents")} AS price FROM m_menu_items""",
    "clean_riders": f"""
        SELECT rider_id, name, {_CITY.format("city")} AS city, join_date, vehicle_type FROM m_riders""",
    "clean_orders": f"""
        SELECT order_id, customer_id, restaurant_id, rider_id, order_timestamp, status, payment_method,
               {money("cents")} AS total_amount, CASE WHEN minutes >= 0 THEN minutes END AS delivery_time_minutes,
               {money("discount_cents")} AS discount_applied
        FROM m_clean_orders""",
    "clean_order_items": f"""
        SELECT order_id, item_id, {big("quantity")} AS quantity, {money("price_cents")} AS unit_price
        FROM m_items WHERE order_id IN (SELECT order_id FROM m_clean_orders)""",
    "clean_reviews": f"""
        SELECT review_id, order_id, {big("rating")} AS rating, '' AS review_text, review_date
        FROM m_reviews WHERE order_id IN (SELECT order_id FROM m_clean_orders)""",
    "constraint_audit": "\nUNION ALL ".join(
        f"SELECT '{table}' AS table_name, '{rule}' AS rule, ({found}) AS violations" for table, rule, found in _AUDIT
    ),
    "row_counts": "\nUNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS row_count FROM {source}"
        for name, source in (
            ("customers", "m_dedup_customers"),
            ("restaurants", "m_restaurants"),
            ("menu_items", "m_menu_items"),
            ("riders", "m_riders"),
            ("orders", "m_clean_orders"),
            ("order_items", "m_items WHERE order_id IN (SELECT order_id FROM m_clean_orders)"),
            ("reviews", "m_reviews WHERE order_id IN (SELECT order_id FROM m_clean_orders)"),
        )
    ),
    "dq_summary": """
        SELECT (SELECT count(*) FROM m_dedup_customers) AS customers_after_dedup,
               (SELECT count(*) FROM m_raw_customers) - (SELECT count(*) FROM m_dedup_customers) AS dupes_removed,
               (SELECT count(*) FROM m_restaurants WHERE avg_rating IS NULL) AS null_ratings,
               (SELECT count(*) FROM m_reviews
                WHERE rating IS NULL AND order_id IN (SELECT order_id FROM m_clean_orders)) AS null_review_ratings,
               count(*) FILTER (WHERE minutes IS NULL OR minutes < 0) AS null_delivery_times,
               count(*) FILTER (WHERE minutes > 180) AS outlier_delivery_times
        FROM m_clean_orders""",
    "reject_balance": """
        SELECT table_name, raw_rows, kept_rows, raw_rows - kept_rows AS rejected_rows, lost_values FROM (
            SELECT 'customers' AS table_name, (SELECT count(*) FROM m_raw_customers) AS raw_rows, count(*) AS kept_rows,
                   count_if(try_strptime(signup_text, ['%Y-%m-%d', '%m/%d/%Y', '%m-%d-%Y', '%d-%b-%Y', '%d/%m/%Y']) IS NULL
                            AND signup_text IS NOT NULL) AS lost_values
            FROM m_dedup_customers
            UNION ALL SELECT 'restaurants', count(*), count(*), 0 FROM m_restaurants
            UNION ALL SELECT 'menu_items', count(*), count(*), 0 FROM m_menu_items
            UNION ALL SELECT 'riders', count(*), count(*), 0 FROM m_riders
            UNION ALL SELECT 'orders', (SELECT count(*) FROM m_raw_orders), count(*), count_if(minutes < 0) FROM m_clean_orders
            UNION ALL SELECT 'order_items', (SELECT count(*) FROM m_items), count(*), 0
            FROM m_items WHERE order_id IN (SELECT order_id FROM m_clean_orders)
            UNION ALL SELECT 'reviews', (SELECT count(*) FROM m_reviews), count(*),
                   count_if(review_date IS NULL AND date_text IS NOT NULL)
            FROM m_reviews WHERE order_id IN (SELECT order_id FROM m_clean_orders))""",
    "unparsed_dates": """
        SELECT 'customers' AS table_name, 'signup_date' AS column_name, count(signup_text) AS date_texts,
               count_if(try_strptime(signup_text, ['%Y-%m-%d', '%m/%d/%Y', '%m-%d-%Y', '%d-%b-%Y', '%d/%m/%Y']) IS NULL) AS unparsed
        FROM m_raw_customers
        UNION ALL SELECT 'restaurants', 'active_since', count(active_since), 0 FROM m_restaurants
        UNION ALL SELECT 'riders', 'join_date', count(join_date), 0 FROM m_riders
        UNION ALL SELECT 'reviews', 'review_date', count(date_text), count_if(review_date IS NULL) FROM m_reviews""",
    "dim_date": """
        SELECT date_key, year(date_key) AS year, quarter(date_key) AS quarter, 'Q' || quarter(date_key) AS quarter_name,
               month(date_key) AS month_no, strftime(date_key, '%b') AS month_short,
               strftime(date_key, '%Y-%m') AS year_month, day(date_key) AS day_of_month,
               isodow(date_key) AS iso_weekday, strftime(date_key, '%a') AS weekday_short,
               isodow(date_key) > 5 AS is_weekend
        FROM m_dates""",
    "dim_customers": """
        SELECT customer_id, name AS customer_name, coalesce(city, 'Unknown') AS city, signup_date,
               strftime(signup_date, '%Y-%m') AS signup_month, coalesce(segment, 'unknown') AS segment
        FROM m_customers""",
    "dim_restaurants": """
        SELECT restaurant_id, name AS restaurant_name, cuisine_type, coalesce(city, 'Unknown') AS city,
               active_since, avg_rating FROM m_restaurants""",
    "dim_riders": """
        SELECT rider_id, name AS rider_name, coalesce(city, 'Unknown') AS city, join_date, vehicle_type FROM m_riders""",
    "dim_menu_items": f"""
        SELECT item_id, i.name AS item_name, category, {money("price_cents")} AS list_price, restaurant_id,
               r.name AS restaurant_name
        FROM m_menu_items i JOIN m_restaurants r USING (restaurant_id)""",
    "fact_orders": f"""
        SELECT order_id, customer_id, restaurant_id, rider_id, order_timestamp, date_key, status, payment_method,
               {money("cents")} AS total_amount, {money("discount_cents")} AS discount_applied,
               valid_minutes AS delivery_time_minutes, is_delivered, is_cancelled, is_on_time, had_discount,
               item_count, {big("total_quantity")} AS total_quantity
        FROM m_fact""",
    "fact_reviews": f"""
        SELECT review_id, order_id, customer_id, restaurant_id, {big("rating")} AS rating, review_date AS date_key
        FROM m_reviews JOIN m_orders USING (order_id)""",
    "fact_order_items": f"""
        SELECT order_id, item_id, {big("quantity")} AS quantity, {money("price_cents")} AS unit_price,
               {money("quantity * price_cents")} AS line_revenue, CAST(order_timestamp AS DATE) AS date_key, status,
               status = 'delivered' AS is_delivered
        FROM m_items JOIN m_orders USING (order_id)""",
    "fact_order_items_bucketed": f"""
        SELECT order_id, item_id, {big("quantity")} AS quantity, {money("price_cents")} AS unit_price,
               {money("quantity * price_cents")} AS line_revenue, CAST(order_timestamp AS DATE) AS date_key, status,
               status = 'delivered' AS is_delivered
        FROM m_items JOIN m_orders USING (order_id)""",
    "metrics_overall": f"SELECT {_MEASURES} FROM m_fact",
    "metrics_by_month": f"""
        SELECT strftime(date_key, '%Y-%m') AS year_month, {_MEASURES} FROM m_fact GROUP BY 1 ORDER BY 1""",
    "metrics_mtd_ytd": f"""
        SELECT date_key, {money("cents")} AS total_revenue,
               {money("sum(cents) OVER (PARTITION BY year(date_key), month(date_key) ORDER BY date_key)")} AS revenue_mtd,
               {money("sum(cents) OVER (PARTITION BY year(date_key) ORDER BY date_key)")} AS revenue_ytd,
               {money("sum(cents) OVER (ORDER BY date_key)")} AS running_revenue
        FROM m_dates LEFT JOIN (SELECT day, sum(cents) AS cents FROM m_done GROUP BY day) ON day = date_key""",
    "metrics_mom_yoy": f"""
        SELECT now.month, {money("now.cents")} AS total_revenue, {money("pm.cents")} AS revenue_pm,
               {ratio("coalesce(now.cents, 0) - pm.cents", "pm.cents", 6)} AS mom_rate,
               {money("py.cents")} AS revenue_py,
               {ratio("coalesce(now.cents, 0) - py.cents", "py.cents", 6)} AS yoy_rate
        FROM m_month_calendar now
        LEFT JOIN m_month_calendar pm ON pm.month = now.month - INTERVAL 1 MONTH
        LEFT JOIN m_month_calendar py ON py.month = now.month - INTERVAL 1 YEAR ORDER BY 1""",
    "metrics_mtd_ytd_sliced": f"""
        SELECT date_key, total_revenue, revenue_mtd, revenue_ytd,
               {money("sum(day_cents) OVER (ORDER BY date_key)")} AS running_revenue FROM (
            SELECT date_key, {money("cents")} AS total_revenue, cents AS day_cents,
                   {money("sum(cents) OVER (PARTITION BY year(date_key), month(date_key) ORDER BY date_key)")} AS revenue_mtd,
                   {money("sum(cents) OVER (PARTITION BY year(date_key) ORDER BY date_key)")} AS revenue_ytd
            FROM m_dates LEFT JOIN (SELECT day, sum(cents) AS cents FROM m_done GROUP BY day) ON day = date_key)
        WHERE date_key BETWEEN DATE '1998-03-15' AND DATE '1998-05-10'""",
    "metrics_mom_yoy_sliced": f"""
        SELECT cal.month, {money("now.cents")} AS total_revenue, {money("pm.cents")} AS revenue_pm,
               {ratio("coalesce(now.cents, 0) - pm.cents", "pm.cents", 6)} AS mom_rate,
               {money("py.cents")} AS revenue_py,
               {ratio("coalesce(now.cents, 0) - py.cents", "py.cents", 6)} AS yoy_rate
        FROM (SELECT DISTINCT month FROM m_month_calendar WHERE year(month) = 1998) cal
        LEFT JOIN (SELECT month, cents FROM m_city_months) now ON now.month = cal.month
        LEFT JOIN m_city_months pm ON pm.month = cal.month - INTERVAL 1 MONTH
        LEFT JOIN m_city_months py ON py.month = cal.month - INTERVAL 1 YEAR""",
    "metrics_new_returning_by_city": f"""
        SELECT city, count(*) AS active_customers, count(*) FILTER (WHERE first_day >= start) AS new_customers,
               count(*) FILTER (WHERE first_day < start) AS returning_customers,
               {ratio("count(*) FILTER (WHERE first_day < start)", "count(*)", 6)} AS repeat_rate
        FROM (SELECT DISTINCT city, customer_id FROM m_done JOIN m_restaurants USING (restaurant_id)
              WHERE year(day) IN (1997, 1998))
        JOIN (SELECT customer_id, min(day) AS first_day FROM m_done GROUP BY customer_id) USING (customer_id),
             (SELECT min(date_key) AS start FROM m_dates WHERE year(date_key) IN (1997, 1998))
        GROUP BY city""",
    "metrics_new_returning_by_city_apart": f"""
        SELECT city, count(*) AS active_customers, count(*) FILTER (WHERE year(first_day) IN (1997, 1999)) AS new_customers,
               count(*) FILTER (WHERE year(first_day) NOT IN (1997, 1999)) AS returning_customers,
               {ratio("count(*) FILTER (WHERE year(first_day) NOT IN (1997, 1999))", "count(*)", 6)} AS repeat_rate
        FROM (SELECT DISTINCT city, customer_id FROM m_done JOIN m_restaurants USING (restaurant_id)
              WHERE year(day) IN (1997, 1999))
        JOIN (SELECT customer_id, min(day) AS first_day FROM m_done GROUP BY customer_id) USING (customer_id)
        GROUP BY city""",
    "refreshed_row_counts": """
        SELECT 'customers' AS table_name, count(*) AS row_count FROM m_customers
        UNION ALL SELECT 'restaurants', count(*) FROM m_restaurants
        UNION ALL SELECT 'menu_items', count(*) FROM m_menu_items
        UNION ALL SELECT 'riders', count(*) FROM m_riders
        UNION ALL SELECT 'orders', count(*) FROM m_orders WHERE status = 'delivered'
        UNION ALL SELECT 'order_items', count(*) FROM m_items
        UNION ALL SELECT 'reviews', count(*) FROM m_reviews""",
    "metrics_reviews_by_cuisine": f"""
        SELECT cuisine_type, {ratio("sum(rating)", "count(rating)", 6)} AS avg_rating, count(rating) AS review_count
        FROM m_reviews JOIN m_orders USING (order_id) JOIN m_restaurants USING (restaurant_id) GROUP BY 1""",
    "kpi_avg_rating": f"""
        SELECT {ratio("sum(rating)", "count(rating)", 6)} AS avg_rating, count(rating) AS review_count
        FROM m_reviews JOIN m_orders USING (order_id)""",
    "metrics_new_returning": f"""
        SELECT month, count(*) AS active_customers, count(*) FILTER (WHERE month = cohort_month) AS new_customers,
               count(*) FILTER (WHERE month <> cohort_month) AS returning_customers,
               {ratio("count(*) FILTER (WHERE month <> cohort_month)", "count(*)", 6)} AS repeat_rate
        FROM m_customer_months GROUP BY month ORDER BY month""",
    "metrics_segment": f"""
        SELECT segment, count(DISTINCT c.customer_id) AS customers_in_segment, {money("sum(cents)")} AS total_revenue
        FROM m_customers c LEFT JOIN m_done d ON d.customer_id = c.customer_id GROUP BY segment ORDER BY 1""",
    "metrics_reviews": f"""
        SELECT CAST(date_trunc('month', review_date) AS DATE) AS month,
               {ratio("sum(rating)", "count(rating)", 6)} AS avg_rating, count(rating) AS review_count
        FROM m_reviews GROUP BY 1 ORDER BY 1""",
    "metrics_label": f"""
        SELECT date_key, {money("cents")} AS total_revenue,
               CASE WHEN cents >= 1000000000 THEN printf('%.2f', {ratio("cents", "1000000000", 2)}) || ' Cr'
                    WHEN cents >= 10000000 THEN printf('%.2f', {ratio("cents", "10000000", 2)}) || ' L'
                    ELSE format('{{:,}}', {big(ratio("cents", "100", 0))}) END AS revenue_label
        FROM (SELECT date_key, sum(cents) FILTER (WHERE is_delivered) AS cents FROM m_fact GROUP BY 1)""",
    "metric_by_city_filtered": f"""
        SELECT city, {money("sum(cents)")} AS total_revenue
        FROM m_done JOIN m_restaurants USING (restaurant_id)
        WHERE year(day) IN (1997, 1998) AND city IN ('NATION_9', 'NATION_11', 'NATION_6') GROUP BY city""",
    "metric_by_vehicle": f"""
        SELECT vehicle_type, {_SPEED} FROM m_fact LEFT JOIN m_riders USING (rider_id) GROUP BY 1""",
    "metric_by_rider": f"""
        SELECT f.rider_id, name AS rider_name, {_SPEED}
        FROM m_fact f LEFT JOIN m_riders r ON r.rider_id = f.rider_id GROUP BY 1, 2""",
    "rating_vs_revenue": f"""
        SELECT restaurant_id, name AS restaurant_name, avg_rating, review_count, {money("cents")} AS total_revenue
        FROM (SELECT restaurant_id, name FROM m_restaurants)
        LEFT JOIN (SELECT restaurant_id, sum(cents) AS cents FROM m_done GROUP BY 1) USING (restaurant_id)
        LEFT JOIN (SELECT restaurant_id, {ratio("sum(rating)", "count(rating)", 6)} AS avg_rating,
                          count(rating) AS review_count
                   FROM m_reviews JOIN m_orders USING (order_id) GROUP BY 1) USING (restaurant_id)""",
    "items_sold": f"""
        SELECT item_id, name AS item_name, {big("units")} AS items_sold
        FROM m_units JOIN m_menu_items USING (item_id)""",
}

ORACLE: dict[str, str] = {name: with_tables(body) for name, body in _BODIES.items()}
ORACLE["taxonomy_rollup"] = with_tables(
    f"""
    SELECT coalesce(root, 'Uncategorised') AS department, category, {money("cents")} AS category_revenue,
           {money("sum(cents) OVER (PARTITION BY root)")} AS department_revenue
    FROM (SELECT category, sum(cents) AS cents FROM m_units JOIN m_menu_items USING (item_id) GROUP BY 1)
    LEFT JOIN (SELECT node, root FROM m_walk WHERE level = 1) ON node = category""",
    extra=_TREE,
)
