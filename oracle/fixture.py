"""The marketplace tables as SQL over the test tables, for DuckDB.

Written apart from the Spark code on purpose: both sides follow FIXTURES.md.
Money is kept in whole cents, so that sums and rounded ratios are exact.
"""

from __future__ import annotations

import re

DUPLICATE_OFFSET = 1_000_000_000_000

# name -> (common table expression, in an order in which each uses earlier ones)
TABLES: dict[str, str] = {
    "m_size": "SELECT count(*) AS n FROM supplier",
    "m_customers": """
        SELECT c_custkey AS customer_id, c_name AS name,
               CASE WHEN c_custkey % 25 = 0 THEN NULL ELSE n_name END AS city,
               DATE '1994-06-01' + CAST(c_custkey % 900 AS INTEGER) AS signup_date,
               lower(c_mktsegment) AS segment
        FROM customer JOIN nation ON n_nationkey = c_nationkey""",
    "m_restaurants": """
        SELECT s_suppkey AS restaurant_id, s_name AS name, r_name AS cuisine_type, n_name AS city,
               DATE '1990-01-01' + CAST(s_suppkey % 1500 AS INTEGER) AS active_since,
               CASE WHEN s_suppkey % 20 = 7 THEN NULL
                    ELSE CAST(260 + s_suppkey * 37 % 240 AS DOUBLE) / 100 END AS avg_rating
        FROM supplier JOIN nation ON n_nationkey = s_nationkey JOIN region ON r_regionkey = n_regionkey""",
    "m_menu_items": """
        SELECT p_partkey AS item_id, p_partkey % n AS restaurant_id, p_name AS name, p_type AS category,
               CAST(CAST(p_retailprice AS DECIMAL(8,2)) * 100 AS BIGINT) AS price_cents
        FROM part, m_size""",
    "m_riders": """
        SELECT s_suppkey AS rider_id, s_name AS name, n_name AS city,
               DATE '1991-01-01' + CAST(s_suppkey % 1900 AS INTEGER) AS join_date,
               CASE s_suppkey % 4 WHEN 0 THEN 'bike' WHEN 1 THEN 'scooter' WHEN 2 THEN 'car'
                                  ELSE 'bicycle' END AS vehicle_type
        FROM supplier JOIN nation ON n_nationkey = s_nationkey""",
    "m_orders": """
        SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderkey % n AS restaurant_id,
               CASE WHEN o_orderstatus = 'O' THEN NULL ELSE (o_orderkey // n) % n END AS rider_id,
               o_orderdate + to_hours(8 + o_orderkey % 16) + to_minutes(o_orderkey * 7 % 60) AS order_timestamp,
               CASE WHEN o_orderstatus = 'O' THEN 'cancelled'
                    WHEN o_orderstatus = 'P' AND (o_orderkey + o_custkey) % 4 = 0 THEN 'in_progress'
                    WHEN o_orderstatus = 'P' AND (o_orderkey + o_custkey) % 4 = 1 THEN 'refunded'
                    ELSE 'delivered' END AS status,
               o_orderpriority AS payment_method,
               CAST(CAST(o_totalprice AS DECIMAL(12,2)) * 100 AS BIGINT) AS cents,
               CASE WHEN o_orderstatus = 'O' OR o_orderkey % 199 = 0 THEN NULL
                    WHEN o_orderkey % 201 = 0 THEN -1 - o_orderkey % 20
                    WHEN o_orderkey % 167 = 0 THEN 300 + o_orderkey % 301
                    ELSE 15 + (o_orderkey * 37 + o_custkey * 11) % 56 END AS minutes,
               CASE WHEN o_orderkey % 20 < 7 THEN 500 * (1 + o_orderkey % 4) ELSE 0 END AS discount_cents
        FROM orders, m_size""",
    "m_done": """
        SELECT *, CAST(order_timestamp AS DATE) AS day,
               CAST(date_trunc('month', order_timestamp) AS DATE) AS month
        FROM m_orders WHERE status = 'delivered'""",
    "m_timed": "SELECT * FROM m_done WHERE minutes BETWEEN 1 AND 180",
    "m_items": """
        SELECT l_orderkey AS order_id, l_partkey AS item_id, CAST(l_quantity AS INTEGER) AS quantity,
               CAST(CAST(p_retailprice AS DECIMAL(8,2)) * 100 AS BIGINT) AS price_cents
        FROM lineitem JOIN part ON p_partkey = l_partkey""",
    "m_raw_reviews": """
        SELECT order_id,
               CASE WHEN (order_id + customer_id) % 40 = 2 THEN NULL
                    ELSE 1 + (order_id + customer_id) // 2 % 5 END AS rating,
               CASE WHEN order_id % 67 = 0 THEN strftime(written, '%d/%m/%Y')
                    WHEN order_id % 53 = 0 THEN strftime(written, '%m/%d/%Y')
                    ELSE strftime(written, '%Y-%m-%d') END AS date_text
        FROM (SELECT *, CAST(order_timestamp AS DATE) + CAST(order_id % 11 AS INTEGER) AS written FROM m_orders)
        WHERE status IN ('delivered', 'refunded') AND (order_id + customer_id) % 2 = 0""",
    "m_reviews": """
        SELECT order_id AS review_id, order_id, rating, date_text,
               CAST(coalesce(try_strptime(date_text, '%Y-%m-%d'), try_strptime(date_text, '%m/%d/%Y'),
                             try_strptime(date_text, '%m-%d-%Y'), try_strptime(date_text, '%d-%b-%Y'),
                             try_strptime(date_text, '%d/%m/%Y')) AS DATE) AS review_date
        FROM m_raw_reviews""",
    "m_raw_customers": f"""
        SELECT customer_id, name, segment, CAST(signup_date AS VARCHAR) AS signup_text,
               CASE customer_id % 33 WHEN 1 THEN lower(city) WHEN 2 THEN upper(city)
                                     WHEN 3 THEN city || ' ' ELSE city END AS city
        FROM m_customers
        UNION ALL
        SELECT customer_id + {DUPLICATE_OFFSET}, name, segment,
               CASE customer_id % 3 WHEN 0 THEN strftime(signup_date, '%d/%m/%Y')
                                    WHEN 1 THEN strftime(signup_date, '%m-%d-%Y')
                                    ELSE strftime(signup_date, '%d-%b-%Y') END,
               CASE customer_id % 33 WHEN 1 THEN lower(city) WHEN 2 THEN upper(city)
                                     WHEN 3 THEN city || ' ' ELSE city END
        FROM m_customers WHERE customer_id % 61 = 5""",
    "m_dedup_customers": """
        SELECT customer_id, name, segment, signup_text, city FROM m_raw_customers
        QUALIFY row_number() OVER (PARTITION BY lower(trim(name)), lower(trim(coalesce(city, '')))
                                   ORDER BY customer_id) = 1""",
    "m_raw_orders": f"""
        SELECT * REPLACE (CASE WHEN customer_id % 61 = 5 AND order_id % 7 = 3
                               THEN customer_id + {DUPLICATE_OFFSET} ELSE customer_id END AS customer_id)
        FROM m_orders""",
    "m_clean_orders": """
        SELECT * FROM m_raw_orders
        WHERE customer_id IN (SELECT customer_id FROM m_dedup_customers)
          AND restaurant_id IN (SELECT restaurant_id FROM m_restaurants)""",
    "m_customer_months": """
        SELECT customer_id, month, sum(cents) AS cents,
               min(month) OVER (PARTITION BY customer_id) AS cohort_month
        FROM m_done GROUP BY customer_id, month""",
    "m_cohorts": """
        SELECT cohort_month, date_diff('month', cohort_month, month) AS month_offset, count(*) AS active
        FROM m_customer_months GROUP BY 1, 2""",
    "m_sizes": """
        SELECT cohort_month, count(DISTINCT customer_id) AS cohort_size
        FROM m_customer_months GROUP BY cohort_month""",
    "m_last": """
        SELECT customer_id, max(day) AS last_day,
               date_diff('day', max(day), (SELECT max(day) FROM m_done)) AS idle
        FROM m_done GROUP BY customer_id""",
    "m_rfm": """
        SELECT *, ntile(5) OVER (ORDER BY recency DESC, customer_id) AS r,
               ntile(5) OVER (ORDER BY orders, customer_id) AS f,
               ntile(5) OVER (ORDER BY cents, customer_id) AS m
        FROM (SELECT customer_id, date_diff('day', max(day), (SELECT max(day) FROM m_done)) AS recency,
                     count(*) AS orders, sum(cents) AS cents
              FROM m_done GROUP BY customer_id)""",
    "m_units": """
        SELECT item_id, sum(quantity) AS units, sum(quantity * price_cents) AS cents
        FROM m_items WHERE order_id IN (SELECT order_id FROM m_done) GROUP BY item_id""",
    "m_months": """
        SELECT month, count(*) AS orders, sum(cents) AS cents FROM m_done GROUP BY month""",
    "m_dates": """
        SELECT CAST(d AS DATE) AS date_key
        FROM (SELECT unnest(generate_series(min(CAST(order_timestamp AS DATE)),
                                            max(CAST(order_timestamp AS DATE)), INTERVAL 1 DAY)) AS d
              FROM m_orders)""",
    "m_fact": """
        SELECT o.*, CAST(order_timestamp AS DATE) AS date_key,
               CASE WHEN minutes BETWEEN 1 AND 180 THEN minutes END AS valid_minutes,
               status = 'delivered' AS is_delivered, status = 'cancelled' AS is_cancelled,
               status = 'delivered' AND minutes BETWEEN 1 AND 45 AS is_on_time,
               discount_cents > 0 AS had_discount, item_count, total_quantity
        FROM m_orders o LEFT JOIN (
            SELECT order_id AS line_order, count(*) AS item_count, sum(quantity) AS total_quantity
            FROM m_items GROUP BY order_id) ON line_order = order_id""",
    "m_city_months": """
        SELECT month, sum(cents) AS cents FROM m_done JOIN m_restaurants USING (restaurant_id)
        WHERE city IN ('NATION_9', 'NATION_11') GROUP BY month""",
    "m_month_calendar": """
        SELECT cal.month, cents FROM (
            SELECT DISTINCT CAST(date_trunc('month', date_key) AS DATE) AS month FROM m_dates) cal
        LEFT JOIN m_months found ON found.month = cal.month""",
}


def with_tables(body: str, extra: str = "") -> str:
    """``body`` preceded by just the tables it needs."""
    needed: set[str] = set()
    pending = [body + extra]
    while pending:
        for name in re.findall(r"\bm_\w+", pending.pop()):
            if name in TABLES and name not in needed:
                needed.add(name)
                pending.append(TABLES[name])
    parts = [f"{name} AS ({sql})" for name, sql in TABLES.items() if name in needed]
    if extra:
        parts.append(extra)
    return ("WITH RECURSIVE " + ",\n".join(parts) + "\n" if parts else "") + body


def money(cents: str) -> str:
    return f"CAST({cents} AS DOUBLE) / 100"


def ratio(numerator: str, denominator: str, digits: int) -> str:
    """Whole-number ratio rounded half away from zero, NULL for a zero divisor."""
    n, d, scale = f"CAST({numerator} AS HUGEINT)", f"CAST({denominator} AS HUGEINT)", 10**digits
    return (
        f"CASE WHEN {d} > 0 THEN CAST(sign({n}) * ((2 * abs({n}) * {scale} + {d}) // (2 * {d})) AS DOUBLE)"
        f" / {scale} END"
    )


def pct(numerator: str, denominator: str) -> str:
    return ratio(f"100 * ({numerator})", denominator, 1)


def big(expression: str) -> str:
    return f"CAST({expression} AS BIGINT)"
