"""The same results in the SQL of DuckDB, over the driver's tables."""

from __future__ import annotations

RAW = """
raw AS (
  SELECT concat('o', l_orderkey, '-', l_linenumber) AS order_id,
         CASE WHEN l_orderkey % 97 = 0 THEN NULL ELSE concat('cust_', o_custkey) END AS customer_id,
         concat('p', l_partkey) AS product_id,
         o_orderdate AS order_ts,
         l_shipdate AS updated_at,
         concat('  ', p_brand, ' ') AS category,
         CASE WHEN l_orderkey % 101 = 0 THEN NULL
              WHEN l_orderkey % 53 = 0 THEN -l_extendedprice
              ELSE l_extendedprice END AS amount,
         CAST(l_quantity AS BIGINT) AS quantity,
         l_suppkey AS supplier
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN part ON l_partkey = p_partkey
)"""

EVENTS = """
raw AS (
  SELECT concat('e', event_id) AS order_id, concat('vendor_', user_id) AS customer_id,
         event_type AS product_id, ts AS order_ts, ts AS updated_at, event_type AS category,
         value AS amount, CAST(json_extract_string(props, '$.k') AS BIGINT) AS quantity,
         0 AS supplier
  FROM events
)"""

TRIPS = """
trips AS (
  SELECT o_custkey % 3 + 1 AS vendor, o_orderdate AS pickup, l_shipdate AS dropoff,
         l_partkey % 265 AS pu, l_suppkey % 265 AS dropzone,
         CASE WHEN l_orderkey % 7 = 0 THEN NULL ELSE l_extendedprice END AS total_amount,
         l_extendedprice AS fare_amount,
         CASE WHEN l_orderkey % 11 = 0 THEN NULL ELSE CAST(l_linenumber AS BIGINT) END AS passenger_count
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
),
raw AS (
  SELECT concat('trip_|', vendor, '|', strftime(pickup, '%Y-%m-%d %H:%M:%S.%n'), '|', pu, '|', dropzone) AS order_id,
         concat('vendor_', vendor) AS customer_id,
         concat('route_-', pu, '-', dropzone) AS product_id,
         pickup AS order_ts,
         coalesce(dropoff, pickup) AS updated_at,
         concat('vendor_', vendor) AS category,
         coalesce(total_amount, fare_amount) AS amount,
         coalesce(passenger_count, 1) AS quantity,
         0 AS supplier
  FROM trips
)"""

VALID = """order_id IS NOT NULL AND customer_id IS NOT NULL AND product_id IS NOT NULL
    AND order_ts IS NOT NULL AND updated_at IS NOT NULL
    AND coalesce(amount > 0, false) AND coalesce(quantity > 0, false)"""

NORMAL = """
normal AS (
  SELECT order_id, customer_id, product_id, order_ts, updated_at,
         trim(lower(category)) AS category, amount, quantity, supplier
  FROM raw
)"""

LATEST = """row_number() OVER (PARTITION BY order_id ORDER BY updated_at DESC NULLS LAST,
    customer_id DESC NULLS LAST, product_id DESC NULLS LAST, order_ts DESC NULLS LAST,
    category DESC NULLS LAST, amount DESC NULLS LAST, quantity DESC NULLS LAST, supplier DESC NULLS LAST)"""

SILVER = f"""{NORMAL},
silver AS (
  SELECT * EXCLUDE (place) FROM (
    SELECT *, {LATEST} AS place FROM normal WHERE {VALID}
  ) WHERE place = 1
)"""

FACT = f"""{SILVER},
dim_category AS (
  SELECT row_number() OVER (ORDER BY category) AS category_sk, category
  FROM (SELECT DISTINCT category FROM silver WHERE category IS NOT NULL)
),
dim_product AS (SELECT DISTINCT product_id, category FROM silver),
dim_customer AS (SELECT DISTINCT customer_id FROM silver),
fact AS (
  SELECT s.order_id, s.customer_id, s.product_id, c.category_sk, s.order_ts,
         CAST(s.order_ts AS DATE) AS order_date, s.amount, s.quantity,
         s.amount / s.quantity AS unit_amount,
         greatest(0.0, date_diff('second', s.order_ts, s.updated_at) / 60.0) AS trip_duration_min,
         s.amount * s.quantity AS gross_revenue,
         s.category, s.updated_at
  FROM silver s LEFT JOIN dim_category c ON s.category = c.category
)"""


def money(expression: str) -> str:
    """An exact sum of money as a double."""
    return f"CAST(CAST(SUM(CAST({expression} AS DECIMAL(28,6))) AS VARCHAR) AS DOUBLE)"


REVENUE = money("gross_revenue")


def orders(sql: str, upto: str = FACT) -> str:
    return f"WITH {RAW.strip()},{upto} {sql}"


def events(sql: str, upto: str = FACT) -> str:
    return f"WITH {EVENTS.strip()},{upto} {sql}"


def trips(sql: str, upto: str = FACT) -> str:
    return f"WITH {TRIPS.strip()},{upto} {sql}"
