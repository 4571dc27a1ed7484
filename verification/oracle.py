"""DuckDB SQL for the registered queries, written from the feed rules.

No JSON envelope, no slicing, no pre-aggregation here: each text states the
result directly, so it is an independent account of what a query must return.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# Feeds
# ---------------------------------------------------------------------------
ORDER_SNAP = """
order_snap AS (
  SELECT o_orderkey AS order_id,
         CASE WHEN o_orderkey % 23 <> 5 THEN o_custkey END AS customer_id,
         CASE WHEN day = 2 AND o_orderkey % 29 = 3 THEN 'cancelled'
              ELSE ['pending', 'paid', 'shipped', 'delivered'][
                1 + least(3, CASE o_orderstatus WHEN 'F' THEN 3 WHEN 'P' THEN 1 ELSE 0 END
                             + least(day, o_orderkey % 3))] END AS status,
         'USD' AS currency,
         o_totalprice AS total_amount,
         o_orderdate AS created_at,
         o_orderdate + to_days(CAST(least(day, o_orderkey % 3) AS INTEGER)) AS updated_at,
         '2001-08-0' || (day + 1) AS ds
  FROM orders CROSS JOIN (SELECT unnest([0, 1, 2]) AS day)
),
order_new AS (SELECT * FROM order_snap WHERE ds = '2001-08-03')"""

ITEM_NEW = """
item_new AS (
  SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey,
                   strftime(l_shipdate, '%Y%m%d')) AS order_item_id,
         l_orderkey AS order_id,
         l_partkey AS product_id,
         CAST(l_quantity AS INTEGER) AS quantity,
         (2 * CAST(round(l_extendedprice * 100) AS BIGINT) + CAST(l_quantity AS BIGINT))
           // (2 * CAST(l_quantity AS BIGINT)) AS unit_cents,
         l_shipdate
  FROM lineitem
)"""

PRODUCT = """
product AS (
  SELECT p_partkey AS product_id,
         upper(left(p_type, 3)) || '-' || upper(left(p_brand, 3)) || '-' ||
           CASE WHEN length(CAST(p_partkey AS VARCHAR)) < 6
                THEN lpad(CAST(p_partkey AS VARCHAR), 6, '0')
                ELSE CAST(p_partkey AS VARCHAR) END AS sku,
         p_name AS name, p_type AS category, p_brand AS subcategory,
         p_retailprice AS unit_price, p_size % 10 <> 0 AS is_active
  FROM part
)"""

CUSTOMER = """
customer_row AS (
  SELECT c_custkey AS customer_id,
         lower(replace(c_name, '#', '.')) || '@example.com' AS email,
         c_name AS full_name, n_name AS country_code,
         c_acctbal > 5000 AS marketing_opt_in,
         TIMESTAMP '1995-01-01 00:00:00' AS created_at
  FROM customer JOIN nation ON c_nationkey = n_nationkey
)"""

FACTS = f"""{ORDER_SNAP},{ITEM_NEW},
fact AS (
  SELECT order_item_id, order_id, customer_id, product_id, status AS order_status, currency,
         quantity, unit_cents, quantity * unit_cents AS revenue_cents, created_at
  FROM item_new JOIN order_new USING (order_id)
),
paid_fact AS (SELECT * FROM fact WHERE order_status IN ('paid', 'shipped', 'delivered'))"""

MART = f"""{FACTS},
mart AS (
  SELECT CAST(created_at AS DATE) AS order_date,
         CAST(count(DISTINCT order_id) AS BIGINT) AS orders,
         CAST(sum(quantity) AS BIGINT) AS units_sold,
         CAST(sum(revenue_cents) AS BIGINT) / 100.0 AS revenue
  FROM paid_fact GROUP BY 1
)"""

ORDER_CHANGES = """
order_base AS (
  SELECT o_orderkey AS k, o_custkey AS c, o_orderdate AS d, o_orderstatus = 'F' AS f,
         CASE WHEN o_orderkey % 500 = 1 THEN -o_totalprice ELSE o_totalprice END AS total,
         CASE WHEN o_orderkey % 17 = 0 THEN o_orderdate
              ELSE o_orderdate + INTERVAL 1 DAY END AS paid_at
  FROM orders
),
order_change AS (
  SELECT k, 0 AS n, CASE WHEN k % 7 = 0 THEN 'r' ELSE 'c' END AS op, d AS changed_at,
         c AS who, 'pending' AS status, total, d FROM order_base
  UNION ALL
  SELECT k, 1, 'u', paid_at, c, 'paid', total, d FROM order_base
  UNION ALL
  SELECT k, 2, 'u', d + INTERVAL 2 DAY, CASE WHEN k % 13 <> 0 THEN c END, 'delivered', total, d
  FROM order_base WHERE f
  UNION ALL
  SELECT k, 3, 'd', d + INTERVAL 3 DAY, CASE WHEN NOT (f AND k % 13 = 0) THEN c END,
         CASE WHEN f THEN 'delivered' ELSE 'paid' END, total, d
  FROM order_base WHERE k % 10 = 0
),
order_typed AS (
  SELECT k AS order_id, who AS customer_id, status, 'USD' AS currency,
         CAST(total AS DOUBLE) AS total_amount, d AS created_at, changed_at AS updated_at,
         op, changed_at, k * 8 + n AS kafka_offset, CAST(k % 4 AS INTEGER) AS kafka_partition
  FROM order_change
),
order_current AS (
  SELECT order_id, customer_id, status, currency, total_amount, created_at, updated_at,
         op, changed_at
  FROM (SELECT *, row_number() OVER (PARTITION BY order_id
                                     ORDER BY changed_at DESC, kafka_offset DESC) AS rn
        FROM order_typed)
  WHERE rn = 1 AND op <> 'd'
)"""

PRODUCT_CHANGES = f"""{PRODUCT},
product_base AS (
  SELECT *, product_id AS p, CAST(round(unit_price * 100) AS BIGINT) AS cents,
         TIMESTAMP '1997-01-01 00:00:00' + to_days(CAST(product_id % 365 AS INTEGER)) AS t1,
         TIMESTAMP '1999-01-01 00:00:00' + to_days(CAST(product_id % 200 AS INTEGER)) AS t3
  FROM product
),
product_change AS (
  SELECT p, 0 AS n, 'c' AS op, TIMESTAMP '1995-01-01 00:00:00' AS t, cents * 10 // 10 AS price
  FROM product_base
  UNION ALL SELECT p, 1, 'u', t1, cents * 11 // 10 FROM product_base
  UNION ALL SELECT p, 2, 'u', t1 + INTERVAL 30 DAY, cents * 11 // 10 FROM product_base
  UNION ALL SELECT p, 3, 'u', t3, cents * 12 // 10 FROM product_base WHERE p % 3 = 0
  UNION ALL SELECT p, 4, 'u', t3, cents * 13 // 10 FROM product_base WHERE p % 6 = 0
  UNION ALL SELECT p, 5, 'd', TIMESTAMP '2000-06-01 00:00:00', cents * 11 // 10
  FROM product_base WHERE p % 50 = 0
),
product_settled AS (
  SELECT p, t, op, price FROM (
    SELECT *, row_number() OVER (PARTITION BY p, t ORDER BY n DESC) AS rn FROM product_change)
  WHERE rn = 1
),
product_moved AS (
  SELECT * FROM (
    SELECT *, lag(price) OVER w AS price_before, lag(op) OVER w AS op_before
    FROM product_settled WINDOW w AS (PARTITION BY p ORDER BY t))
  WHERE op_before IS NULL OR op = 'd' OR op_before = 'd' OR price <> price_before
),
product_version AS (
  SELECT * FROM (
    SELECT p, op, price, t AS valid_from, lead(t) OVER (PARTITION BY p ORDER BY t) AS valid_to
    FROM product_moved)
  WHERE op <> 'd'
)"""

CUSTOMER_CHANGES = """
customer_change AS (
  SELECT c_custkey AS c, 0 AS n, 'c' AS op, TIMESTAMP '1995-01-01 00:00:00' AS t,
         c_nationkey AS country FROM customer
  UNION ALL
  SELECT c_custkey, 1, 'u',
         TIMESTAMP '1997-01-01 00:00:00' + to_days(CAST(c_custkey % 300 AS INTEGER)),
         (c_nationkey + 1) % 25 FROM customer WHERE c_custkey % 4 = 0
  UNION ALL
  SELECT c_custkey, 2, 'u',
         TIMESTAMP '1997-01-11 00:00:00' + to_days(CAST(c_custkey % 300 AS INTEGER)),
         (c_nationkey + 1) % 25 FROM customer WHERE c_custkey % 8 = 0
  UNION ALL
  SELECT c_custkey, 3, 'd', TIMESTAMP '2000-01-01 00:00:00',
         CASE WHEN c_custkey % 4 = 0 THEN (c_nationkey + 1) % 25 ELSE c_nationkey END
  FROM customer WHERE c_custkey % 9 = 0
),
customer_full AS (
  SELECT c AS customer_id, n, op, t, lpad(CAST(country AS VARCHAR), 2, '0') AS country_code,
         lower(replace(c_name, '#', '.')) || '@example.com' AS email,
         c_name AS full_name, c_acctbal > 5000 AS marketing_opt_in
  FROM customer_change JOIN customer ON c = c_custkey
)"""

CLICKS = """
click AS (
  SELECT event_id AS i, user_id AS u, copy,
         ['page_view', 'product_view', 'add_to_cart', 'begin_checkout', 'purchase'][
           list_position(['error', 'view', 'click', 'signup', 'purchase'], event_type)] AS event_type,
         date_trunc('milliseconds', ts - to_seconds(
           CASE WHEN event_id % 50 = 3 THEN 60 + event_id % 240 ELSE 0 END)) AS event_ts,
         CASE WHEN event_id % 90 <> 5 THEN user_id || '-' || strftime(ts, '%d') END AS session_id,
         CASE WHEN user_id % 3 <> 0 THEN user_id END AS customer_id,
         json_extract_string(props, '$.k') AS product_id,
         CASE WHEN event_type = 'purchase' AND event_id % 30 <> 3
              THEN CAST(event_id * 2 AS VARCHAR) END AS order_id,
         CASE WHEN event_type = 'purchase' THEN value END AS order_value,
         CAST(user_id % 3 AS INTEGER) AS kafka_partition,
         event_id * 2 + copy AS kafka_offset,
         ts + to_seconds(1 + 60 * copy) AS kafka_ts,
         copy = 0 AND event_id % 50 = 7 AS damaged
  FROM events CROSS JOIN (SELECT unnest([0, 1]) AS copy)
  WHERE copy = 0 OR event_id % 50 = 0 OR event_id % 600 = 7
),
bronze AS (SELECT *, CAST(i AS VARCHAR) AS event_id FROM click WHERE NOT damaged),
silver AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY i ORDER BY kafka_ts, kafka_offset) AS rn FROM bronze)
  WHERE rn = 1
),
dead AS (SELECT * FROM click WHERE damaged)"""

KPI_COLUMNS = """
  date_trunc('minute', event_ts) AS window_start,
  date_trunc('minute', event_ts) + INTERVAL 1 MINUTE AS window_end,
  CAST(count(*) AS BIGINT) AS events,
  CAST(count(DISTINCT session_id) AS BIGINT) AS sessions,
  CAST(count(*) FILTER (event_type = 'purchase') AS BIGINT) AS purchases,
  CAST(coalesce(sum(CAST(order_value AS DECIMAL(18,2))), 0) AS DOUBLE) AS revenue"""

READABLE = """
  event_id, event_type, event_ts, session_id, customer_id,
  ['mobile', 'desktop', 'tablet'][1 + u % 3] AS device_type,
  ['android', 'linux', 'ios'][1 + u % 3] AS device_os,
  ['firefox', 'chrome'][1 + u % 2] AS device_browser,
  '/item/' || product_id AS page_url,
  CASE WHEN i % 2 = 1 THEN '/home' END AS referrer,
  product_id, order_id, order_value"""

VIOLATIONS = f"""{CLICKS},{ORDER_CHANGES},
unmatched AS (
  SELECT event_id, order_id FROM silver
  WHERE event_type = 'purchase' AND event_ts < TIMESTAMP '2024-01-20 00:00:00' - INTERVAL 10 MINUTE
    AND (order_id IS NULL OR CAST(order_id AS BIGINT) NOT IN (SELECT o_orderkey FROM orders))
)"""


def _with(*parts: str) -> str:
    return "WITH " + ",".join(parts) + "\n"


def _labelled(column: str, rows: dict[str, str]) -> str:
    return "\nUNION ALL ".join(
        f"SELECT '{label}' AS {column}, CAST(count(*) AS BIGINT) AS rows FROM {source}"
        for label, source in rows.items()
    )


def _check(name: str, source: str, key: str) -> str:
    return (
        f"SELECT '{name}' AS \"check\", CAST(count(*) AS BIGINT) AS violations, "
        f"min(CAST({key} AS VARCHAR)) AS sample FROM {source}"
    )


_STG_ORDERS = """
SELECT order_id, customer_id, status AS order_status, currency, total_amount,
       created_at AS order_created_at, updated_at AS order_updated_at
FROM order_new"""
_PRODUCTS = """
SELECT product_id, sku, name AS product_name, category, subcategory,
       unit_price AS current_unit_price, is_active FROM product"""
_CUSTOMERS = """
SELECT customer_id, email, full_name, country_code, marketing_opt_in,
       created_at AS customer_created_at FROM customer_row"""
_ORDER_CURRENT = "SELECT * FROM order_current"


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}

    # Staging, dimensions, facts, marts
    q["stg_orders"] = _with(ORDER_SNAP) + _STG_ORDERS
    q["stg_order_items"] = _with(ITEM_NEW) + """
SELECT order_item_id, order_id, product_id, quantity,
       unit_cents / 100.0 AS unit_price_at_purchase FROM item_new"""
    q["stg_products"] = q["dim_product"] = _with(PRODUCT) + _PRODUCTS
    q["stg_customers"] = q["dim_customer"] = _with(CUSTOMER) + _CUSTOMERS
    q["fct_orders"] = _with(FACTS) + """
SELECT order_item_id, order_id, customer_id, product_id, order_status, currency, quantity,
       unit_cents / 100.0 AS unit_price_at_purchase, revenue_cents / 100.0 AS revenue,
       created_at AS order_created_at FROM fact"""
    q["mart_daily_revenue"] = q["mart_daily_revenue_from_facts"] = (
        _with(MART) + "SELECT * FROM mart ORDER BY order_date"
    )
    q["mart_product_performance"] = _with(FACTS) + """
SELECT product_id, units_sold, revenue, orders, revenue / CAST(units_sold AS DOUBLE) AS average_price
FROM (SELECT product_id, CAST(sum(quantity) AS BIGINT) AS units_sold,
             CAST(sum(revenue_cents) AS BIGINT) / 100.0 AS revenue,
             CAST(count(DISTINCT order_id) AS BIGINT) AS orders
      FROM paid_fact GROUP BY product_id)"""
    q["facts_without_customer"] = _with(ORDER_SNAP) + """
SELECT order_id, customer_id, status AS order_status FROM order_new o
WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = o.customer_id AND c_custkey % 9 <> 0)"""
    q["dim_date"] = """
SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, CAST(d AS DATE) AS date,
       CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter,
       CAST(month(d) AS INTEGER) AS month, CAST(day(d) AS INTEGER) AS day,
       CAST(isodow(d) AS INTEGER) AS iso_weekday, CAST(weekofyear(d) AS INTEGER) AS iso_week,
       isodow(d) >= 6 AS is_weekend
FROM (SELECT unnest(generate_series(
        (SELECT date_trunc('day', min(o_orderdate)) FROM orders),
        (SELECT date_trunc('day', max(o_orderdate)) FROM orders), INTERVAL 1 DAY)) AS d)"""

    # Snapshots and extracts
    snapshot = "order_id, customer_id, status, currency, total_amount, created_at, updated_at"
    q["extract_snapshot"] = _with(ORDER_SNAP) + f"""
SELECT {snapshot}, '2001-08-04' AS ds FROM order_snap WHERE ds = '2001-08-01'"""
    q["load_snapshot"] = _with(ORDER_SNAP) + """
SELECT order_id, CASE WHEN ds = '2001-08-02' THEN upper(status) ELSE status END AS status, ds
FROM order_snap"""
    q["latest_snapshot"] = _with(ORDER_SNAP) + f"SELECT {snapshot}, ds FROM order_new"
    q["incremental_extract"] = _with(ORDER_SNAP) + f"""
SELECT {snapshot}, ds FROM order_new WHERE updated_at > TIMESTAMP '2000-06-01 00:00:00'"""
    q["high_water_mark"] = _with(ORDER_SNAP) + """
SELECT max(updated_at) AS high_water_mark FROM order_snap"""
    q["snapshot_retention"] = """
WITH days AS (SELECT DISTINCT strftime(o_orderdate, '%Y-%m-%d') AS ds FROM orders)
SELECT ds, ds >= '2001-07-27' OR dense_rank() OVER (ORDER BY ds DESC) <= 5 AS kept FROM days"""

    # Pulse checks
    q["table_row_counts"] = _labelled("table_name", {
        "customers": "customer", "products": "part", "orders": "orders", "order_items": "lineitem",
    })
    q["silver_row_counts"] = _with(CLICKS, ORDER_CHANGES) + _labelled("table_name", {
        "events": "silver", "orders_current": "order_current", "orders_history": "order_typed",
        "customers_current": "customer WHERE c_custkey % 9 <> 0",
        "products_current": "part WHERE p_partkey % 50 <> 0",
    })
    q["raw_rows_by_table"] = _with(ORDER_SNAP) + """
SELECT 'orders' AS table_name, ds, CAST(count(*) AS BIGINT) AS rows FROM order_snap GROUP BY ds
UNION ALL SELECT 'order_items', '2001-08-02', count(*) FROM lineitem
  WHERE l_shipdate < TIMESTAMP '2000-01-01 00:00:00'
UNION ALL SELECT 'order_items', '2001-08-03', count(*) FROM lineitem
UNION ALL SELECT 'products', '2001-08-03', count(*) FROM part
UNION ALL SELECT 'customers', '2001-08-03', count(*) FROM customer"""
    q["mart_row_counts"] = _with(MART) + _labelled("table_name", {
        "fct_orders": "fact", "dim_product": "part", "dim_customer": "customer",
        "mart_daily_revenue": "mart",
    })
    q["orders_by_status"] = _with(ORDER_SNAP) + """
SELECT status AS order_status, CAST(count(*) AS BIGINT) AS orders,
       CAST(sum(CAST(total_amount AS DECIMAL(18,2))) AS DOUBLE) AS amount
FROM order_new GROUP BY status"""
    q["last_orders"] = _with(ORDER_SNAP) + """
SELECT order_id, customer_id, status AS order_status, total_amount,
       date_trunc('second', created_at + INTERVAL 500 MILLISECOND) AS created_at
FROM order_new ORDER BY order_id DESC LIMIT 5"""
    q["last_days_revenue"] = _with(MART) + "SELECT * FROM mart ORDER BY order_date DESC LIMIT 7"
    q["revenue_by_category"] = _with(FACTS) + """
SELECT p_type AS category, CAST(count(DISTINCT order_id) AS BIGINT) AS orders,
       CAST(sum(revenue_cents) AS BIGINT) / 100.0 AS revenue
FROM paid_fact JOIN part ON product_id = p_partkey GROUP BY p_type"""
    q["trap_counts"] = _with(ORDER_SNAP) + _labelled("trap", {
        "price changed since creation": "part WHERE p_partkey % 4 = 0",
        "order without customer": "order_new WHERE customer_id IS NULL",
    })
    q["table_freshness"] = _with(CLICKS) + """
SELECT table_name, newest,
       (epoch_us(TIMESTAMP '2024-01-31 00:00:00') - epoch_us(newest)) / 1000000.0 AS age_seconds
FROM (SELECT 'events' AS table_name, max(event_ts) AS newest FROM bronze
      UNION ALL SELECT 'orders', max(o_orderdate) FROM orders)"""
    q["stalled_minutes"] = _with(CLICKS) + """
SELECT slot_start FROM (
  SELECT unnest(generate_series(
    (SELECT time_bucket(INTERVAL 5 MINUTE, min(kafka_ts)) FROM bronze),
    TIMESTAMP '2024-01-31 06:00:00' - INTERVAL 5 MINUTE,
    INTERVAL 5 MINUTE)) AS slot_start)
WHERE slot_start NOT IN (SELECT time_bucket(INTERVAL 5 MINUTE, kafka_ts) FROM bronze)"""
    q["dlq_rate"] = _with(CLICKS) + """
SELECT time_bucket(INTERVAL 10 MINUTE, kafka_ts) AS slot_start,
       CAST(count(*) AS BIGINT) AS rows, round(count(*) / 600.0, 6) AS per_second
FROM dead GROUP BY 1 HAVING count(*) / 600.0 > 0.001"""
    q["offset_lag"] = _with(CLICKS) + """
SELECT 'events.v1' AS topic, CAST(sum(head - coalesce(landed, first - 1)) AS BIGINT) AS lag,
       sum(head - coalesce(landed, first - 1)) > 100 AS too_high
FROM (SELECT kafka_partition, max(kafka_offset) AS head, min(kafka_offset) AS first,
             max(kafka_offset) FILTER (kafka_ts < TIMESTAMP '2024-01-29 00:00:00') AS landed
      FROM click GROUP BY kafka_partition)"""

    # Scalar functions and the catalog seed
    q["catalog_grid"] = """
WITH grid AS (
  SELECT DISTINCT p_type AS category, p_brand AS subcategory, label
  FROM part CROSS JOIN (SELECT unnest(['Amber','Birch','Cobalt','Dune','Elm','Flint']) AS label)
),
numbered AS (
  SELECT *, row_number() OVER (ORDER BY category, subcategory, label) AS number FROM grid
)
SELECT *, upper(left(category, 3)) || '-' || upper(left(label, 3)) || '-' ||
          CASE WHEN number < 10000 THEN lpad(CAST(number AS VARCHAR), 4, '0')
               ELSE CAST(number AS VARCHAR) END AS sku
FROM numbered"""
    q["scalar_catalog"] = """
SELECT p_partkey AS product_id,
       upper(left(p_type, 3)) || '-' || upper(left(p_brand, 3)) || '-' ||
         CASE WHEN p_partkey < 10000 THEN lpad(CAST(p_partkey AS VARCHAR), 4, '0')
              ELSE CAST(p_partkey AS VARCHAR) END AS sku,
       upper(left(p_type, 1)) || lower(substring(p_type, 2)) || ' ' || p_name AS name,
       round(p_retailprice, 1) AS price_rounded,
       CAST(floor(p_retailprice) AS BIGINT) AS price_floor,
       [5, 10, 15][1 + p_partkey % 3] AS bonus,
       coalesce(TRY_CAST('12x' AS BIGINT), p_partkey) AS cast_fallback
FROM part"""
    q["date_functions"] = """
SELECT event_id, CAST(ts AS DATE) AS day, strftime(ts, '%Y-%m-%d') AS ds,
       date_trunc('second', ts + INTERVAL 500 MILLISECOND) AS nearest_second,
       date_trunc('milliseconds', ts) AS from_millis,
       ts - INTERVAL 10 MINUTE AS ten_minutes_before,
       date_trunc('minute', ts) AS minute_start,
       date_trunc('minute', ts) + INTERVAL 1 MINUTE AS minute_end
FROM events"""

    # Change feed
    def image(status: str, who: str) -> str:
        fields = [
            ("order_id", "'\"' || k || '\"'"),
            ("customer_id", f"coalesce('\"' || {who} || '\"', 'null')"),
            ("status", f"'\"' || {status} || '\"'"),
            ("currency", "'\"USD\"'"),
            ("total_amount", "'\"' || CAST(CAST(total AS DECIMAL(12,2)) AS VARCHAR) || '\"'"),
            ("created_at", "'\"' || strftime(d, '%Y-%m-%dT%H:%M:%S.%fZ') || '\"'"),
            ("updated_at", "'\"' || strftime(changed_at, '%Y-%m-%dT%H:%M:%S.%fZ') || '\"'"),
        ]
        return "'{' || " + " || ',' || ".join(f"'\"{c}\":' || {v}" for c, v in fields) + " || '}'"

    q["cdc_raw"] = _with(ORDER_CHANGES) + f"""
, told AS (
  SELECT *, CASE n WHEN 1 THEN 'pending' WHEN 2 THEN 'paid' ELSE status END AS old_status,
         CASE WHEN n = 3 THEN who ELSE first_value(who) OVER (PARTITION BY k ORDER BY n) END AS old_who
  FROM order_change
),
written AS (
  SELECT k, n, changed_at,
         '{{"before":' || CASE WHEN op IN ('u', 'd') THEN {image("old_status", "old_who")} ELSE 'null' END ||
         ',"after":' || CASE WHEN op <> 'd' THEN {image("status", "who")} ELSE 'null' END ||
         ',"op":"' || op || '","ts_ms":' || epoch_ms(changed_at) || '}}' AS value
  FROM told
  UNION ALL SELECT k, 4, changed_at, NULL FROM told WHERE n = 3
),
sent AS (
  SELECT * FROM written UNION ALL SELECT * FROM written WHERE n = 1 AND k % 19 = 0
)
SELECT 'cdc.store.public.orders' AS topic, CAST(k AS VARCHAR) AS key, value,
       CAST(k % 4 AS INTEGER) AS kafka_partition, k * 8 + n AS kafka_offset,
       changed_at AS kafka_ts, changed_at AS ingested_at FROM sent"""
    q["cdc_history"] = _with(ORDER_CHANGES) + "SELECT * FROM order_typed"
    q["cdc_current"] = q["incremental_merge"] = q["merge_replayed"] = _with(ORDER_CHANGES) + _ORDER_CURRENT
    q["customers_current"] = _with(CUSTOMER_CHANGES) + """
SELECT customer_id, email, full_name, country_code, marketing_opt_in,
       TIMESTAMP '1995-01-01 00:00:00' AS created_at, t AS updated_at, op, t AS changed_at
FROM (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY n DESC) AS rn FROM customer_full)
WHERE rn = 1 AND op <> 'd'"""
    q["products_current"] = _with(PRODUCT_CHANGES) + """
SELECT product_id, sku, name, category, subcategory, price / 100.0 AS unit_price, is_active,
       TIMESTAMP '1995-01-01 00:00:00' AS created_at, t AS updated_at, op, t AS changed_at
FROM (SELECT *, row_number() OVER (PARTITION BY p ORDER BY t DESC, n DESC) AS rn FROM product_change)
JOIN product ON p = product_id WHERE rn = 1 AND op <> 'd'"""
    q["state_as_of"] = _with(ORDER_CHANGES) + """
SELECT order_id, customer_id, status, currency, total_amount, created_at, updated_at, op, changed_at
FROM (SELECT *, row_number() OVER (PARTITION BY order_id
                                   ORDER BY changed_at DESC, kafka_offset DESC) AS rn
      FROM order_typed WHERE changed_at <= TIMESTAMP '1998-06-01 00:00:00')
WHERE rn = 1 AND op <> 'd'"""
    q["order_lifecycle"] = _with(ORDER_CHANGES) + """
SELECT order_id, status, op, changed_at, kafka_offset,
       lead(changed_at) OVER w AS next_changed_at,
       (epoch_us(lead(changed_at) OVER w) - epoch_us(changed_at)) / 1000000.0 AS seconds_in_state
FROM order_typed WINDOW w AS (PARTITION BY order_id ORDER BY changed_at, kafka_offset)"""
    q["dim_product_scd2"] = _with(PRODUCT_CHANGES) + """
SELECT product_id, sku, name, category, subcategory, price / 100.0 AS unit_price, is_active,
       valid_from, valid_to, valid_to IS NULL AS is_current
FROM product_version JOIN product ON p = product_id"""
    q["dim_customer_scd2"] = _with(CUSTOMER_CHANGES) + """
, moved AS (
  SELECT * FROM (
    SELECT *, lag(country_code) OVER w AS before, lag(op) OVER w AS op_before
    FROM customer_full WINDOW w AS (PARTITION BY customer_id ORDER BY t))
  WHERE op_before IS NULL OR op = 'd' OR op_before = 'd' OR country_code <> before
)
SELECT customer_id, email, full_name, country_code, marketing_opt_in, valid_from, valid_to,
       valid_to IS NULL AS is_current
FROM (SELECT *, t AS valid_from, lead(t) OVER (PARTITION BY customer_id ORDER BY t) AS valid_to
      FROM moved)
WHERE op <> 'd'"""
    q["scd2_asof_join"] = _with(FACTS, PRODUCT_CHANGES) + """
SELECT order_item_id, f.product_id, quantity, created_at AS order_created_at,
       price / 100.0 AS unit_price
FROM fact f LEFT JOIN product_version v
  ON f.product_id = v.p AND created_at >= valid_from
 AND (valid_to IS NULL OR created_at < valid_to)"""
    q["stale_status"] = _with(ORDER_SNAP, ORDER_CHANGES) + """
SELECT order_id, s.status AS snapshot_value, c.status AS current_value
FROM order_new s JOIN order_current c USING (order_id) WHERE s.status IS DISTINCT FROM c.status"""
    q["mask_pii"] = _with(CUSTOMER) + """
SELECT customer_id, sha256('pepper-1:' || email) AS email, left(full_name, 1) || '.' AS full_name,
       country_code FROM customer_row"""
    q["schema_drift"] = _with(ORDER_CHANGES) + """
, repeated AS (
  SELECT k, op FROM order_change WHERE op <> 'd'
  UNION ALL SELECT k, op FROM order_change WHERE n = 1 AND k % 19 = 0
)
SELECT 'channel' AS field, CAST(count(*) AS BIGINT) AS records FROM repeated
WHERE k % 97 = 0 OR k % 101 = 0
UNION ALL SELECT 'loyalty', count(*) FROM repeated WHERE k % 101 = 0 AND k % 97 <> 0"""

    # Clicks: wire, bronze, silver
    q["wire_split_counts"] = _with(CLICKS) + """
SELECT NOT damaged AS is_valid, CAST(count(*) AS BIGINT) AS records FROM click GROUP BY 1"""
    q["bronze_events"] = _with(CLICKS) + f"""
SELECT {READABLE}, kafka_partition, kafka_offset, kafka_ts FROM bronze"""
    q["silver_events"] = q["silver_increment"] = _with(CLICKS) + f"SELECT {READABLE} FROM silver"
    q["duplicate_rate"] = _with(CLICKS) + """
SELECT CAST(count(*) AS BIGINT) AS bronze_rows, CAST(count(DISTINCT i) AS BIGINT) AS silver_rows,
       CAST(count(*) - count(DISTINCT i) AS BIGINT) AS duplicates FROM bronze"""

    # Quality
    q["gate_duplicate_keys"] = _with(CLICKS) + """
SELECT event_id, CAST(count(*) AS BIGINT) AS rows FROM bronze GROUP BY 1 HAVING count(*) > 1"""
    q["gate_null_keys"] = _with(CLICKS) + """
SELECT event_id, event_ts, session_id FROM silver
WHERE event_id IS NULL OR event_ts IS NULL OR session_id IS NULL"""
    q["gate_purchase_without_order"] = _with(CLICKS) + """
SELECT event_id, event_ts FROM silver WHERE event_type = 'purchase' AND order_id IS NULL"""
    q["gate_negative_totals"] = _with(ORDER_CHANGES) + """
SELECT order_id, total_amount FROM order_current WHERE total_amount < 0"""
    q["gate_unmatched_purchases"] = _with(VIOLATIONS) + "SELECT * FROM unmatched"
    q["test_unique"] = """
SELECT l_orderkey || '-' || l_linenumber AS line, CAST(count(*) AS BIGINT) AS rows
FROM lineitem GROUP BY 1 HAVING count(*) > 1"""
    q["test_not_null"] = _with(ORDER_SNAP) + """
SELECT order_id FROM order_new WHERE customer_id IS NULL"""
    q["test_accepted_values"] = """
SELECT 'returned' AS order_status, CAST(count(*) AS BIGINT) AS rows
FROM orders WHERE o_orderkey % 700 = 2 HAVING count(*) > 0"""
    q["quality_report"] = _with(VIOLATIONS) + "\nUNION ALL ".join([
        _check("duplicate event ids", "(SELECT i FROM silver GROUP BY i HAVING count(*) > 1)", "i"),
        _check("null event keys", "silver WHERE session_id IS NULL", "event_id"),
        _check("purchase without order id",
               "silver WHERE event_type = 'purchase' AND order_id IS NULL", "event_id"),
        _check("negative order totals", "order_current WHERE total_amount < 0", "order_id"),
        _check("purchase without matching order", "unmatched", "event_id"),
    ])
    checks = [
        ("unique fct_orders.order_item_id",
         "(SELECT order_item_id FROM fact GROUP BY 1 HAVING count(*) > 1)", "order_item_id"),
    ]
    checks += [
        (f"not null fct_orders.{c}", f"fact WHERE {c} IS NULL", "order_item_id")
        for c in ("order_item_id", "order_id", "product_id")
    ]
    checks += [
        ("not null fct_orders.revenue", "fact WHERE revenue_cents IS NULL", "order_item_id"),
        ("unique dim_product.product_id",
         "(SELECT p_partkey FROM part GROUP BY 1 HAVING count(*) > 1)", "p_partkey"),
        ("not null dim_product.product_id", "part WHERE p_partkey IS NULL", "p_partkey"),
        ("unique dim_customer.customer_id",
         "(SELECT c_custkey FROM customer GROUP BY 1 HAVING count(*) > 1)", "c_custkey"),
        ("not null dim_customer.customer_id", "customer WHERE c_custkey IS NULL", "c_custkey"),
        ("unique mart_daily_revenue.order_date",
         "(SELECT order_date FROM mart GROUP BY 1 HAVING count(*) > 1)", "order_date"),
        ("not null mart_daily_revenue.order_date", "mart WHERE order_date IS NULL", "order_date"),
        ("accepted values fct_orders.order_status",
         "fact WHERE order_status NOT IN ('pending', 'paid', 'shipped', 'delivered', 'cancelled')",
         "order_status"),
    ]
    q["gold_quality_report"] = _with(MART) + "\nUNION ALL ".join(_check(*c) for c in checks)

    # Windows, sessions, funnel
    q["kpis_minute"] = _with(CLICKS) + f"SELECT {KPI_COLUMNS} FROM bronze GROUP BY 1, 2"
    q["latest_version_read"] = _with(CLICKS) + f"""
SELECT {KPI_COLUMNS},
       CAST(bool_or(kafka_ts - event_ts > INTERVAL 2 MINUTE) AS INTEGER) AS batch
FROM bronze GROUP BY 1, 2"""
    q["kpis_recent"] = _with(CLICKS) + f"""
SELECT window_start, events, sessions, purchases, revenue
FROM (SELECT {KPI_COLUMNS} FROM bronze GROUP BY 1, 2)
WHERE window_start > TIMESTAMP '2024-01-15 02:00:00'
  AND window_start <= TIMESTAMP '2024-01-15 12:00:00'"""
    q["speed_vs_batch"] = _with(CLICKS) + """
, speed AS (SELECT date_trunc('minute', event_ts) AS window_start, CAST(count(*) AS BIGINT) AS n
            FROM bronze WHERE kafka_ts - event_ts <= INTERVAL 2 MINUTE GROUP BY 1),
batch AS (SELECT date_trunc('minute', event_ts) AS window_start, CAST(count(*) AS BIGINT) AS n
          FROM silver GROUP BY 1)
SELECT window_start, speed.n AS speed_value, batch.n AS batch_value,
       CAST(coalesce(batch.n, 0) - coalesce(speed.n, 0) AS BIGINT) AS missing
FROM speed FULL JOIN batch USING (window_start)"""
    q["session_windows"] = """
WITH marked AS (
  SELECT *, CASE WHEN ts > lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id)
                          + INTERVAL 30 MINUTE THEN 1 ELSE 0 END AS opens FROM events
),
numbered AS (
  SELECT *, sum(opens) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS session_no FROM marked
)
SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL 30 MINUTE AS session_end,
       CAST(count(*) AS BIGINT) AS events
FROM numbered GROUP BY user_id, session_no"""
    q["fct_sessions"] = _with(CLICKS) + """
SELECT session_id, min(event_ts) AS session_start, max(event_ts) AS session_end,
       CAST(count(*) AS BIGINT) AS events,
       CAST(count(*) FILTER (event_type IN ('page_view', 'product_view')) AS BIGINT) AS pages,
       max(customer_id) AS customer_id, bool_or(event_type = 'purchase') AS converted,
       (epoch_us(max(event_ts)) - epoch_us(min(event_ts))) / 1000000.0 AS duration_seconds
FROM silver WHERE session_id IS NOT NULL GROUP BY session_id"""
    q["mart_funnel_conversion"] = _with(CLICKS) + """
, flag AS (
  SELECT session_id, bool_or(event_type = 'product_view') AS a,
         bool_or(event_type = 'add_to_cart') AS b, bool_or(event_type = 'begin_checkout') AS c,
         bool_or(event_type = 'purchase') AS d
  FROM silver WHERE session_id IS NOT NULL GROUP BY session_id
),
n AS (SELECT count(*) FILTER (a) AS n1, count(*) FILTER (a AND b) AS n2,
             count(*) FILTER (a AND b AND c) AS n3, count(*) FILTER (a AND b AND c AND d) AS n4
      FROM flag)
SELECT 1 AS stage_no, 'product_view' AS stage, CAST(n1 AS BIGINT) AS sessions,
       CASE WHEN n1 > 0 THEN 1.0 END AS rate_from_previous, CASE WHEN n1 > 0 THEN 1.0 END AS rate_from_first
FROM n
UNION ALL SELECT 2, 'add_to_cart', n2, CASE WHEN n1 > 0 THEN round(n2 / n1, 4) END,
       CASE WHEN n1 > 0 THEN round(n2 / n1, 4) END FROM n
UNION ALL SELECT 3, 'begin_checkout', n3, CASE WHEN n2 > 0 THEN round(n3 / n2, 4) END,
       CASE WHEN n1 > 0 THEN round(n3 / n1, 4) END FROM n
UNION ALL SELECT 4, 'purchase', n4, CASE WHEN n3 > 0 THEN round(n4 / n3, 4) END,
       CASE WHEN n1 > 0 THEN round(n4 / n1, 4) END FROM n"""
    q["top_products_per_window"] = """
WITH totals AS (
  SELECT date_trunc('month', l_shipdate) AS month, l_partkey AS product_id,
         CAST(sum(l_quantity) AS BIGINT) AS units,
         CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue
  FROM lineitem GROUP BY 1, 2
)
SELECT CAST(month AS TIMESTAMP) AS month, product_id, units, revenue FROM (
  SELECT *, row_number() OVER (PARTITION BY month ORDER BY revenue DESC, product_id) AS rn FROM totals)
WHERE rn <= 3"""
    q["fct_events"] = _with(CLICKS, PRODUCT_CHANGES) + f"""
, customer_version AS ({q["dim_customer_scd2"]})
SELECT event_id, event_type, event_ts, session_id, s.customer_id,
       CAST(strftime(event_ts, '%Y%m%d') AS INTEGER) AS date_key,
       CAST(s.product_id AS BIGINT) AS product_id, v.valid_from AS product_valid_from,
       c.valid_from AS customer_valid_from
FROM silver s LEFT JOIN product_version v
  ON CAST(s.product_id AS BIGINT) = v.p AND event_ts >= v.valid_from
 AND (v.valid_to IS NULL OR event_ts < v.valid_to)
LEFT JOIN customer_version c
  ON s.customer_id = c.customer_id AND event_ts >= c.valid_from
 AND (c.valid_to IS NULL OR event_ts < c.valid_to)"""

    # Dead letters
    q["dlq_archive"] = _with(CLICKS) + """
SELECT CAST(u AS VARCHAR) AS key,
       CASE i % 200 WHEN 7 THEN '7B' WHEN 57 THEN NULL ELSE '00' END AS first_byte,
       kafka_partition, kafka_offset, kafka_ts FROM dead"""
    q["dlq_replay_report"] = _with(CLICKS) + """
SELECT CASE WHEN i % 200 <> 7 THEN 'still bad' WHEN i % 600 = 7 THEN 'already landed'
            ELSE 'recovered' END AS outcome, CAST(count(*) AS BIGINT) AS records
FROM dead GROUP BY 1"""
    for name in ("order_lifecycle", "dim_product_scd2", "scd2_asof_join"):
        q[f"{name}_sliced"] = q[name]
    for name in ("dim_product_scd2", "dim_customer_scd2", "session_windows", "fct_sessions", "mart_daily_revenue"):
        q[f"{name}_increments"] = q[name]
    q["increment_by_offsets"] = f"""
SELECT kafka_partition, kafka_offset, kafka_ts FROM ({q["cdc_raw"]}) WHERE kafka_offset >= 20500"""
    return q
