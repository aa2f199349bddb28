"""SQL that gives, on the supplied test tables, what each query must give.

Written from the definitions and not from the Spark plans: marts that join
facts of different grain form the joined rows here, for example.
"""

from __future__ import annotations

import re

from millrace.suite.views import SECOND_LOAD

FIRST_LOAD = "1900-01-01 00:00:00"

# Named subqueries; each may use the ones above it.
VIEWS: dict[str, str] = {}
ORACLES: dict[str, str] = {}


def view(name: str, sql: str) -> None:
    VIEWS[name] = sql.strip()


def oracle(name: str, sql: str) -> None:
    """Register, with the named subqueries that the text needs put in front."""
    sql = sql.strip()
    needed: set[str] = set()
    pending = [sql]
    while pending:
        words = set(re.findall(r"[a-z_0-9]+", pending.pop()))
        for found in (words & VIEWS.keys()) - needed:
            needed.add(found)
            pending.append(VIEWS[found])
    parts = ", ".join(f"{v} AS ({text})" for v, text in VIEWS.items() if v in needed)
    ORACLES[name] = f"WITH {parts} {sql}" if parts else sql


# --- source entities ---

view("places", "SELECT n_nationkey, n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey")

view("src_customers", """
SELECT CAST(c_custkey AS VARCHAR) AS customer_id, c_name AS customer_unique_id,
  CAST(c_nationkey AS VARCHAR) AS customer_zip_code_prefix,
  CASE WHEN c_custkey % 50 <> 0 THEN '  ' || n_name || ' ' END AS customer_city,
  CASE WHEN c_custkey % 75 <> 0 THEN lower(r_name) END AS customer_state
FROM customer JOIN places ON c_nationkey = n_nationkey
""")
view("nxt_customers", """
SELECT CAST(c_custkey AS VARCHAR) AS customer_id, c_name AS customer_unique_id,
  CASE WHEN c_custkey % 7 <> 0 THEN CAST((c_nationkey
    + CASE WHEN c_custkey % 10 = 0 THEN 1 ELSE 0 END) % 25 AS VARCHAR) END AS customer_zip_code_prefix,
  n_name AS customer_city, r_name AS customer_state
FROM customer JOIN places ON c_nationkey = n_nationkey WHERE c_mktsegment <> 'MACHINERY'
UNION ALL
SELECT 'N' || CAST(c_custkey AS VARCHAR), c_name,
  CASE WHEN c_custkey % 7 <> 0 THEN CAST((c_nationkey
    + CASE WHEN c_custkey % 10 = 0 THEN 1 ELSE 0 END) % 25 AS VARCHAR) END,
  n_name, r_name
FROM customer JOIN places ON c_nationkey = n_nationkey WHERE c_mktsegment = 'BUILDING'
""")
for prefix in ("src", "nxt"):
    view(f"{prefix}_customers_clean", f"""
SELECT trim(customer_id) AS customer_id, trim(customer_unique_id) AS customer_unique_id,
  lpad(trim(customer_zip_code_prefix), 5, '0') AS customer_zip_code_prefix,
  coalesce(lower(trim(customer_city)), 'unknown') AS customer_city,
  coalesce(upper(trim(customer_state)), 'UN') AS customer_state
FROM {prefix}_customers
""")

view("src_sellers", """
SELECT CAST(s_suppkey AS VARCHAR) AS seller_id, CAST(s_nationkey AS VARCHAR) AS seller_zip_code_prefix,
  CASE WHEN s_suppkey % 20 <> 0 THEN ' ' || n_name || '  ' END AS seller_city,
  CASE WHEN s_suppkey % 30 <> 0 THEN lower(r_name) END AS seller_state
FROM supplier JOIN places ON s_nationkey = n_nationkey
""")
view("nxt_sellers", """
SELECT CAST(s_suppkey AS VARCHAR) AS seller_id,
  CAST((s_nationkey + CASE WHEN s_suppkey % 4 = 0 THEN 1 ELSE 0 END) % 25 AS VARCHAR)
    AS seller_zip_code_prefix,
  n_name AS seller_city, r_name AS seller_state
FROM supplier JOIN places ON s_nationkey = n_nationkey
""")
for prefix in ("src", "nxt"):
    view(f"{prefix}_sellers_clean", f"""
SELECT trim(seller_id) AS seller_id, lpad(trim(seller_zip_code_prefix), 5, '0') AS seller_zip_code_prefix,
  coalesce(lower(trim(seller_city)), 'unknown') AS seller_city,
  coalesce(upper(trim(seller_state)), 'UN') AS seller_state
FROM {prefix}_sellers
""")

for prefix, weight in (
    ("src", "p_size"),
    ("nxt", "p_size + CASE WHEN p_partkey % 10 = 0 THEN 1 ELSE 0 END"),
):
    view(f"{prefix}_products_clean", f"""
SELECT CAST(p_partkey AS VARCHAR) AS product_id, trim(' ' || p_type) AS product_category_name,
  CAST(length(p_name) AS DOUBLE) AS product_name_lenght,
  CAST(length(p_brand) AS DOUBLE) AS product_description_lenght,
  CASE WHEN p_partkey % 60 <> 0 THEN CAST(p_partkey % 6 AS INTEGER) END AS product_photos_qty,
  CAST({weight} AS DOUBLE) AS product_weight_g,
  CASE WHEN p_partkey % 40 <> 0 THEN CAST(p_size AS DOUBLE) END AS product_length_cm,
  CAST(CAST(p_retailprice AS DECIMAL(10,2)) AS DOUBLE) AS product_height_cm,
  CAST(p_size * 2 AS DOUBLE) AS product_width_cm
FROM part
""")

view("translation_clean", """
SELECT DISTINCT trim(' ' || p_type) AS product_category_name,
  trim(lower(p_type) || '  ') AS product_category_name_english
FROM part
""")

view("geolocation_clean", """
SELECT lpad(CAST(n_nationkey AS VARCHAR), 5, '0') AS geolocation_zip_code_prefix,
  CAST(n_nationkey * 3 - 40 + side AS DOUBLE) AS geolocation_lat,
  CAST(n_nationkey * 5 - 90 - side AS DOUBLE) AS geolocation_lng,
  lower(trim(' ' || n_name)) AS geolocation_city, upper(r_name) AS geolocation_state
FROM places JOIN (
  SELECT DISTINCT c_nationkey AS k, 0.25 AS side FROM customer
  UNION ALL SELECT DISTINCT s_nationkey, 0.5 FROM supplier) sides ON n_nationkey = k
""")

view("src_orders", """
SELECT CAST(o_orderkey AS VARCHAR) AS order_id, CAST(o_custkey AS VARCHAR) AS customer_id,
  CASE o_orderstatus WHEN 'F' THEN ' Delivered' WHEN 'P' THEN 'CANCELED' ELSE 'created ' END AS order_status,
  o_orderdate AS order_purchase_timestamp,
  CASE WHEN o_orderstatus <> 'P' THEN o_orderdate + to_days(1) END AS order_approved_at,
  CASE WHEN o_orderstatus = 'F' THEN o_orderdate + to_days(CAST(2 + o_orderkey % 5 AS INTEGER)) END
    AS order_delivered_carrier_date,
  CASE WHEN o_orderstatus = 'F' THEN o_orderdate + to_days(CAST(4 + o_orderkey % 29 AS INTEGER)) END
    AS order_delivered_customer_date,
  o_orderdate + to_days(CAST(15 + o_custkey % 10 AS INTEGER)) AS order_estimated_delivery_date
FROM orders
""")
view("orders_clean", """
SELECT order_id, customer_id, lower(trim(order_status)) AS order_status, order_purchase_timestamp,
  order_approved_at, order_delivered_carrier_date, order_delivered_customer_date,
  order_estimated_delivery_date
FROM src_orders
""")

view("items_clean", """
SELECT CAST(l_orderkey AS VARCHAR) AS order_id, l_linenumber AS order_item_id,
  CAST(l_partkey AS VARCHAR) AS product_id, CAST(l_suppkey AS VARCHAR) AS seller_id,
  l_shipdate AS shipping_limit_date, CAST(l_extendedprice AS DECIMAL(12,2)) AS price,
  CAST(round(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_tax AS DECIMAL(4,2)), 2) AS DECIMAL(12,2))
    AS freight_value
FROM lineitem
""")
view("feed_items_clean", """
SELECT order_id, CAST(order_item_id AS VARCHAR) AS order_item_id, product_id, seller_id,
  shipping_limit_date,
  CASE WHEN CAST(product_id AS BIGINT) % 50 = 0 THEN 0 ELSE price END AS price,
  CASE WHEN CAST(seller_id AS BIGINT) % 25 = 0 THEN 0 ELSE freight_value END AS freight_value
FROM items_clean
""")

view("payments_raw", """
SELECT concat_ws('-', l_orderkey, l_partkey, l_suppkey, l_linenumber) AS id,
  CAST(l_orderkey AS VARCHAR) AS order_id, l_linenumber AS payment_sequential,
  CASE l_returnflag WHEN 'R' THEN 'Voucher' WHEN 'A' THEN ' boleto' ELSE 'Credit_Card' END AS payment_type,
  CASE WHEN l_partkey % 40 <> 0 THEN 1 + l_partkey % 12 END AS payment_installments,
  CASE WHEN l_suppkey % 30 <> 0 THEN CAST(round(CAST(l_extendedprice AS DECIMAL(12,2))
    * (1 - CAST(l_discount AS DECIMAL(4,2))), 2) AS DECIMAL(12,2)) END AS payment_value,
  l_shipdate AS last_modified_date
FROM lineitem
""")
view("payments_clean", """
SELECT id, order_id, payment_sequential, lower(trim(payment_type)) AS payment_type,
  CAST(coalesce(payment_installments, 1) AS INTEGER) AS payment_installments,
  CAST(coalesce(payment_value, 0) AS DECIMAL(12,2)) AS payment_value, last_modified_date
FROM payments_raw
""")

view("reviews_shift", """
SELECT *, CAST(CASE WHEN event_id % 97 = 0 THEN -10000 WHEN event_id % 89 = 0 THEN 10000
  ELSE -(event_id % 8000) END AS INTEGER) AS shift FROM events
""")
view("reviews_raw", """
SELECT 'r' || CAST(event_id AS VARCHAR) AS review_id, CAST(event_id AS VARCHAR) AS order_id,
  CAST(1 + CAST(floor(value) AS BIGINT) % 5 AS INTEGER) AS review_score,
  event_type AS review_comment_title, trim(props) AS review_comment_message,
  ts + to_days(shift) AS review_creation_date,
  CASE WHEN event_id % 3 <> 0 THEN ts + to_days(shift + 2) END AS review_answer_timestamp,
  ts AS last_modified_date
FROM reviews_shift
""")
view("reviews_clean", """
SELECT review_id, order_id, review_score, review_comment_title, review_comment_message,
  CASE WHEN year(review_creation_date) BETWEEN 2000 AND 2050 THEN review_creation_date END
    AS review_creation_date,
  CASE WHEN year(review_answer_timestamp) BETWEEN 2000 AND 2050 THEN review_answer_timestamp END
    AS review_answer_timestamp,
  last_modified_date
FROM reviews_raw
""")

view("user_feed", """
SELECT event_id AS seq, user_id, event_type,
  '{"user_id":' || user_id || ',"event_type":"' || event_type || '"}' AS raw_record,
  CASE event_type WHEN 'error' THEN 'd' WHEN 'signup' THEN 'c' ELSE 'u' END AS op,
  epoch_us(ts) // 1000 AS ts_ms
FROM events
""")
view("user_state", """
SELECT CAST(user_id AS VARCHAR) AS user_id, event_type, op <> 'd' AS is_active,
  ts_ms AS _ts_ms, seq AS _sequence
FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts_ms DESC, seq DESC) AS rn
      FROM user_feed) ranked WHERE rn = 1
""")

# --- ingestion ---

oracle("ingest_csv_clean", "SELECT DISTINCT * FROM src_customers")

_AUDITED = ("customer", "supplier", "part", "orders", "lineitem", "events", "nation", "region")
view("audited", " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in _AUDITED))
oracle("load_audit_counts", """
SELECT * FROM audited UNION ALL SELECT 'TOTAL', CAST(sum(row_count) AS BIGINT) FROM audited
""")

oracle("extract_full_snapshot", "SELECT * FROM src_orders")
oracle("extract_incremental", """
SELECT *, 2024 AS year, 2 AS month, 1 AS day FROM events WHERE ts > TIMESTAMP '2024-01-15 00:00:00'
""")
oracle("watermark_advance", """
SELECT 'order_reviews' AS table_name, CAST(max(ts) AS VARCHAR) AS watermark FROM events
UNION ALL SELECT 'order_payments', CAST(max(l_shipdate) AS VARCHAR) FROM lineitem
""")
oracle("bronze_partitioned_landing", """
SELECT 2024 AS year, month, day, count(*) AS row_count, min(ts) AS oldest, max(ts) AS newest
FROM (SELECT ts, CASE WHEN ts <= TIMESTAMP '2024-01-15 00:00:00' THEN 1 ELSE 2 END AS month,
             CASE WHEN ts <= TIMESTAMP '2024-01-15 00:00:00' THEN 15 ELSE 1 END AS day FROM events) d
GROUP BY month, day
""")

# --- cleaning ---

oracle("clean_trim_all", "SELECT * REPLACE (CAST(review_score AS VARCHAR) AS review_score) FROM reviews_raw")
oracle("clean_customers", "SELECT * FROM src_customers_clean")
oracle("clean_sellers", "SELECT * FROM src_sellers_clean")
oracle("clean_orders", "SELECT * FROM orders_clean")
oracle("clean_order_items", """
SELECT * REPLACE (CAST(price AS DOUBLE) AS price, CAST(freight_value AS DOUBLE) AS freight_value)
FROM feed_items_clean
""")
oracle("clean_order_payments", """
SELECT * REPLACE (CAST(payment_value AS DOUBLE) AS payment_value) FROM payments_clean
""")
oracle("clean_order_reviews", "SELECT * FROM reviews_clean")
oracle("clean_products", "SELECT * FROM src_products_clean")
oracle("clean_geolocation", "SELECT * FROM geolocation_clean")
oracle("clean_category_translation", "SELECT * FROM translation_clean")

# --- one row per key ---

oracle("dedup_latest_full", """
SELECT id, order_id, payment_sequential, payment_type, payment_installments,
  CAST(payment_value AS DOUBLE) AS payment_value, last_modified_date
FROM (SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY last_modified_date DESC, id DESC,
        payment_sequential DESC, payment_type DESC, payment_installments DESC, payment_value DESC) AS rn
      FROM payments_clean) ranked WHERE rn = 1
""")
oracle("dedup_latest_composite", """
SELECT order_id, order_item_id, product_id, seller_id, shipping_limit_date,
  CAST(price AS DOUBLE) AS price, CAST(freight_value AS DOUBLE) AS freight_value
FROM (SELECT *, row_number() OVER (PARTITION BY order_id, order_item_id ORDER BY shipping_limit_date DESC,
        product_id DESC, seller_id DESC, price DESC, freight_value DESC) AS rn
      FROM items_clean) ranked WHERE rn = 1
""")
oracle("dedup_latest_cdc", "SELECT * FROM user_state")
view("first_items", """
SELECT order_id, seller_id, shipping_limit_date
FROM (SELECT *, row_number() OVER (PARTITION BY order_id
        ORDER BY order_item_id, seller_id, shipping_limit_date) AS rn FROM items_clean) ranked
WHERE rn = 1
""")
oracle("dedup_one_per_key", "SELECT * FROM first_items")
oracle("distinct_values", "SELECT DISTINCT payment_type FROM payments_clean")

# --- merge ---

view("orders_held", "SELECT * FROM orders_clean WHERE order_purchase_timestamp < TIMESTAMP '1999-01-01'")
view("orders_given", """
SELECT * REPLACE (order_status || '+' AS order_status) FROM orders_clean
WHERE order_purchase_timestamp >= TIMESTAMP '1997-01-01'
""")
view("orders_upserted", """
SELECT g.*, CASE WHEN h.order_id IS NULL THEN 'insert' ELSE 'update' END AS _action
FROM orders_given g LEFT JOIN orders_held h ON g.order_id = h.order_id
UNION ALL
SELECT h.*, 'keep' FROM orders_held h
WHERE NOT EXISTS (SELECT 1 FROM orders_given g WHERE g.order_id = h.order_id)
""")
oracle("merge_upsert", "SELECT * FROM orders_upserted")
oracle("upsert_all_columns", "SELECT * EXCLUDE (_action) FROM orders_upserted")
oracle("merge_schema_evolution", """
SELECT u.* REPLACE (
    CASE WHEN _action = 'insert' THEN NULL ELSE order_approved_at END AS order_approved_at),
  CASE WHEN _action <> 'keep' THEN o_orderpriority END AS o_orderpriority
FROM orders_upserted u JOIN orders ON u.order_id = CAST(o_orderkey AS VARCHAR)
""")

view("customers_synced", """
SELECT n.*, true AS is_active,
  CASE WHEN h.customer_id IS NULL THEN 'insert' ELSE 'update' END AS _action
FROM nxt_customers_clean n LEFT JOIN src_customers_clean h ON n.customer_id = h.customer_id
UNION ALL
SELECT h.*, false, 'soft_delete' FROM src_customers_clean h
WHERE NOT EXISTS (SELECT 1 FROM nxt_customers_clean n WHERE n.customer_id = h.customer_id)
""")
oracle("merge_snapshot_soft_delete", "SELECT * FROM customers_synced")
oracle("merge_metrics", """
SELECT count(*) FILTER (_action = 'insert') AS rows_inserted,
  count(*) FILTER (_action = 'update') AS rows_updated,
  count(*) FILTER (_action = 'soft_delete') AS rows_soft_deleted,
  count(*) FILTER (_action = 'keep') AS rows_kept, count(*) AS rows_output
FROM customers_synced
""")
oracle("merge_reactivate", """
SELECT *, true AS is_active, 'update' AS _action FROM src_customers_clean
UNION ALL
SELECT n.*, false, 'soft_delete' FROM nxt_customers_clean n
WHERE NOT EXISTS (SELECT 1 FROM src_customers_clean c WHERE c.customer_id = n.customer_id)
""")
oracle("merge_cdc", "SELECT * FROM user_state")
oracle("hard_delete_sweep", """
SELECT c.*, customer_id IN (SELECT customer_id FROM nxt_customers_clean) AS is_active,
  CASE WHEN customer_id IN (SELECT customer_id FROM nxt_customers_clean) THEN 'keep'
    ELSE 'soft_delete' END AS _action
FROM src_customers_clean c
""")


# --- slowly changing dimensions ---


def versioned(first: str, second: str, key: str, surrogate: str, columns: str, tracked: str) -> str:
    """A dimension after a first load and one more."""
    changed = " OR ".join(f"d.{c} IS DISTINCT FROM b.{c}" for c in tracked.split())
    held = ", ".join(f"d.{c}" for c in columns.split())
    given = ", ".join(f"b.{c}" for c in columns.split())
    return f"""
SELECT {held}, md5(d.{key} || '|{FIRST_LOAD}') AS {surrogate},
  TIMESTAMP '{FIRST_LOAD}' AS effective_date,
  CASE WHEN b.{key} IS NOT NULL AND ({changed}) THEN TIMESTAMP '{SECOND_LOAD}' END AS expiry_date,
  CASE WHEN b.{key} IS NOT NULL AND ({changed}) THEN 0 ELSE 1 END AS is_current
FROM {first} d LEFT JOIN {second} b ON d.{key} = b.{key}
UNION ALL
SELECT {given}, md5(b.{key} || '|{SECOND_LOAD}'), TIMESTAMP '{SECOND_LOAD}', NULL, 1
FROM {second} b LEFT JOIN {first} d ON d.{key} = b.{key}
WHERE d.{key} IS NULL OR {changed}
"""


for prefix in ("src", "nxt"):
    view(f"{prefix}_customer_rows", f"""
SELECT customer_id, customer_unique_id, md5(customer_zip_code_prefix) AS city_key
FROM {prefix}_customers_clean
""")
    view(f"{prefix}_seller_rows", f"""
SELECT seller_id, md5(seller_zip_code_prefix) AS city_key FROM {prefix}_sellers_clean
""")
    view(f"{prefix}_product_rows", f"""
SELECT product_id, md5(product_category_name) AS category_key, product_weight_g AS weight,
  product_length_cm AS length, product_height_cm AS height, product_width_cm AS width
FROM {prefix}_products_clean
""")
view("d_customer", versioned("src_customer_rows", "nxt_customer_rows", "customer_id", "customer_key",
                             "customer_id customer_unique_id city_key", "city_key"))
view("d_seller", versioned("src_seller_rows", "nxt_seller_rows", "seller_id", "seller_key",
                           "seller_id city_key", "city_key"))
view("d_product", versioned("src_product_rows", "nxt_product_rows", "product_id", "product_key",
                            "product_id category_key weight length height width",
                            "category_key weight length height width"))

view("changed_customers", """
SELECT b.* FROM nxt_customer_rows b JOIN src_customer_rows d ON b.customer_id = d.customer_id
WHERE b.city_key IS DISTINCT FROM d.city_key
""")
oracle("scd2_initial", f"""
SELECT *, md5(customer_id || '|{FIRST_LOAD}') AS customer_key,
  TIMESTAMP '{FIRST_LOAD}' AS effective_date, CAST(NULL AS TIMESTAMP) AS expiry_date, 1 AS is_current
FROM src_customer_rows
""")
oracle("scd2_detect_changes", "SELECT * FROM changed_customers")
oracle("scd2_staged", """
SELECT CAST(NULL AS VARCHAR) AS merge_key, * FROM changed_customers
UNION ALL SELECT customer_id, * FROM nxt_customer_rows
""")
oracle("scd2_apply", "SELECT * FROM d_customer")
oracle("scd2_surrogate_key", "SELECT product_id, effective_date, product_key FROM d_product")
oracle("dim_customer", "SELECT * FROM d_customer")
oracle("dim_product", "SELECT * FROM d_product")
oracle("dim_seller", "SELECT * FROM d_seller")

# --- other dimensions ---

oracle("dim_geolocation", """
SELECT md5(geolocation_zip_code_prefix) AS geolocation_key,
  geolocation_zip_code_prefix AS zip_code_prefix, geolocation_lat AS lat, geolocation_lng AS lng,
  geolocation_city AS city, geolocation_state AS state
FROM (SELECT *, row_number() OVER (PARTITION BY geolocation_zip_code_prefix
        ORDER BY geolocation_lat, geolocation_lng) AS rn FROM geolocation_clean) ranked WHERE rn = 1
""")
view("d_category", """
SELECT md5(product_category_name) AS category_key, product_category_name AS category_name_pt,
  product_category_name_english AS category_name_en FROM translation_clean
""")
oracle("dim_product_category", "SELECT * FROM d_category")
oracle("dim_status", """
SELECT DISTINCT md5(order_status) AS status_key, order_status FROM orders_clean
""")
view("d_payment_type", "SELECT DISTINCT md5(payment_type) AS payment_type_key, payment_type FROM payments_clean")
oracle("dim_payment_type", "SELECT * FROM d_payment_type")
view("d_time", """
SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS time_key, CAST(d AS DATE) AS full_date,
  CAST(day(d) AS INTEGER) AS day, CAST(month(d) AS INTEGER) AS month,
  CAST(quarter(d) AS INTEGER) AS quarter, CAST(year(d) AS INTEGER) AS year,
  strftime(d, '%a') AS day_of_week,
  CASE WHEN strftime(d, '%a') IN ('Sat', 'Sun') THEN 1 ELSE 0 END AS is_weekend
FROM (SELECT unnest(generate_series(
        least(DATE '2008-01-01', min(CAST(t AS DATE))),
        greatest(DATE '2030-12-31', max(CAST(t AS DATE))), INTERVAL 1 DAY)) AS d
      FROM (SELECT o_orderdate AS t FROM orders UNION ALL SELECT ts FROM events) times) days
""")
oracle("dim_time", "SELECT * FROM d_time")

# --- facts ---

view("order_lines", """
SELECT order_id, product_id, seller_id, count(order_item_id) AS quantity,
  arg_min(price, struct_pack(a := order_item_id, b := price)) AS sale_price, sum(freight_value) AS freight_value
FROM items_clean GROUP BY order_id, product_id, seller_id
""")


def sales(lines: str, known: str = "TRUE") -> str:
    """known: condition on ``{key}`` for the sellers and products that have a dimension row."""
    return f"""
SELECT o.order_id, c.customer_key, p.product_key, s.seller_key,
  CAST(strftime(o.order_purchase_timestamp, '%Y%m%d') AS INTEGER) AS purchase_time_key,
  CAST(strftime(o.order_delivered_customer_date, '%Y%m%d') AS INTEGER) AS delivery_time_key,
  md5(o.order_status) AS status_key, i.sale_price, i.quantity,
  i.sale_price * i.quantity AS total_value,
  CASE WHEN o.order_status = 'canceled' THEN 1 ELSE 0 END AS is_canceled,
  CAST(date_diff('day', o.order_estimated_delivery_date, o.order_delivered_customer_date) AS INTEGER)
    AS delivery_delay_days,
  i.freight_value
FROM {lines} i JOIN orders_clean o ON i.order_id = o.order_id
LEFT JOIN d_customer c ON o.customer_id = c.customer_id
  AND o.order_purchase_timestamp >= c.effective_date
  AND (o.order_purchase_timestamp < c.expiry_date OR c.expiry_date IS NULL)
LEFT JOIN d_seller s ON i.seller_id = s.seller_id AND {known.format(key="i.seller_id")}
  AND o.order_purchase_timestamp >= s.effective_date
  AND (o.order_purchase_timestamp < s.expiry_date OR s.expiry_date IS NULL)
LEFT JOIN d_product p ON i.product_id = p.product_id AND {known.format(key="i.product_id")}
  AND o.order_purchase_timestamp >= p.effective_date
  AND (o.order_purchase_timestamp < p.expiry_date OR p.expiry_date IS NULL)
"""


_SALES_AS_DOUBLE = """* REPLACE (CAST(sale_price AS DOUBLE) AS sale_price,
  CAST(total_value AS DOUBLE) AS total_value, CAST(freight_value AS DOUBLE) AS freight_value)"""

view("f_sales", sales("order_lines"))
oracle("fact_sales", f"SELECT {_SALES_AS_DOUBLE} FROM f_sales")
view("reloaded_sales", sales("order_lines", "CAST({key} AS BIGINT) % 5 <> 0"))
oracle("fact_reload", f"SELECT {_SALES_AS_DOUBLE} FROM reloaded_sales")

for part, condition in (
    ("held", "shipping_limit_date < TIMESTAMP '1999-01-01'"),
    ("fresh", "shipping_limit_date >= TIMESTAMP '1998-01-01'"),
):
    view(f"{part}_lines", f"""
SELECT order_id, product_id, seller_id, count(order_item_id) AS quantity,
  arg_min(price, struct_pack(a := order_item_id, b := price)) AS sale_price, sum(freight_value) AS freight_value
FROM items_clean WHERE {condition} GROUP BY order_id, product_id, seller_id
""")
    view(f"{part}_sales", sales(f"{part}_lines"))
_SAME_SALE = """f.order_id IS NOT DISTINCT FROM h.order_id
  AND f.product_key IS NOT DISTINCT FROM h.product_key
  AND f.seller_key IS NOT DISTINCT FROM h.seller_key"""
oracle("fact_merge_incremental", f"""
SELECT {_SALES_AS_DOUBLE} FROM (
  SELECT f.*, CASE WHEN h.order_id IS NULL THEN 'insert' ELSE 'update' END AS _action
  FROM fresh_sales f LEFT JOIN held_sales h ON {_SAME_SALE}
  UNION ALL
  SELECT h.*, 'keep' FROM held_sales h LEFT JOIN fresh_sales f ON {_SAME_SALE}
  WHERE f.order_id IS NULL) merged
""")

view("payments_by_order", """
SELECT order_id, count(payment_sequential) AS "Num_payment_methods",
  sum(payment_value) AS "Total_payment_value", max(payment_installments) AS payment_installments,
  arg_min(payment_type, struct_pack(a := payment_sequential, b := id)) AS primary_payment_type
FROM payments_clean GROUP BY order_id
""")
view("f_payments", """
SELECT p.order_id, md5(primary_payment_type) AS payment_type_key, "Num_payment_methods",
  CAST(strftime(order_purchase_timestamp, '%Y%m%d') AS INTEGER) AS time_key,
  "Total_payment_value", payment_installments
FROM payments_by_order p LEFT JOIN orders_clean o ON p.order_id = o.order_id
""")
oracle("fact_payments", """
SELECT * REPLACE (CAST("Total_payment_value" AS DOUBLE) AS "Total_payment_value") FROM f_payments
""")

view("first_products", """
SELECT order_id, product_id FROM (SELECT order_id, product_id, row_number() OVER (
  PARTITION BY order_id ORDER BY order_item_id, product_id) AS rn FROM items_clean) ranked WHERE rn = 1
""")
view("f_reviews", """
SELECT r.review_id AS "Review_id", r.order_id AS "Order_id", c.customer_key, p.product_key,
  r.review_score AS "Review_score",
  CAST(strftime(r.review_creation_date, '%Y%m%d') AS INTEGER) AS time_key
FROM reviews_clean r LEFT JOIN orders_clean o ON r.order_id = o.order_id
LEFT JOIN first_products i ON r.order_id = i.order_id
LEFT JOIN d_customer c ON o.customer_id = c.customer_id
  AND r.review_creation_date >= c.effective_date
  AND (r.review_creation_date < c.expiry_date OR c.expiry_date IS NULL)
LEFT JOIN d_product p ON i.product_id = p.product_id
  AND r.review_creation_date >= p.effective_date
  AND (r.review_creation_date < p.expiry_date OR p.expiry_date IS NULL)
""")
oracle("fact_reviews", "SELECT * FROM f_reviews")

view("f_shipment", """
SELECT md5(o.order_id) AS shipment_key, o.order_id, c.customer_key, s.seller_key,
  CAST(strftime(i.shipping_limit_date, '%Y%m%d') AS INTEGER) AS shipping_limit_date,
  CAST(strftime(order_delivered_carrier_date, '%Y%m%d') AS INTEGER) AS delivered_carrier_date,
  CAST(strftime(order_delivered_customer_date, '%Y%m%d') AS INTEGER) AS delivered_customer_date,
  CAST(strftime(order_estimated_delivery_date, '%Y%m%d') AS INTEGER) AS estimated_delivery_date,
  CAST(date_diff('day', order_estimated_delivery_date, order_delivered_customer_date) AS INTEGER)
    AS delivery_delay_days,
  CAST(date_diff('day', order_delivered_carrier_date, order_delivered_customer_date) AS INTEGER)
    AS carrier_to_customer_days,
  CASE WHEN date_diff('day', order_estimated_delivery_date, order_delivered_customer_date) > 0
    THEN 1 ELSE 0 END AS is_late_delivery
FROM orders_clean o JOIN first_items i ON o.order_id = i.order_id
LEFT JOIN d_customer c ON o.customer_id = c.customer_id
  AND o.order_purchase_timestamp >= c.effective_date
  AND (o.order_purchase_timestamp < c.expiry_date OR c.expiry_date IS NULL)
LEFT JOIN d_seller s ON i.seller_id = s.seller_id
  AND o.order_purchase_timestamp >= s.effective_date
  AND (o.order_purchase_timestamp < s.expiry_date OR s.expiry_date IS NULL)
""")
oracle("fact_shipment", "SELECT * FROM f_shipment")

# --- joins ---

_LINES_AS_DOUBLE = """l.order_id, product_id, seller_id, quantity,
  CAST(sale_price AS DOUBLE) AS sale_price, CAST(freight_value AS DOUBLE) AS freight_value"""
oracle("join_inner", f"""
SELECT {_LINES_AS_DOUBLE}, customer_id, order_status
FROM order_lines l JOIN orders_clean o ON l.order_id = o.order_id
""")
oracle("join_left", """
SELECT o.order_id, order_status, "Num_payment_methods",
  CAST("Total_payment_value" AS DOUBLE) AS "Total_payment_value", payment_installments,
  primary_payment_type
FROM orders_clean o LEFT JOIN payments_by_order p ON o.order_id = p.order_id
""")
oracle("join_left_expr", """
SELECT order_id, purchase_time_key, full_date, day_of_week
FROM (SELECT order_id, CAST(strftime(order_purchase_timestamp, '%Y%m%d') AS INTEGER) AS purchase_time_key
      FROM orders_clean) o LEFT JOIN d_time ON purchase_time_key = time_key
""")
oracle("join_asof_scd2", """
SELECT order_id, o.customer_id, order_purchase_timestamp, customer_key, city_key, is_current
FROM orders_clean o LEFT JOIN d_customer c ON o.customer_id = c.customer_id
  AND order_purchase_timestamp >= effective_date
  AND (order_purchase_timestamp < expiry_date OR expiry_date IS NULL)
""")
oracle("join_asof_many_versions", """
WITH days AS (
  SELECT c_nationkey AS nation, o_orderdate AS effective_date, max(o_totalprice) AS highest, count(*) AS orders
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL
), versions AS (
  SELECT *, least(lead(effective_date) OVER (PARTITION BY nation ORDER BY effective_date),
    effective_date + INTERVAL 3 DAYS) AS expiry_date
  FROM days
)
SELECT l_orderkey, l_linenumber, l_partkey, s_nationkey, l_shipdate, highest, orders
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
LEFT JOIN versions ON nation = s_nationkey AND l_shipdate >= effective_date AND l_shipdate < expiry_date
""")
oracle("join_left_anti", """
SELECT * FROM orders_clean WHERE order_id NOT IN (SELECT order_id FROM items_clean)
""")
oracle("join_star", """
SELECT f.order_id, f.product_key, f.seller_key, f.quantity, t.full_date, g.category_name_en,
  c.city_key AS customer_city_key, s.city_key AS seller_city_key
FROM f_sales f LEFT JOIN d_product p ON f.product_key = p.product_key
LEFT JOIN d_customer c ON f.customer_key = c.customer_key
LEFT JOIN d_seller s ON f.seller_key = s.seller_key
LEFT JOIN d_time t ON f.purchase_time_key = t.time_key
LEFT JOIN d_category g ON p.category_key = g.category_key
""")
oracle("join_preaggregated", """
SELECT review_id, r.order_id, review_score, product_id
FROM reviews_clean r LEFT JOIN first_products p ON r.order_id = p.order_id
""")

# --- aggregation ---

oracle("agg_order_lines", f"SELECT {_LINES_AS_DOUBLE} FROM order_lines l")
oracle("agg_payments", """
SELECT * REPLACE (CAST("Total_payment_value" AS DOUBLE) AS "Total_payment_value") FROM payments_by_order
""")
oracle("agg_first_product", "SELECT * FROM first_products")
oracle("agg_conditional_rate", """
SELECT payment_type, avg(CASE WHEN payment_installments > 6 THEN 1 ELSE 0 END) AS long_rate,
  avg(payment_installments) AS avg_installments
FROM payments_clean GROUP BY payment_type
""")
oracle("agg_count_star", """
SELECT order_status, CAST(year(order_purchase_timestamp) AS INTEGER) AS year, count(*) AS orders
FROM orders_clean GROUP BY ALL
""")
oracle("agg_global_max", """
SELECT max(CAST(strftime(order_purchase_timestamp, '%Y%m%d') AS INTEGER)) AS max_key,
  max(order_purchase_timestamp) AS max_time FROM orders_clean
""")

# --- marts ---

oracle("revenue_mart", """
SELECT t.full_date AS date, g.category_name_en AS product_category, s.seller_key,
  c.city_key AS customer_geo_key, count(DISTINCT f.order_id) AS total_orders,
  CAST(sum(f.sale_price + f.freight_value) AS DOUBLE) AS total_revenue,
  CAST(sum(f.sale_price + f.freight_value) AS DOUBLE) / count(*) AS avg_order_value,
  CAST(sum(f.quantity) AS BIGINT) AS total_items_sold,
  CAST(sum(f.sale_price) AS DOUBLE) / count(f.sale_price) AS avg_price,
  CAST(sum(f.freight_value) AS DOUBLE) / count(f.freight_value) AS avg_freight_value
FROM f_sales f LEFT JOIN d_product p ON f.product_key = p.product_key
LEFT JOIN d_customer c ON f.customer_key = c.customer_key
LEFT JOIN d_seller s ON f.seller_key = s.seller_key
LEFT JOIN d_time t ON f.purchase_time_key = t.time_key
LEFT JOIN d_category g ON p.category_key = g.category_key
GROUP BY t.full_date, g.category_name_en, s.seller_key, c.city_key
""")
oracle("cashflow_mart", """
SELECT t.full_date AS date, y.payment_type,
  CAST(sum("Total_payment_value") AS DOUBLE) AS total_payment_value,
  CAST(sum("Total_payment_value") AS DOUBLE) / count("Total_payment_value") AS avg_payment_value,
  avg(payment_installments) AS avg_installments,
  avg(CASE WHEN payment_installments > 1 THEN 1 ELSE 0 END) AS installment_ratio,
  avg(CASE WHEN y.payment_type = 'voucher' THEN 1 ELSE 0 END) AS voucher_usage_rate
FROM f_payments f LEFT JOIN d_payment_type y ON f.payment_type_key = y.payment_type_key
LEFT JOIN d_time t ON f.time_key = t.time_key
GROUP BY t.full_date, y.payment_type
""")
oracle("customer_experience_mart", """
SELECT t.full_date AS date, g.category_name_en AS product_category, s.city_key AS seller_geo_key,
  avg(r."Review_score") AS avg_review_score,
  avg(CASE WHEN r."Review_score" >= 4 THEN 1 ELSE 0 END) AS good_review_rate,
  avg(CASE WHEN r."Review_score" <= 2 THEN 1 ELSE 0 END) AS bad_review_rate,
  avg(0) AS avg_delivery_delay, avg(0) AS late_delivery_rate,
  CAST(sum(f.freight_value) AS DOUBLE) / nullif(count(f.freight_value), 0) AS avg_freight_value,
  CAST(sum(f.sale_price) AS DOUBLE) / nullif(count(f.sale_price), 0) AS avg_price,
  count(*) AS review_volume
FROM f_reviews r LEFT JOIN f_sales f ON r."Order_id" = f.order_id
LEFT JOIN d_time t ON r.time_key = t.time_key
LEFT JOIN d_product p ON r.product_key = p.product_key
LEFT JOIN d_category g ON p.category_key = g.category_key
LEFT JOIN d_seller s ON f.seller_key = s.seller_key
GROUP BY t.full_date, g.category_name_en, s.city_key
""")
oracle("customer_experience_mart_v2", """
SELECT t.full_date AS date, g.category_name_en AS product_category, s.city_key AS seller_geo_key,
  avg(r."Review_score") AS avg_review_score,
  avg(CASE WHEN r."Review_score" >= 4 THEN 1 ELSE 0 END) AS good_review_rate,
  avg(CASE WHEN r."Review_score" <= 2 THEN 1 ELSE 0 END) AS bad_review_rate,
  avg(h.delivery_delay_days) AS avg_delivery_delay,
  avg(CASE WHEN h.delivery_delay_days > 0 THEN 1 ELSE 0 END) AS late_delivery_rate,
  CAST(sum(o.freight) AS DOUBLE) / nullif(count(o.freight), 0) AS avg_order_freight,
  CAST(sum(o.price) AS DOUBLE) / nullif(count(o.price), 0) AS avg_order_price,
  count(*) AS review_volume
FROM f_reviews r LEFT JOIN f_shipment h ON r."Order_id" = h.order_id
LEFT JOIN (SELECT order_id, sum(freight_value) AS freight, sum(sale_price) AS price FROM f_sales GROUP BY order_id) o
  ON r."Order_id" = o.order_id
LEFT JOIN d_time t ON r.time_key = t.time_key
LEFT JOIN d_product p ON r.product_key = p.product_key
LEFT JOIN d_category g ON p.category_key = g.category_key
LEFT JOIN d_seller s ON h.seller_key = s.seller_key
GROUP BY t.full_date, g.category_name_en, s.city_key
""")
view("shipment_rows", """
SELECT h.*, s.city_key AS seller_geo_key, c.city_key AS customer_geo_key,
  strptime(CAST(o.purchase_time_key AS VARCHAR), '%Y%m%d') AS bought,
  strptime(CAST(h.delivered_customer_date AS VARCHAR), '%Y%m%d') AS delivered,
  strptime(CAST(h.delivered_carrier_date AS VARCHAR), '%Y%m%d') AS handed_over
FROM f_shipment h
LEFT JOIN (SELECT order_id, min(purchase_time_key) AS purchase_time_key FROM f_sales GROUP BY order_id) o
  ON h.order_id = o.order_id
LEFT JOIN d_customer c ON h.customer_key = c.customer_key
LEFT JOIN d_seller s ON h.seller_key = s.seller_key
""")
oracle("logistics_mart_v2", """
SELECT seller_geo_key, customer_geo_key, CAST(bought AS DATE) AS date,
  avg(date_diff('day', bought, delivered)) AS avg_delivery_time,
  avg(date_diff('day', bought, handed_over)) AS avg_days_to_carrier,
  avg(carrier_to_customer_days) AS avg_carrier_to_customer_days,
  avg(delivery_delay_days) AS avg_delivery_delay,
  avg(CASE WHEN delivery_delay_days > 0 THEN 1 ELSE 0 END) AS late_delivery_rate,
  avg(CASE WHEN delivery_delay_days <= 0 THEN 1 ELSE 0 END) AS on_time_rate,
  count(*) AS order_volume
FROM shipment_rows GROUP BY seller_geo_key, customer_geo_key, CAST(bought AS DATE)
""")
view("logistics_rows", """
SELECT s.city_key AS seller_geo_key, c.city_key AS customer_geo_key,
  CAST(strptime(CAST(f.purchase_time_key AS VARCHAR), '%Y%m%d') AS DATE) AS date,
  date_diff('day', strptime(CAST(f.purchase_time_key AS VARCHAR), '%Y%m%d'),
    strptime(CAST(h.delivered_customer_date AS VARCHAR), '%Y%m%d')) AS taken,
  date_diff('day', strptime(CAST(h.estimated_delivery_date AS VARCHAR), '%Y%m%d'),
    strptime(CAST(h.delivered_customer_date AS VARCHAR), '%Y%m%d')) AS delay
FROM f_shipment h LEFT JOIN f_sales f ON h.order_id = f.order_id
LEFT JOIN d_customer c ON h.customer_key = c.customer_key
LEFT JOIN d_seller s ON h.seller_key = s.seller_key
""")
oracle("logistics_mart", """
SELECT seller_geo_key, customer_geo_key, date, avg(taken) AS avg_delivery_time,
  avg(delay) AS avg_delivery_delay,
  avg(CASE WHEN delay > 0 THEN 1 ELSE 0 END) AS late_delivery_rate,
  avg(CASE WHEN delay <= 0 THEN 1 ELSE 0 END) AS on_time_rate,
  avg(taken) AS avg_shipping_duration, avg(taken) AS carrier_to_customer_days,
  count(*) AS order_volume
FROM logistics_rows GROUP BY seller_geo_key, customer_geo_key, date
""")

# --- scalar functions ---

oracle("scalar_strings", """
SELECT customer_id, trim(customer_city) AS trimmed, lower(trim(customer_city)) AS lowered,
  upper(trim(customer_state)) AS uppered, lpad(customer_zip_code_prefix, 5, '0') AS padded,
  lpad(customer_unique_id, 5, '0') AS cut, customer_id || '/' || trim(customer_city) AS joined
FROM src_customers
""")
oracle("scalar_dates", """
SELECT order_id, strftime(order_purchase_timestamp, '%Y%m%d') AS day_text,
  CAST(strftime(order_purchase_timestamp, '%Y%m%d') AS INTEGER) AS time_key,
  CAST(year(order_purchase_timestamp) AS INTEGER) AS year,
  CAST(quarter(order_purchase_timestamp) AS INTEGER) AS quarter,
  CAST(month(order_purchase_timestamp) AS INTEGER) AS month,
  CAST(day(order_purchase_timestamp) AS INTEGER) AS day,
  strftime(order_purchase_timestamp, '%a') AS day_of_week,
  CAST(date_diff('day', order_estimated_delivery_date, order_delivered_customer_date) AS INTEGER)
    AS delay_days,
  CAST(order_purchase_timestamp AS DATE) AS day_again
FROM orders_clean
""")
oracle("scalar_hash_keys", """
SELECT order_id, product_id, seller_id, md5(order_id) AS shipment_key,
  md5(product_id || '|' || seller_id) AS pair_key FROM items_clean
""")
oracle("scalar_null_handling", """
SELECT id, coalesce(payment_installments, 1) AS filled,
  CASE WHEN payment_type = 'Voucher' THEN 1 ELSE 0 END AS is_voucher,
  payment_type IN ('Voucher', ' boleto') AS is_listed,
  CAST(payment_value AS DOUBLE) / nullif(CAST(payment_installments - 1 AS DOUBLE), 0) AS per_later_part,
  payment_value IS NULL AS is_missing
FROM payments_raw
""")
oracle("scalar_json", "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
oracle("scalar_arrays_sequence", """
SELECT CAST(d AS DATE) AS day, count(*) AS under_way
FROM (SELECT unnest(generate_series(CAST(order_purchase_timestamp AS DATE),
        CAST(order_delivered_customer_date AS DATE), INTERVAL 1 DAY)) AS d FROM orders_clean) days
GROUP BY CAST(d AS DATE)
""")

# --- features, training, scoring ---

view("order_sums", """
SELECT order_id, CAST(sum(sale_price * quantity) AS DOUBLE) AS price_sum,
  CAST(sum(sale_price) AS DOUBLE) / count(sale_price) AS price_mean,
  CAST(sum(freight_value) AS DOUBLE) AS freight_sum,
  CAST(sum(freight_value) AS DOUBLE) / count(freight_value) AS freight_mean,
  CAST(sum(quantity) AS BIGINT) AS item_count, min(delivery_delay_days) AS delivery_delay,
  min(purchase_time_key) AS purchase_time_key, min(delivery_time_key) AS delivery_time_key
FROM f_sales GROUP BY order_id
""")
oracle("agg_order_features", "SELECT * FROM order_sums")
view("order_timed", """
SELECT *, CAST(date_diff('day', strptime(CAST(purchase_time_key AS VARCHAR), '%Y%m%d'),
    strptime(CAST(delivery_time_key AS VARCHAR), '%Y%m%d')) AS INTEGER) AS delivery_time,
  freight_sum / nullif(price_sum, 0) AS freight_ratio
FROM order_sums
""")
view("order_features", """
SELECT *, CAST(freight_ratio > 0.5 AS INTEGER) AS is_high_freight,
  price_sum / nullif(item_count, 0) AS price_per_item,
  CAST(delivery_delay AS DOUBLE) / nullif(delivery_time + 1, 0) AS delay_ratio
FROM order_timed
""")
view("scored_features", """
SELECT * REPLACE (CAST(is_high_freight AS DOUBLE) AS is_high_freight) FROM order_features
""")
view("training_rows", """
SELECT f.order_id, r."Review_score" AS review_score, CAST(r."Review_score" >= 4 AS INTEGER) AS label,
  delivery_delay, delivery_time, price_sum, price_mean, freight_sum, freight_mean, freight_ratio,
  is_high_freight, price_per_item, delay_ratio, item_count
FROM f_reviews r JOIN order_features f ON r."Order_id" = f.order_id
WHERE r."Review_score" IS NOT NULL AND delivery_delay IS NOT NULL AND delivery_time IS NOT NULL
  AND price_sum IS NOT NULL AND freight_sum IS NOT NULL
""")
oracle("ml_features", "SELECT * FROM training_rows")
oracle("scoring_features", "SELECT * FROM scored_features")
oracle("agg_class_counts", "SELECT label, count(*) AS rows FROM training_rows GROUP BY label")
oracle("union_all", "SELECT order_id, review_score, label FROM training_rows")
oracle("ml_class_weights", """
SELECT label, count(*) AS rows,
  CAST(sum(count(*)) OVER () AS DOUBLE) / (count(*) OVER () * count(*)) AS "classWeight"
FROM training_rows GROUP BY label
""")
oracle("ml_stratified_split", """
SELECT order_id, review_score, label, substr(md5(order_id || '|42'), 1, 8) >= 'cccccccc' AS is_test
FROM training_rows
""")

_FEATURES = (
    "delivery_delay", "delivery_time", "price_sum", "price_mean", "freight_sum", "freight_mean",
    "freight_ratio", "item_count", "is_high_freight", "price_per_item", "delay_ratio",
)
oracle("agg_feature_means", "SELECT " + ", ".join(
    f"round(avg({c}), 6) AS {c}" for c in _FEATURES) + " FROM training_rows")
view("feature_means", "SELECT " + ", ".join(f"avg({c}) AS {c}" for c in _FEATURES) + " FROM training_rows")
oracle("ml_mean_impute", "SELECT order_id, " + ", ".join(
    f"round(coalesce(CAST(f.{c} AS DOUBLE), m.{c}, 0.0), 6) AS {c}" for c in _FEATURES)
    + " FROM scored_features f, feature_means m")

view("given_scores", "SELECT label, (delivery_time % 20) / 20.0::DOUBLE AS score FROM training_rows")
view("candidates", "SELECT unnest([0.1, 0.25, 0.4, 0.55, 0.7]::DOUBLE[]) AS threshold")
view("confusion", """
SELECT threshold, count(*) FILTER (score <= threshold AND label = 0) AS tp0,
  count(*) FILTER (score <= threshold AND label = 1) AS fp0,
  count(*) FILTER (score > threshold AND label = 0) AS fn0,
  count(*) FILTER (score > threshold AND label = 1) AS tp1
FROM candidates CROSS JOIN given_scores GROUP BY threshold
""")
view("class_rates", """
SELECT *, coalesce(tp0 / nullif(CAST(tp0 + fp0 AS DOUBLE), 0), 0) AS precision0,
  coalesce(tp0 / nullif(CAST(tp0 + fn0 AS DOUBLE), 0), 0) AS recall0,
  coalesce(tp1 / nullif(CAST(tp1 + fn0 AS DOUBLE), 0), 0) AS precision1,
  coalesce(tp1 / nullif(CAST(tp1 + fp0 AS DOUBLE), 0), 0) AS recall1
FROM confusion
""")
view("class_measures", """
SELECT *, coalesce(2 * precision0 * recall0 / nullif(precision0 + recall0, 0), 0) AS f1_0,
  coalesce(2 * precision1 * recall1 / nullif(precision1 + recall1, 0), 0) AS f1_1
FROM class_rates
""")
oracle("agg_confusion_matrix", "SELECT * FROM confusion WHERE threshold = 0.55::DOUBLE")
view("tied_scores", """
SELECT score, count(*) FILTER (label = 1) AS good, count(*) FILTER (label = 0) AS bad
FROM given_scores WHERE score IS NOT NULL GROUP BY score
""")
view("summed_scores", """
SELECT good, bad,
  coalesce(sum(bad) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below
FROM tied_scores
""")
oracle("ml_roc_auc", """
SELECT sum(good)::BIGINT AS positives, sum(bad)::BIGINT AS negatives,
  sum(good * (2 * below + bad))::DOUBLE / nullif((2 * sum(good) * sum(bad))::DOUBLE, 0) AS roc_auc
FROM summed_scores
""")
oracle("ml_threshold_search", "SELECT *, (f1_0 + f1_1) / 2 AS macro_f1 FROM class_measures")
view("report", """
SELECT *, tp0 + fn0 AS n0, tp1 + fp0 AS n1, tp0 + fn0 + tp1 + fp0 AS n
FROM class_measures WHERE threshold = 0.55::DOUBLE
""")
oracle("ml_classification_report", """
SELECT '0' AS class, precision0 AS precision, recall0 AS recall, f1_0 AS f1_score, n0 AS support FROM report
UNION ALL SELECT '1', precision1, recall1, f1_1, n1 FROM report
UNION ALL SELECT 'accuracy', NULL, NULL, (tp0 + tp1) / CAST(n AS DOUBLE), n FROM report
UNION ALL SELECT 'macro avg', (precision0 + precision1) / 2, (recall0 + recall1) / 2, (f1_0 + f1_1) / 2, n
FROM report
UNION ALL SELECT 'weighted avg', (precision0 * n0 + precision1 * n1) / n, (recall0 * n0 + recall1 * n1) / n,
  (f1_0 * n0 + f1_1 * n1) / n, n FROM report
""")

_MARGIN = """0.02429::DOUBLE + (delivery_delay::DOUBLE + 1.563) / 8.798 * 0.2284 + (delivery_time::DOUBLE - 17.98) / 8.369 * -0.2497
  + (price_sum - 217200.0) / 122300.0 * -0.04948 + (price_mean - 52880.0) / 17570.0 * 0.02555
  + (freight_sum - 8697.0) / 5627.0 * 0.004484 + (freight_mean - 2123.0) / 1078.0 * -0.002712
  + (freight_ratio - 0.04011) / 0.0148 * -0.003099 + (item_count::DOUBLE - 4.084) / 1.964 * -0.002133
  + (price_per_item - 52880.0) / 17570.0 * 0.02555 + (delay_ratio + 0.4185) / 0.8944 * 0.03479"""
view("test_rows", f"""
SELECT order_id, label, 1 / (1 + exp(-({_MARGIN}))) AS score FROM training_rows
WHERE substr(md5(order_id || '|42'), 1, 8) >= 'cccccccc'
  AND {" AND ".join(f"{c} IS NOT NULL" for c in _FEATURES)}
""")
oracle("ml_predict_stored", """
SELECT order_id, label, round(score, 9) AS score, CASE WHEN score > 0.5 THEN 1.0 ELSE 0.0 END::DOUBLE AS prediction
FROM test_rows
""")
view("test_counts", """
SELECT count(*) FILTER (score <= 0.5 AND label = 0)::DOUBLE AS tp0, count(*) FILTER (score <= 0.5 AND label = 1)::DOUBLE AS fp0,
  count(*) FILTER (score > 0.5 AND label = 0)::DOUBLE AS fn0, count(*) FILTER (score > 0.5 AND label = 1)::DOUBLE AS tp1
FROM (SELECT label, round(score, 9) AS score FROM test_rows)
""")
view("test_rates", """
SELECT *, (tp0 + fn0)::BIGINT AS n0, (tp1 + fp0)::BIGINT AS n1,
  coalesce(tp0 / nullif(tp0 + fp0, 0), 0) AS p0, coalesce(tp0 / nullif(tp0 + fn0, 0), 0) AS r0,
  coalesce(tp1 / nullif(tp1 + fn0, 0), 0) AS p1, coalesce(tp1 / nullif(tp1 + fp0, 0), 0) AS r1
FROM test_counts
""")
view("test_measures", """
SELECT *, n0 + n1 AS n, coalesce(2 * p0 * r0 / nullif(p0 + r0, 0), 0) AS f0, coalesce(2 * p1 * r1 / nullif(p1 + r1, 0), 0) AS f1
FROM test_rates
""")
view("test_area", """
SELECT sum(CASE WHEN g.score > b.score THEN 2 WHEN g.score = b.score THEN 1 ELSE 0 END)::DOUBLE
  / nullif(2 * count(*), 0)::DOUBLE AS roc_auc
FROM (SELECT round(score, 9) AS score FROM test_rows WHERE label = 1) g, (SELECT round(score, 9) AS score FROM test_rows WHERE label = 0) b
""")
oracle("ml_report_stored", """
SELECT r.*, roc_auc FROM (
SELECT '0' AS class, p0 AS precision, r0 AS recall, f0 AS f1_score, n0 AS support FROM test_measures
UNION ALL SELECT '1', p1, r1, f1, n1 FROM test_measures
UNION ALL SELECT 'accuracy', NULL, NULL, (tp0 + tp1) / n, n FROM test_measures
UNION ALL SELECT 'macro avg', (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, n FROM test_measures
UNION ALL SELECT 'weighted avg', (p0 * n0 + p1 * n1) / n, (r0 * n0 + r1 * n1) / n, (f0 * n0 + f1 * n1) / n, n FROM test_measures
) r, test_area
""")
view("imputed", "SELECT order_id, purchase_time_key, " + ", ".join(
    f"coalesce(CAST(f.{c} AS DOUBLE), m.{c}, 0.0) AS {c}" for c in _FEATURES) + " FROM scored_features f, feature_means m")
view("order_scores", f"SELECT order_id, purchase_time_key, 1 / (1 + exp(-({_MARGIN}))) AS score FROM imputed")
view("first_alerts", """
SELECT *, TIMESTAMP '2001-01-01 06:00:00' AS scored_at FROM order_scores
WHERE score < 0.5 AND purchase_time_key = (SELECT max(purchase_time_key) FROM f_sales WHERE purchase_time_key <= 20001231)
""")
oracle("score_new_orders_stored", """
SELECT order_id, purchase_time_key, round(score, 6) AS score, 0 AS predicted_label, scored_at FROM (
  SELECT * FROM first_alerts
  UNION ALL
  SELECT *, TIMESTAMP '2001-08-02 06:00:00' FROM order_scores
  WHERE score < 0.5 AND purchase_time_key > coalesce((SELECT max(purchase_time_key) FROM first_alerts), 0)
    AND order_id NOT IN (SELECT order_id FROM first_alerts))
""")

view("canceled_alerts", """
SELECT order_id, purchase_time_key FROM f_sales WHERE is_canceled = 1 AND purchase_time_key <= 20000630
""")
oracle("scoring_candidates", """
SELECT * FROM scored_features
WHERE purchase_time_key > (SELECT max(purchase_time_key) FROM canceled_alerts)
  AND order_id NOT IN (SELECT order_id FROM canceled_alerts)
""")

# --- insights ---

view("bought", """
SELECT customer_key, CAST(strptime(CAST(purchase_time_key AS VARCHAR), '%Y%m%d') AS DATE) AS day,
  sum(sale_price * quantity) AS spent
FROM f_sales WHERE customer_key IS NOT NULL AND purchase_time_key IS NOT NULL GROUP BY ALL
""")
view("bought_recent", """
SELECT b.customer_key, b.day, b.spent, sum(a.spent) AS recent
FROM bought b JOIN bought a ON a.customer_key = b.customer_key AND a.day BETWEEN b.day - 89 AND b.day
WHERE b.day <= DATE '2001-08-31' GROUP BY ALL
""")
view("customer_sums", """
SELECT customer_key, count(*) AS frequency, sum(spent) AS spent, max(recent) AS recent_peak,
  CAST(DATE '2001-08-31' - max(day) AS INTEGER) AS recency, CAST(DATE '2001-08-31' - min(day) + 1 AS INTEGER) AS age
FROM bought_recent GROUP BY customer_key
""")
view("rate_fit", """
SELECT m, each, greatest(0, (xx - 2 * m * xt + m * m * tt - x) / tt) AS v FROM (
  SELECT *, x / t AS m, s / x AS each FROM (
    SELECT sum(frequency)::DOUBLE AS x, sum(age)::DOUBLE AS t, sum(frequency * frequency)::DOUBLE AS xx,
      sum(frequency * age)::DOUBLE AS xt, sum(age * age)::DOUBLE AS tt, sum(spent)::DOUBLE AS s FROM customer_sums))
""")
oracle("customer_lifetime_value", """
SELECT customer_key, frequency, spent::DOUBLE AS spent, recent_peak::DOUBLE AS recent_peak, recency, age,
  round(purchases, 6) AS expected_purchases, round(money, 6) AS expected_each, round(purchases * money, 6) AS lifetime_value
FROM (SELECT *, 365 * ((m * m + v * frequency) / (m + v * age)) AS purchases, (spent::DOUBLE + each) / (frequency + 1) AS money
  FROM customer_sums, rate_fit)
""")
oracle("product_popularity", """
SELECT product_key, round(sum(quantity * pow(0.5, date_diff('day', strptime(CAST(purchase_time_key AS VARCHAR), '%Y%m%d'),
    TIMESTAMP '2001-08-31') / 90.0)), 6) AS popularity, CAST(sum(quantity) AS BIGINT) AS sold
FROM f_sales WHERE product_key IS NOT NULL AND purchase_time_key <= 20010831 GROUP BY product_key
""")
view("category_reviews", """
SELECT DISTINCT category_key, seller_key, r."Review_id" AS review_id, r."Order_id" AS order_id, r."Review_score" AS score
FROM f_sales f JOIN d_product p ON f.product_key = p.product_key JOIN f_reviews r ON r."Order_id" = f.order_id
WHERE seller_key IS NOT NULL AND r."Review_score" IS NOT NULL
""")
view("seller_sums", """
SELECT category_key, seller_key, count(*) AS n, sum(score) AS total, sum(score * score) AS squares
FROM category_reviews GROUP BY ALL
""")
view("category_fit", """
SELECT category_key, count(*) AS sellers, sum(n) AS all_n, sum(total) / sum(n)::DOUBLE AS category_mean,
  (sum(squares) - sum(total * total / n::DOUBLE)) / nullif(sum(n) - count(*), 0) AS within,
  (sum(total * total / n::DOUBLE) - sum(total) * sum(total) / sum(n)::DOUBLE) / nullif(count(*) - 1, 0) AS spread,
  (sum(n) - sum(n * n) / sum(n)::DOUBLE) / nullif(count(*) - 1, 0) AS size
FROM seller_sums GROUP BY category_key
""")
oracle("seller_reputation", """
SELECT category_key, seller_key, n AS reviews, round(own, 6) AS mean_score, round(category_mean, 6) AS category_mean,
  round(w, 6) AS own_weight, round(w * own + (1 - w) * category_mean, 6) AS reputation
FROM (SELECT *, total / n::DOUBLE AS own, coalesce(n * b / nullif(n * b + within, 0), 0) AS w
  FROM (SELECT *, greatest(0, (spread - within) / nullif(size, 0)) AS b FROM seller_sums JOIN category_fit USING (category_key)))
""")

# --- catalog ---

oracle("catalog_payments_by_order", """
SELECT * REPLACE (CAST("Total_payment_value" AS DOUBLE) AS "Total_payment_value") FROM f_payments
""")
oracle("catalog_lines_by_order", f"""
SELECT {_LINES_AS_DOUBLE}, customer_id, order_status
FROM order_lines l JOIN orders_clean o ON l.order_id = o.order_id
""")

# --- change feed and streaming ---

oracle("cdc_envelope_parse", "SELECT seq, raw_record, op, ts_ms FROM user_feed")
oracle("cdc_bronze_partitions", """
SELECT seq, op, make_timestamp(ts_ms * 1000) AS processing_time,
  strftime(make_timestamp(ts_ms * 1000), '%Y') AS year,
  strftime(make_timestamp(ts_ms * 1000), '%m') AS month,
  strftime(make_timestamp(ts_ms * 1000), '%d') AS day
FROM user_feed
""")
oracle("stream_bronze_append", """
SELECT seq, raw_record, op, ts_ms, TIMESTAMP '2024-02-01 03:04:05' AS processing_time,
  2024 AS year, 2 AS month, 1 AS day FROM user_feed
""")
oracle("stream_rejects", """
SELECT event_id AS seq, CASE WHEN event_id % 7 IN (0, 1) THEN 'rejected' WHEN event_id % 7 = 2 THEN 'unreadable'
  ELSE 'accepted' END AS outcome FROM events
""")
oracle("stream_two_topics", """
SELECT 'orders' AS topic, CASE o_orderstatus WHEN 'P' THEN 'd' WHEN 'O' THEN 'c' ELSE 'u' END AS op,
  count(*) AS changes, min(epoch_ms(o_orderdate)) AS oldest_ms, max(epoch_ms(o_orderdate)) AS newest_ms
FROM orders GROUP BY ALL
UNION ALL
SELECT 'order_items', CASE WHEN l_suppkey % 25 = 0 THEN 'd' ELSE 'u' END, count(*),
  min(epoch_ms(l_shipdate)), max(epoch_ms(l_shipdate)) FROM lineitem GROUP BY ALL
""")
oracle("stream_silver_upsert", "SELECT *, true AS is_active FROM reviews_clean")
oracle("stream_cdc_apply", """
SELECT order_id, order_item_id, product_id, seller_id, shipping_limit_date,
  CAST(price AS DOUBLE) AS price, CAST(freight_value AS DOUBLE) AS freight_value,
  CAST(seller_id AS BIGINT) % 25 <> 0 AS is_active, epoch_ms(shipping_limit_date) AS _ts_ms,
  CAST(product_id AS BIGINT) * 1000000000 + CAST(seller_id AS BIGINT) AS _sequence
FROM (SELECT *, row_number() OVER (PARTITION BY order_id, order_item_id
        ORDER BY shipping_limit_date DESC,
        CAST(product_id AS BIGINT) * 1000000000 + CAST(seller_id AS BIGINT) DESC) AS rn
      FROM feed_items_clean) ranked
WHERE rn = 1
""")
oracle("stream_restart_idempotent", "SELECT * FROM user_state")
