"""DuckDB statements that give the same rows as the registered queries of the same name."""

ORDER_DAYS = """
SELECT CAST(o_orderdate AS DATE) dt FROM orders UNION SELECT CAST(o_orderdate AS DATE) + 1 FROM orders
UNION SELECT CAST(o_orderdate AS DATE) + 7 FROM orders UNION SELECT CAST(o_orderdate AS DATE) + 30 FROM orders
"""

SALES_ORDERS = """
SELECT CAST(o_orderkey AS INT) sales_order_id, o_orderdate + INTERVAL '9 hours 30 minutes 15.123456 seconds' created_at,
 o_orderdate + INTERVAL '1 day 10 hours 0.5 seconds' last_updated, CAST(o_orderkey % 100 AS INT) design_id,
 CAST(o_custkey % 10 AS INT) staff_id, CAST(o_custkey AS INT) counterparty_id,
 CAST(o_orderkey % 1000 AS INT) units_sold, o_totalprice unit_price, CAST(o_custkey % 3 AS INT) currency_id,
 CAST(o_orderdate AS DATE) + 7 agreed_delivery_date, CAST(o_orderdate AS DATE) + 30 agreed_payment_date,
 CAST(o_custkey AS INT) agreed_delivery_location_id
FROM orders
"""

STAR_COUNTS = """
SELECT 'dim_design' table_name, count(*) n FROM part UNION ALL SELECT 'dim_location', count(*) FROM customer
UNION ALL SELECT 'dim_counterparty', count(*) FROM customer c JOIN customer a ON c.c_custkey // 2 = a.c_custkey
UNION ALL SELECT 'dim_staff', count(*) FROM supplier JOIN region ON s_nationkey % 5 = r_regionkey
UNION ALL SELECT 'dim_currency', count(*) FROM region
"""

ORDER_DATES = "SELECT DISTINCT CAST(o_orderdate AS DATE) dt FROM orders"

FULL_FACT = f"""
WITH s AS ({SALES_ORDERS})
SELECT CAST(row_number() OVER (ORDER BY sales_order_id) AS BIGINT) sales_record_id, sales_order_id,
 CAST(created_at AS DATE) created_date, strftime(created_at, '%H:%M:%S.%g') created_time,
 CAST(last_updated AS DATE) last_updated_date, strftime(last_updated, '%H:%M:%S.%g') last_updated_time,
 staff_id sales_staff_id, counterparty_id, units_sold, CAST(unit_price AS DECIMAL(10,2)) unit_price, currency_id,
 design_id, agreed_payment_date, agreed_delivery_date, agreed_delivery_location_id FROM s
"""

ORACLES = {
    "dim_date": """
WITH d AS (SELECT CAST(o_orderdate AS DATE) dt FROM orders UNION SELECT CAST(o_orderdate AS DATE) + 7 FROM orders
 UNION SELECT CAST(o_orderdate AS DATE) + 30 FROM orders UNION SELECT CAST(ts AS DATE) FROM events)
SELECT strftime(dt, '%Y-%m-%d') date_id, CAST(year(dt) AS INT) "year", CAST(month(dt) AS INT) "month",
 CAST(day(dt) AS INT) "day", CAST(isodow(dt) AS INT) day_of_week, lower(dayname(dt)) day_name,
 lower(monthname(dt)) month_name, CAST(month(dt) // 3 + 1 AS INT) "quarter" FROM d
""",
    "dim_date_calendar_quarter": """
WITH d AS (SELECT DISTINCT CAST(o_orderdate AS DATE) dt FROM orders)
SELECT strftime(dt, '%Y-%m-%d') date_id, CAST(quarter(dt) AS INT) "quarter" FROM d
""",
    "date_union": """
SELECT DISTINCT dt FROM (SELECT CAST(o_orderdate AS DATE) dt FROM orders
 UNION ALL SELECT CAST(l_shipdate AS DATE) FROM lineitem)
""",
    "dim_design": """
SELECT p_partkey design_id, p_name design_name, p_type file_location, p_brand file_name FROM part
""",
    "dim_location": """
SELECT s_suppkey location_id, s_name address_line_1, CAST(s_nationkey AS INT) district FROM supplier
""",
    "dim_counterparty": """
SELECT c.c_custkey counterparty_id, c.c_name counterparty_legal_name, n.n_name counterparty_legal_country
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
""",
    "dim_staff": """
SELECT s.s_suppkey staff_id, s.s_name first_name, n.n_name department_name
FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey
""",
    "dim_currency": """
SELECT seg currency_code, CASE seg WHEN 'MACHINERY' THEN 'Machinery' WHEN 'BUILDING' THEN 'Building works' END
 currency_name FROM (SELECT DISTINCT c_mktsegment seg FROM customer)
""",
    "fact_sales_order": """
SELECT CAST(row_number() OVER (ORDER BY event_id) AS BIGINT) sales_record_id, event_id sales_order_id,
 strftime(ts, '%Y-%m-%d') created_date, strftime(ts, '%H:%M:%S.%g') created_time, user_id counterparty_id,
 CAST(value AS DECIMAL(10,2)) unit_price FROM events
""",
    "fact_sales_order_full": FULL_FACT,
    "fact_by_text_key": """
WITH k AS (SELECT o_orderpriority, row_number() OVER (ORDER BY o_orderpriority, o_orderkey) record_id FROM orders)
SELECT o_orderpriority, CAST(min(record_id) AS BIGINT) first_id, CAST(max(record_id) AS BIGINT) last_id,
 CAST(count(DISTINCT record_id) AS BIGINT) n_ids FROM k GROUP BY o_orderpriority
""",
    "fact_tied_keys": """
SELECT CAST(row_number() OVER (ORDER BY event_id % 20, user_id NULLS LAST, event_id NULLS LAST, event_type NULLS LAST)
 AS BIGINT) record_id, event_id % 20 k, user_id, event_id, event_type FROM events
""",
    "star_dim_counterparty": """
SELECT CAST(c.c_custkey AS INT) counterparty_id, c.c_name counterparty_legal_name,
 '1 ' || a.c_name counterparty_legal_address_line_1, CAST(NULL AS VARCHAR) counterparty_legal_address_line_2,
 CASE WHEN a.c_custkey % 2 = 0 THEN a.c_mktsegment END counterparty_legal_district,
 'City ' || CAST(a.c_nationkey AS VARCHAR) counterparty_legal_city,
 lpad(CAST(a.c_custkey AS VARCHAR), 9, '0') counterparty_legal_postal_code,
 'Country ' || CAST(a.c_nationkey AS VARCHAR) counterparty_legal_country, '0000 000000' counterparty_legal_phone_number
FROM customer c JOIN customer a ON c.c_custkey // 2 = a.c_custkey
""",
    "star_dim_staff": """
SELECT CAST(s_suppkey AS INT) staff_id, s_name first_name, 'Smith' last_name, r_name department_name,
 'House ' || r_name "location", lower(s_name) || '@example.com' email_address
FROM supplier JOIN region ON s_nationkey % 5 = r_regionkey
""",
    "star_dim_location": """
SELECT CAST(c_custkey AS INT) location_id, '1 ' || c_name address_line_1, CAST(NULL AS VARCHAR) address_line_2,
 CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment END district, 'City ' || CAST(c_nationkey AS VARCHAR) city,
 lpad(CAST(c_custkey AS VARCHAR), 9, '0') postal_code, 'Country ' || CAST(c_nationkey AS VARCHAR) country,
 '0000 000000' phone FROM customer
""",
    "dim_payment_type": """
SELECT CAST(row_number() OVER (ORDER BY p) AS BIGINT) payment_type_id, p payment_type_name
FROM (SELECT DISTINCT o_orderpriority p FROM orders)
""",
    "dim_transaction": """
SELECT o_orderkey transaction_id, CASE WHEN o_orderstatus = 'F' THEN 'SALE' ELSE 'PURCHASE' END transaction_type,
 CASE WHEN o_orderstatus = 'F' THEN o_orderkey END sales_order_id,
 CASE WHEN o_orderstatus <> 'F' THEN o_orderkey END purchase_order_id FROM orders
""",
    "fact_purchase_order": f"""
WITH s AS ({SALES_ORDERS})
SELECT CAST(row_number() OVER (ORDER BY sales_order_id) AS BIGINT) purchase_record_id,
 sales_order_id purchase_order_id, strftime(created_at, '%Y-%m-%d') created_date,
 strftime(created_at, '%H:%M:%S.%g') created_time, strftime(last_updated, '%Y-%m-%d') last_updated_date,
 strftime(last_updated, '%H:%M:%S.%g') last_updated_time, staff_id, counterparty_id,
 'item-' || CAST(design_id AS VARCHAR) item_code, units_sold item_quantity,
 CAST(unit_price AS DECIMAL(10,2)) item_unit_price, currency_id,
 strftime(agreed_delivery_date, '%Y-%m-%d') agreed_delivery_date,
 strftime(agreed_payment_date, '%Y-%m-%d') agreed_payment_date, agreed_delivery_location_id FROM s
""",
    "fact_payment": """
SELECT CAST(row_number() OVER (ORDER BY event_id) AS BIGINT) payment_record_id, event_id payment_id,
 strftime(ts, '%Y-%m-%d') created_date, strftime(ts, '%H:%M:%S.%g') created_time,
 strftime(ts + INTERVAL 1 DAY, '%Y-%m-%d') last_updated_date,
 strftime(ts + INTERVAL 1 DAY, '%H:%M:%S.%g') last_updated_time, CAST(event_id % 1000 AS BIGINT) transaction_id,
 user_id counterparty_id, CAST(value AS DECIMAL(10,2)) payment_amount, CAST(event_id % 3 AS BIGINT) currency_id,
 CAST(event_id % 5 AS BIGINT) payment_type_id, event_type = 'purchase' paid,
 strftime(ts, '%Y-%m-%d') payment_date FROM events
""",
    "nullsafe_join": """
WITH a AS (SELECT event_id, nullif(event_type, 'error') k FROM events), r(k, v) AS (VALUES (NULL, 'none'), ('click', 'C'))
SELECT a.event_id, r.v FROM a JOIN r ON a.k IS NOT DISTINCT FROM r.k
""",
    "like_escape_filter": """
WITH t AS (SELECT CASE WHEN event_id % 3 = 0 THEN '_' || event_type ELSE event_type END nm, event_id FROM events)
SELECT event_id, nm FROM t WHERE nm NOT LIKE '!_%' ESCAPE '!'
""",
    "json_scalar": """
SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) k FROM events
""",
    "flatten_records": """
SELECT event_id, event_type "detail.event_type", CAST(json_extract(props, '$.k') AS BIGINT) "detail.props.k" FROM events
""",
    "record_text": """
SELECT o_orderkey, '{"o_orderkey":' || o_orderkey || ',"status":'
 || CASE WHEN o_orderstatus = 'F' THEN 'null' ELSE '"' || o_orderstatus || '"' END
 || ',"at":"' || strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') || '.123"}' record FROM orders
""",
    "json_snapshot_roundtrip": """
SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%g') created_at, event_type, value FROM events
""",
    "json_array_scan": """
SELECT 'order' kind, o_orderkey id FROM orders UNION ALL SELECT 'customer', o_custkey FROM orders
""",
    "json_array_split": """
SELECT l_orderkey, l_linenumber, l_quantity, CASE WHEN l_orderkey % 5 = 0 THEN l_returnflag || '}, {"a": "]}'
  WHEN l_orderkey % 7 = 0 THEN '}\\' ELSE l_returnflag END AS note
FROM lineitem
""",
    "json_drift": """
WITH kept AS (SELECT event_id, event_id % 11 = 0 AS odd, value IS NOT NULL AND event_id % 5 <> 0 AS valued FROM events),
drift AS (
  SELECT 'event_id' AS column_name, 'retyped' AS change, 'bigint' AS declared, 'STRING' AS found, count(*) FILTER (odd) AS n
  FROM kept
  UNION ALL SELECT 'value', 'retyped', 'double', 'STRING', count(*) FILTER (odd) FROM kept
  UNION ALL SELECT 'value', 'missing', 'double', NULL, count(*) FILTER (NOT odd AND NOT valued) FROM kept
  UNION ALL SELECT 'created_at', 'missing', 'string', NULL, count(*) FROM kept
  UNION ALL SELECT 'user_note', 'added', NULL, 'STRING', count(*) FILTER (NOT odd AND event_id % 3 = 0) FROM kept
  UNION ALL SELECT 'users', 'added', NULL, 'ARRAY', count(*) FILTER (NOT odd AND event_id % 7 = 0) FROM kept)
SELECT * FROM drift WHERE n > 0
""",
    "json_escapes": """
SELECT p_partkey design_id, '/usr/' || p_type file_location, 'proper' reading FROM part
UNION ALL SELECT p_partkey, '\\/usr\\/' || p_type, 'raw' FROM part
""",
    "csv_snapshot_roundtrip": """
SELECT c_custkey, c_name, c_nationkey, c_acctbal FROM customer
""",
    "parquet_snapshot_roundtrip": """
SELECT o_orderkey, o_custkey, o_orderdate, o_totalprice FROM orders
""",
    "full_refresh_idempotent": """
SELECT CAST(count(*) AS BIGINT) n, CAST(count(DISTINCT o_orderkey) AS BIGINT) n_keys FROM orders
""",
    "warehouse_table_counts": """
SELECT 'customer' table_name, CAST(count(*) AS BIGINT) n FROM customer UNION ALL SELECT 'part', count(*) FROM part
UNION ALL SELECT 'orders', count(*) FROM orders UNION ALL SELECT 'events', count(*) FROM events
""",
    "preview_limit": """
SELECT c_custkey, c_name FROM customer ORDER BY c_custkey LIMIT 10
""",
    "manifest_lines": """
SELECT 'Uploaded: data/20240101_000000/' || table_name || '.json at 2024-01-01 00:00:00' line
FROM (SELECT 'region' table_name, count(*) n FROM region UNION ALL SELECT 'orders', count(*) FROM orders) WHERE n > 0
""",
    "manifest_states": """
SELECT table_name, CASE WHEN n = 0 THEN 'skipped_empty' ELSE 'uploaded' END status, CAST(n AS BIGINT) row_count
FROM (SELECT 'region' table_name, count(*) n FROM region UNION ALL SELECT 'empty', count(*) FROM region WHERE false
 UNION ALL SELECT 'orders', count(*) FROM orders)
""",
    "batch_status": """
SELECT event_type, bool_and(value > 1) all_ok,
 CAST(count(DISTINCT CASE WHEN value <= 1 THEN event_id % 5 END) AS BIGINT) n_bad_codes
FROM events GROUP BY event_type
""",
    "incremental_filter": """
SELECT event_id, user_id FROM events WHERE ts > TIMESTAMP '2024-01-15 00:00:00'
""",
    "incremental_merge": """
WITH tied AS (
  SELECT o_orderkey AS id, o_totalprice AS price, CASE WHEN o_orderkey % 25 = 7 THEN TIMESTAMP '2029-01-01'
    ELSE o_orderdate + INTERVAL '34 hours' + INTERVAL '500 milliseconds' END AS at FROM orders),
later AS (
  SELECT id, price + CASE WHEN id % 50 = 7 THEN 1 WHEN id % 10 = 1 THEN 2 ELSE 0 END AS price,
    CASE WHEN id % 3 = 0 OR (id % 10 = 1 AND id % 50 <> 7) THEN TIMESTAMP '2030-01-01' ELSE t.at END AS at FROM tied t)
SELECT CAST(id AS INTEGER) AS sales_order_id, price AS unit_price, strftime(later.at, '%Y-%m-%dT%H:%M:%S.%g') AS last_updated,
  (SELECT count(*) FROM later l WHERE l.at >= (SELECT max(t.at) FROM tied t WHERE id % 3 <> 0)) AS n_landed
FROM later
""",
    "stable_keys": """
WITH early AS (SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey % 3 <> 0)
SELECT row_number() OVER (ORDER BY o_orderkey) AS sales_record_id, CAST(o_orderkey AS INTEGER) AS sales_order_id,
  o_totalprice AS unit_price
FROM early
UNION ALL
SELECT (SELECT count(*) FROM early) + row_number() OVER (ORDER BY o_orderkey), CAST(o_orderkey AS INTEGER), o_totalprice
FROM orders WHERE o_orderkey % 3 = 0
""",
    "latest_version": """
SELECT user_id, event_id, ts, event_type FROM (
 SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) r FROM events) WHERE r = 1
""",
    "dq_pk_duplicates": """
SELECT l_orderkey, l_linenumber, CAST(count(*) AS BIGINT) n FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
""",
    "dq_not_null": """
SELECT CAST(count(*) - count(nullif(event_type, 'error')) AS BIGINT) event_type_nulls,
 CAST(count(*) - count(user_id) AS BIGINT) user_id_nulls FROM events
""",
    "dq_fk_orphans": """
SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem l
WHERE NOT EXISTS (SELECT 1 FROM part p WHERE p.p_size < 40 AND p.p_partkey = l.l_partkey)
""",
    "dq_fk_counts": """
SELECT 'l_partkey' column_name, CAST(l_partkey AS VARCHAR) "value", CAST(count(*) AS BIGINT) n FROM lineitem
WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size < 40) GROUP BY l_partkey
UNION ALL SELECT 'l_suppkey', CAST(l_suppkey AS VARCHAR), count(*) FROM lineitem
WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_nationkey < 20) GROUP BY l_suppkey
""",
    "bucketed_lines": """
WITH places AS (
  SELECT l_orderkey, l_linenumber, count(*) n, sum(CAST(l_extendedprice AS DECIMAL(18,2))) amount FROM lineitem GROUP BY 1, 2),
each AS (SELECT l_orderkey, sum(n) n_lines, sum(n - 1) n_repeated, sum(amount) amount FROM places GROUP BY 1)
SELECT o_orderkey, o_orderstatus, CAST(coalesce(n_lines, 0) AS BIGINT) n_lines,
 CAST(coalesce(n_repeated, 0) AS BIGINT) n_repeated, CAST(amount AS DECIMAL(28,2)) amount
FROM orders LEFT JOIN each ON o_orderkey = l_orderkey
""",
    "stream_completeness": """
SELECT CAST(user_id AS VARCHAR) || '-' || CAST((day(ts) - 1) // 7 AS VARCHAR) batch_id FROM events
GROUP BY 1 HAVING count(DISTINCT event_type) = 5
""",
    "dq_numeric_fit": """
SELECT o_orderkey, o_totalprice FROM orders
WHERE TRY_CAST(o_totalprice * 1000 AS DECIMAL(10,2)) IS NULL AND o_totalprice IS NOT NULL
""",
    "dq_date_parse": """
WITH t AS (SELECT event_id, CASE WHEN event_id % 7 = 0 THEN '2024-13-01' ELSE strftime(ts, '%Y-%m-%d') END d FROM events)
SELECT event_id, d FROM t WHERE TRY_CAST(d AS DATE) IS NULL
""",
    "dq_report": """
WITH found AS (
 SELECT 'not_null' rule, 'last_updated_date' column_name, count(*) n FROM orders WHERE o_orderkey % 13 = 0
 UNION ALL SELECT 'type', 'created_time', count(*) FROM orders WHERE o_orderkey % 11 = 0
 UNION ALL SELECT 'type', 'agreed_payment_date', count(*) FROM orders WHERE o_orderkey % 7 = 0
 UNION ALL SELECT 'type', 'unit_price', count(*) FROM orders
  WHERE TRY_CAST(o_totalprice * 1000 AS DECIMAL(10,2)) IS NULL
 UNION ALL SELECT 'primary_key', 'sales_record_id', count(*) FROM (
  SELECT 1 FROM orders GROUP BY CASE WHEN o_orderkey % 10 = 1 THEN o_orderkey - 1 ELSE o_orderkey END
  HAVING count(*) > 1)
 UNION ALL SELECT 'foreign_key', 'sales_staff_id', count(*) FROM orders WHERE o_orderkey % 30 >= 25
 UNION ALL SELECT 'foreign_key', 'currency_id', count(*) FROM orders WHERE o_orderkey % 6 = 5
 UNION ALL SELECT 'foreign_key', 'design_id', count(*) FROM orders WHERE o_orderkey % 100 >= 90)
SELECT 'fact_sales_order' table_name, rule, column_name, CAST(n AS BIGINT) n FROM found WHERE n > 0
""",
    "dq_dimensions": f"""
WITH found AS (
 SELECT 'dim_date' table_name, 'not_null' rule, 'day_name' column_name, count(*) n
  FROM ({ORDER_DATES}) WHERE day(dt) = 13
 UNION ALL SELECT 'dim_design', 'primary_key', 'design_id', count(*) FROM (
  SELECT 1 FROM part GROUP BY p_partkey // 2 HAVING count(*) > 1)
 UNION ALL SELECT 'dim_location', 'not_null', 'city', count(*) FROM customer WHERE c_custkey % 17 = 0
 UNION ALL SELECT 'dim_counterparty', 'primary_key', 'counterparty_id', count(*) FROM (
  SELECT 1 FROM customer c JOIN customer a ON c.c_custkey // 2 = a.c_custkey GROUP BY c.c_custkey // 3
  HAVING count(*) > 1)
 UNION ALL SELECT 'dim_staff', 'not_null', 'email_address', count(*)
  FROM supplier JOIN region ON s_nationkey % 5 = r_regionkey WHERE s_suppkey % 4 = 0
 UNION ALL SELECT 'dim_currency', 'not_null', 'currency_name', count(*) FROM region WHERE r_regionkey >= 3)
SELECT table_name, rule, column_name, CAST(n AS BIGINT) n FROM found WHERE n > 0
""",
    "star_batch_refresh": f"""
SELECT table_name, CAST(n AS BIGINT) n FROM ({STAR_COUNTS}
UNION ALL SELECT 'fact_sales_order', count(*) FROM orders
UNION ALL SELECT 'dim_date', count(*) FROM ({ORDER_DAYS}))
""",
    "loaded_all_targets": f"""
SELECT table_name, CAST(n AS BIGINT) n, CAST(NULL AS DECIMAL(38,2)) amount FROM ({STAR_COUNTS}
UNION ALL SELECT 'fact_sales_order', count(*) FROM orders
UNION ALL SELECT 'fact_purchase_order', count(*) FROM orders
UNION ALL SELECT 'fact_payment', count(*) FROM orders
UNION ALL SELECT 'dim_transaction', count(*) FROM orders
UNION ALL SELECT 'dim_payment_type', count(*) FROM region
UNION ALL SELECT 'dim_date', count(*) FROM ({ORDER_DAYS}))
UNION ALL
SELECT r_name, count(*), CAST(sum(CAST(o_totalprice AS DECIMAL(28,2))) AS DECIMAL(38,2))
FROM orders JOIN region ON r_regionkey = o_orderkey % 5 WHERE o_orderstatus = 'F' GROUP BY r_name
""",
    "snapshot_stream": f"""
WITH batches(batch_id) AS (VALUES ('20240101_000000'), ('20240102_000000')),
counts AS (SELECT batch_id, c.* FROM batches, ({STAR_COUNTS}) c
 UNION ALL SELECT '20240101_000000', 'fact_sales_order', 2 * count(*) FROM orders
 UNION ALL SELECT '20240102_000000', 'fact_sales_order', count(*) FROM orders
 UNION ALL SELECT '20240101_000000', 'dim_date', count(*) FROM (
  {ORDER_DAYS} UNION SELECT CAST(o_orderdate - INTERVAL 1 YEAR AS DATE) FROM orders)
 UNION ALL SELECT '20240102_000000', 'dim_date', count(*) FROM ({ORDER_DAYS}))
SELECT batch_id, table_name, CASE WHEN n > 0 THEN 'uploaded' ELSE 'skipped_empty' END status,
 CAST(n AS BIGINT) row_count FROM counts
""",
    "loaded_fact_sales_order": FULL_FACT,
    "loaded_dim_currency": """
SELECT CAST(r_regionkey AS INT) currency_id, list_extract(['GBP', 'USD', 'EUR', 'CHF', 'JPY'], r_regionkey + 1) currency_code,
 list_extract(['Great British Pounds', 'United States Dollars', 'Euro', 'Swiss Franc', 'Yen'], r_regionkey + 1) currency_name
FROM region
""",
    "stream_load_order": """
SELECT '20240102_000000' batch_id, CAST(count(*) AS BIGINT) n,
 CAST(sum(CAST(o_totalprice + 1 AS DECIMAL(10,2))) AS DECIMAL(28,2)) revenue FROM orders
""",
    "bi_heatmap": """
SELECT CAST(year(o_orderdate) AS INT) "year", CAST(isodow(o_orderdate) AS INT) day_of_week,
 CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(28,2)) revenue, CAST(count(*) AS BIGINT) n
FROM orders GROUP BY 1, 2
""",
    "bi_star_rollup": """
SELECT n.n_name country, CAST(year(o.o_orderdate) AS INT) "year",
 CAST(sum(CAST(o.o_totalprice AS DECIMAL(18,2))) AS DECIMAL(28,2)) revenue
FROM orders o LEFT JOIN (customer c JOIN nation n ON c.c_nationkey = n.n_nationkey) ON o.o_custkey = c.c_custkey
GROUP BY 1, 2
""",
    "bi_months": """
SELECT CAST(strftime(o_orderdate, '%Y%m') AS INT) "month", CAST(count(*) AS BIGINT) n, month(o_orderdate) < 4 rewritten,
 CAST(sum(CAST(o_totalprice + CASE WHEN month(o_orderdate) < 4 THEN 1 ELSE 0 END AS DECIMAL(10,2))) AS DECIMAL(28,2)) revenue
FROM orders WHERE year(o_orderdate) = 1997 GROUP BY 1, 3
""",
}

ORACLES["dq_fk_bitmaps"] = ORACLES["dq_fk_counts"]
ORACLES["loaded_dim_counterparty"] = ORACLES["star_dim_counterparty"]
