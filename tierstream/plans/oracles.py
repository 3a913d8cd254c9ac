"""The same results in SQL over the given tables, for checking the queries."""

from __future__ import annotations

_BOOK = """book AS (
    SELECT p_partkey, CAST(p_partkey AS VARCHAR) AS book_id, p_name AS title, p_brand AS author,
           CAST(round(p_retailprice * 100) AS BIGINT) AS cents
    FROM part)"""

_CUSTOMER = """customers AS (
    SELECT c_custkey, CAST(c_custkey AS VARCHAR) AS customer_id, lower(c_name) || '@example.org' AS email,
           c_mktsegment AS first_name, c_name AS last_name,
           CASE WHEN c_custkey % 2 = 0 THEN 'f' ELSE 'm' END AS gender,
           'Street ' || CAST(c_custkey % 100 AS VARCHAR) AS street,
           'City ' || CAST(c_nationkey AS VARCHAR) AS city, n_name AS country
    FROM customer JOIN nation ON c_nationkey = n_nationkey)"""

_ORDER = """shop_order AS (
    SELECT o_orderkey, CAST(o_orderkey AS VARCHAR) AS order_id,
           o_orderdate + to_seconds(o_orderkey % 86400) AS order_timestamp,
           CAST(o_custkey AS VARCHAR) AS customer_id, o_orderkey % 9 + 1 AS quantity,
           CAST(round(o_totalprice * 100) AS BIGINT) AS cents
    FROM orders)"""

_LINE = """line AS (
    SELECT shop_order.*, l_partkey, CAST(l_partkey AS VARCHAR) AS book_id,
           CAST(l_quantity AS BIGINT) AS line_quantity,
           CAST(round(l_extendedprice * 100) AS BIGINT) AS line_cents
    FROM shop_order JOIN lineitem ON o_orderkey = l_orderkey)"""

_MONEY = "printf('$%d.%02d', {0} // 100, {0} % 100)"

_EVENT_MESSAGES = """
SELECT CAST(event_id AS VARCHAR) AS key, props AS value, 'events' AS topic,
       CAST(user_id % 4 AS INTEGER) AS partition, event_id AS "offset", ts AS timestamp,
       CAST(0 AS INTEGER) AS timestampType
FROM events"""

# Final state of the customer rounds, and what happened in them.
_CUSTOMER_STATE = """state AS (
    SELECT customer_id, email, first_name, last_name, gender,
           CASE WHEN c_custkey % 8 = 0 THEN 'Newer ' || street
                WHEN c_custkey % 4 = 0 THEN 'New ' || street ELSE street END AS street,
           city, country,
           CASE WHEN c_custkey % 4 = 0 THEN 'update' ELSE 'insert' END AS row_status,
           CASE WHEN c_custkey % 8 = 0 THEN TIMESTAMP '2024-02-02'
                WHEN c_custkey % 4 = 0 THEN TIMESTAMP '2024-02-01'
                ELSE TIMESTAMP '2024-01-01' END AS row_time
    FROM customers WHERE c_custkey % 4 <> 1)"""

_WINDOWS = """
SELECT {bucket} AS window_start, {bucket} + {width} AS window_end, {author} AS author,
       count(*) AS orders_count, avg(quantity) AS avg_quantity
FROM {rows} GROUP BY ALL"""


def _windows(rows: str, time: str, width: str, author: str) -> str:
    bucket = f"time_bucket({width}, {time}, TIMESTAMP '1970-01-01')"
    return _WINDOWS.format(bucket=bucket, width=width, author=author, rows=rows)


ORACLES: dict[str, str] = {
    "bronze_envelope_append": _EVENT_MESSAGES,
    "resume_from_checkpoint": _EVENT_MESSAGES,
    "publish_envelope": """
        SELECT CAST(c_custkey AS VARCHAR) AS key,
               '{"customer_id":"' || c_custkey || '","name":"' || c_name ||
               '","country_code":"' || c_nationkey || '"}' AS value,
               'customers' AS topic
        FROM customer""",
    "country_lookup_csv": """
        SELECT CASE WHEN n_nationkey % 4 > 0 THEN '+1-' || n_nationkey END AS calling_code,
               CASE WHEN n_nationkey = 0 THEN 'NA' ELSE CAST(n_nationkey AS VARCHAR) END AS code,
               CASE WHEN n_nationkey % 3 = 0 THEN n_name || ', Republic of' ELSE n_name END AS country
        FROM nation""",
    "parse_payload": """
        SELECT event_id,
               CASE WHEN event_id % 10 > 0 THEN CAST(json_extract_string(props, '$.k') AS BIGINT) END AS k
        FROM events""",
    "clean_keys": """
        WITH dirty AS (
            SELECT c_custkey, CASE c_custkey % 6 WHEN 0 THEN 'NULL' WHEN 1 THEN 'None' WHEN 2 THEN '  '
                                   WHEN 3 THEN ' null ' WHEN 4 THEN NULL ELSE c_name END AS key
            FROM customer)
        SELECT c_custkey, key FROM dirty
        WHERE lower(key) NOT IN ('null', 'none') AND trim(key) <> ''""",
    "extract_price": f"""
        WITH {_BOOK}, texts AS (
            SELECT p_partkey, substr({_MONEY.format('cents')}, 2) AS amount, cents FROM book),
        prices AS (
            SELECT p_partkey, CASE p_partkey % 7
                WHEN 0 THEN '$' || amount WHEN 1 THEN amount || ' USD' WHEN 2 THEN 'No price'
                WHEN 3 THEN '€' || (cents // 100) WHEN 4 THEN '-' || amount
                WHEN 5 THEN '1,' || amount END AS price
            FROM texts)
        SELECT p_partkey, try_cast(regexp_extract(price, '\\d+(\\.\\d+)?') AS DOUBLE) AS price FROM prices
        WHERE try_cast(regexp_extract(price, '\\d+(\\.\\d+)?') AS DOUBLE) IS NOT NULL""",
    "order_subtotals": f"""
        WITH {_ORDER}, {_LINE}
        SELECT order_id, book_id, line_quantity AS quantity, line_cents AS subtotal FROM line""",
    "order_lines_explode": f"""
        WITH {_ORDER}, {_LINE}
        SELECT order_id, customer_id, book_id, {_MONEY.format('line_cents')} AS subtotal FROM line""",
    "dedup_against_target": f"""
        WITH {_BOOK}, target AS (
            SELECT book_id, CASE WHEN p_partkey % 3 = 2 THEN title || ' old' ELSE title END AS title, author, cents
            FROM book WHERE p_partkey % 3 > 0)
        SELECT book_id, title, author, cents / 100.0 AS price FROM book s
        WHERE NOT EXISTS (
            SELECT 1 FROM target t
            WHERE t.book_id = s.book_id AND t.title = s.title AND t.author = s.author AND t.cents = s.cents)""",
    "latest_per_key": """
        SELECT event_id, user_id, event_type, ts FROM events
        QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
    "latest_change_rank": """
        SELECT event_id, user_id, event_type, date_trunc('day', ts) AS day FROM events
        QUALIFY rank() OVER (PARTITION BY user_id, event_type ORDER BY date_trunc('day', ts) DESC) = 1""",
    "stream_dedup": "SELECT DISTINCT user_id, event_type FROM events",
    "stream_dedup_bounded": "SELECT event_id, ts FROM events",
    "order_dedup_pipeline": f"""
        WITH {_ORDER}
        SELECT order_id, order_timestamp, customer_id, quantity, cents / 100.0 AS total FROM shop_order
        WHERE o_orderkey % 7 > 0 AND o_orderkey % 11 > 0 AND o_orderkey % 13 > 0 AND o_orderkey % 17 > 0""",
    "scd2_merge_keys": f"""
        WITH {_BOOK}, found AS (
            SELECT s.book_id, t.book_id AS target_book_id
            FROM book s
            LEFT JOIN (SELECT * FROM book WHERE p_partkey % 3 = 0) t ON s.book_id = t.book_id),
        keyed AS (
            SELECT book_id, book_id AS merge_key, target_book_id FROM found
            UNION ALL
            SELECT book_id, NULL, target_book_id FROM found WHERE target_book_id IS NOT NULL)
        SELECT book_id, merge_key, target_book_id, true AS current,
               TIMESTAMP '2024-02-01' AS effective_date, CAST(NULL AS TIMESTAMP) AS end_date
        FROM keyed""",
    "scd2_books": f"""
        WITH {_BOOK}, versions AS (
            SELECT book_id, title, author, cents, p_partkey % 3 <> 0 AS current,
                   TIMESTAMP '2024-01-01' AS effective_date,
                   CASE WHEN p_partkey % 3 = 0 THEN TIMESTAMP '2024-02-01' END AS end_date
            FROM book
            UNION ALL
            SELECT book_id, title, author, cents + 100, p_partkey % 6 <> 3, TIMESTAMP '2024-02-01',
                   CASE WHEN p_partkey % 6 = 3 THEN TIMESTAMP '2024-03-01' END
            FROM book WHERE p_partkey % 3 = 0
            UNION ALL
            SELECT book_id, title || ' 2nd edition', author, cents + 100, true, TIMESTAMP '2024-03-01', NULL
            FROM book WHERE p_partkey % 6 = 3
            UNION ALL
            SELECT 'N' || book_id, title, author, cents, true, TIMESTAMP '2024-03-01', NULL
            FROM book WHERE p_partkey % 5 = 0)
        SELECT book_id, title, author, cents / 100.0 AS price, current, effective_date, end_date FROM versions""",
    "scd1_customers": f"""
        WITH {_CUSTOMER}, {_CUSTOMER_STATE}
        SELECT * FROM state
        UNION ALL
        SELECT 'D' || customer_id, email, first_name, last_name, gender, street, city, country,
               'delete', TIMESTAMP '2024-02-01'
        FROM customers WHERE c_custkey % 20 = 0""",
    "change_feed": f"""
        WITH {_CUSTOMER}, {_CUSTOMER_STATE}
        SELECT customer_id, street, 'insert' AS row_status, 'insert' AS _change_type,
               CAST(0 AS BIGINT) AS _commit_version FROM customers
        UNION ALL
        SELECT customer_id, street, 'insert', 'update_preimage', 1 FROM customers WHERE c_custkey % 4 = 0
        UNION ALL
        SELECT customer_id, street, row_status, 'update_postimage', 1 FROM state WHERE row_status = 'update'
        UNION ALL
        SELECT customer_id, street, 'insert', 'delete', 1 FROM customers WHERE c_custkey % 4 = 1
        UNION ALL
        SELECT 'D' || customer_id, street, 'delete', 'insert', 1 FROM customers WHERE c_custkey % 20 = 0""",
    "ingest_metrics": f"""
        WITH {_CUSTOMER}
        SELECT 'silver_customers' AS query, CAST(0 AS BIGINT) AS batch_id, 'silver_customers' AS target,
               count(*) AS source_rows FROM customers
        UNION ALL
        SELECT 'silver_customers', 1, 'silver_customers',
               count(*) + count(*) FILTER (c_custkey % 8 = 0) + count(*) FILTER (c_custkey % 20 = 0)
        FROM customers""",
    "country_enrich": f"""
        WITH {_CUSTOMER}
        SELECT customer_id, last_name, country FROM customers
        WHERE country IN (SELECT n_name FROM nation WHERE n_nationkey < 20)""",
    "insert_only_orders": f"""
        WITH {_ORDER}, every AS (
            SELECT * FROM shop_order
            UNION ALL
            SELECT o_orderkey, order_id, order_timestamp + INTERVAL 1 DAY, customer_id, quantity, cents
            FROM shop_order WHERE o_orderkey % 5 = 0)
        SELECT order_id, order_timestamp, customer_id, quantity, cents // 100 AS total,
               CAST(1 AS BIGINT) AS line_count
        FROM every""",
    "books_orders_join": f"""
        WITH {_ORDER}, {_LINE}, {_BOOK}
        SELECT order_id, order_timestamp, customer_id, quantity AS order_quantity, line.cents // 100 AS total,
               line.book_id, line_quantity, line_cents AS subtotal, title, author, book.cents / 100.0 AS price
        FROM line JOIN book ON l_partkey = p_partkey
        WHERE p_partkey % 10 < 9""",
    "customers_orders_stream_join": f"""
        WITH {_ORDER}, {_CUSTOMER}
        SELECT order_id, order_timestamp, customer_id, quantity, cents // 100 AS total, email, country,
               'insert' AS _change_type
        FROM shop_order JOIN customers USING (customer_id)""",
    "customers_orders_upsert": f"""
        WITH {_ORDER}, {_CUSTOMER}, {_CUSTOMER_STATE}
        SELECT order_id, customer_id, quantity, cents // 100 AS total, street, country, row_time,
               CASE WHEN row_status = 'update' THEN 'update_postimage' ELSE 'insert' END AS _change_type
        FROM shop_order JOIN state USING (customer_id)""",
    "authors_stats_window": f"WITH {_ORDER}, {_LINE}"
    + _windows("line JOIN part ON l_partkey = p_partkey", "order_timestamp", "INTERVAL 5 MINUTE", "p_brand"),
    "authors_stats_upsert": f"WITH {_ORDER}, {_LINE}"
    + _windows("line JOIN part ON l_partkey = p_partkey", "order_timestamp", "INTERVAL 1 DAY", "p_brand"),
    "late_data_update": """
        WITH counted AS (
            SELECT ts, event_type, user_id AS quantity FROM events
            WHERE NOT (ts < TIMESTAMP '2024-01-05' AND event_id % 50 = 0))"""
    + _windows("counted", "ts", "INTERVAL 1 HOUR", "event_type"),
    "countries_stats": f"""
        WITH {_ORDER}, {_CUSTOMER}
        SELECT country, date_trunc('day', order_timestamp) AS order_date, count(*) AS orders_count,
               CAST(sum(quantity) AS BIGINT) AS total_books
        FROM shop_order JOIN customers USING (customer_id)
        GROUP BY ALL""",
    "catalog_pipeline": f"""
        WITH {_ORDER}, {_CUSTOMER}
        SELECT country, date_trunc('day', order_timestamp) AS order_date, count(*) AS orders_count,
               CAST(sum(quantity) AS BIGINT) AS total_books
        FROM shop_order JOIN customers USING (customer_id)
        GROUP BY ALL""",
    "catalog_tables": f"""
        WITH {_ORDER}, {_CUSTOMER}, joined AS (
            SELECT country, date_trunc('day', order_timestamp) AS order_date
            FROM shop_order JOIN customers USING (customer_id))
        SELECT layer, name, 'MANAGED' AS kind, CAST(0 AS BIGINT) AS row_count
        FROM (VALUES ('bronze', 'books'), ('bronze', 'customers'), ('bronze', 'orders'), ('silver', 'silver_books'),
            ('silver', 'silver_customers'), ('silver', 'silver_orders'), ('silver', 'silver_books_orders'),
            ('gold', 'gold_authors_stats')) AS empty(layer, name)
        UNION ALL SELECT 'bronze', 'country_lookup', 'MANAGED', count(*) FROM nation
        UNION ALL SELECT 'silver', 'silver_customers_orders', 'MANAGED', count(*) FROM joined
        UNION ALL SELECT 'gold', 'countries_stats_vw', 'VIEW', count(*) FROM (SELECT DISTINCT * FROM joined)""",
}
