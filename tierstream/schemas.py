"""Declared schemas. Nothing is inferred; every reader names one of these.

Column names and types are fixed values: other jobs read these tables.
"""

ENVELOPE = (
    "key BINARY, value BINARY, topic STRING, partition INT, "
    "offset LONG, timestamp TIMESTAMP, timestampType INT"
)

COUNTRY_LOOKUP = "calling_code STRING, code STRING, country STRING"

# Message payloads, as JSON text inside the envelope's value.
BOOK_MESSAGE = "book_id STRING, title STRING, author STRING, price STRING, updated TIMESTAMP"
CUSTOMER_MESSAGE = (
    "customer_id STRING, email STRING, first_name STRING, last_name STRING, gender STRING, "
    "street STRING, city STRING, country_code STRING, row_status STRING, row_time TIMESTAMP"
)
ORDER_MESSAGE = (
    "order_id STRING, order_timestamp TIMESTAMP, customer_id STRING, quantity BIGINT, total STRING, "
    "books ARRAY<STRUCT<book_id: STRING, quantity: BIGINT, subtotal: STRING>>"
)

# Silver and gold tables.
BOOKS = (
    "book_id STRING, title STRING, author STRING, price DOUBLE, "
    "current BOOLEAN, effective_date TIMESTAMP, end_date TIMESTAMP"
)
CUSTOMERS = (
    "customer_id STRING, email STRING, first_name STRING, last_name STRING, gender STRING, "
    "street STRING, city STRING, country STRING, row_status STRING, row_time TIMESTAMP"
)
ORDERS = (
    "order_id STRING, order_timestamp TIMESTAMP, customer_id STRING, quantity BIGINT, total BIGINT, "
    "books ARRAY<STRUCT<book_id: STRING, quantity: BIGINT, subtotal: BIGINT>>"
)
CUSTOMERS_ORDERS = (
    f"{ORDERS}, email STRING, first_name STRING, last_name STRING, gender STRING, street STRING, "
    "city STRING, country STRING, row_time TIMESTAMP, _change_type STRING, processed_timestamp TIMESTAMP"
)
BOOKS_ORDERS = (
    "order_id STRING, order_timestamp TIMESTAMP, customer_id STRING, quantity BIGINT, total BIGINT, "
    "books STRUCT<book_id: STRING, quantity: BIGINT, subtotal: BIGINT>, "
    "title STRING, author STRING, price DOUBLE"
)
AUTHORS_STATS = (
    "time STRUCT<start: TIMESTAMP, end: TIMESTAMP>, author STRING, "
    "orders_count BIGINT, avg_quantity DOUBLE"
)

# Appended to a table's own columns in its change feed.
CHANGE_COLUMNS = "_change_type STRING, _commit_version BIGINT, _commit_timestamp TIMESTAMP"

BATCH_METRICS = (
    "query STRING, batch_id BIGINT, target STRING, source_rows BIGINT, "
    "committed_at TIMESTAMP, committed_local TIMESTAMP"
)
