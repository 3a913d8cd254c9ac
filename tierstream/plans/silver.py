"""Silver: cleaned, deduplicated and joined tables."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tierstream import schemas
from tierstream.operators.clean import keep_usable_keys, parse_payload, price_to_number
from tierstream.operators.dedup import drop_known_rows, first_arrivals, rows_and_days, rows_not_in
from tierstream.operators.history import with_merge_keys
from tierstream.operators.joins import add_country, changes_with_orders, heavy_keys, lines_with_books
from tierstream.operators.latest import newest_per_key, newest_with_ties
from tierstream.operators.merge import BOOK_HISTORY, CUSTOMER_ORDER_STATE, CUSTOMER_STATE
from tierstream.operators.orders import clean_subtotals, explode_lines
from tierstream.plans.lake import Lake
from tierstream.sources import files
from tierstream.streaming.metrics import record
from tierstream.streaming.run import BatchHandler, Trigger, for_each_batch

# Tells copies of a message apart, to spread them before the dedup.
_POSITION = ["partition", "offset"]

# What the cleaning of a topic carries along with the payload, to the end of the dedup.
_ENVELOPE = (*_POSITION, "timestamp")

# Slices per key in the arrival dedup; 1 halves the state but lets a hot key sit in one task.
SPREAD = 4

# Book columns that say when a version holds, not what it says.
_VALIDITY = ["current", "effective_date", "end_date"]

# Kinds of change that carry a customer's newest state.
_EFFECTIVE_CHANGES = ["insert", "update_postimage", "delete"]


def as_schema(rows: DataFrame, schema: str) -> DataFrame:
    """Columns in the schema's order and types; fractions are cut off for whole-number columns."""
    return rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in StructType.fromDDL(schema)])


# --- books -------------------------------------------------------------------


def first_messages(rows: DataFrame, keys: list[str], spread: int, forget_after: str | None) -> DataFrame:
    """First message per key: of all time, or if ``forget_after`` is given, of at least that
    long. The state then holds the keys of that span only; a copy that arrives later passes
    as new. Time is the message's own time in its topic."""
    if forget_after:
        rows = rows.withWatermark("timestamp", forget_after)
    return first_arrivals(rows, keys, spread, _POSITION, forget_after is not None).drop(*_ENVELOPE)


def clean_books(messages: DataFrame, spread: int = SPREAD, forget_after: str | None = None) -> DataFrame:
    """Book messages to typed versions, one per book and update time.

    The dedup comes before the price check: a first copy that fails it has used up its key.
    Unusable keys go before the dedup: they could only use up themselves, and messages
    without a key would all meet in one task and one state entry.
    """
    versions = keep_usable_keys(parse_payload(messages, schemas.BOOK_MESSAGE, keep=_ENVELOPE), "book_id")
    return price_to_number(first_messages(versions, ["book_id", "updated"], spread, forget_after), "price")


def upsert_books(lake: Lake, name: str) -> BatchHandler:
    """Type 2 history: drop versions whose content is known, close and add the rest."""

    def handle(batch: DataFrame, writer: str, batch_id: int) -> None:
        books = lake.books
        known = books.read_like(batch).persist()
        fresh = drop_known_rows(batch, known, _VALIDITY).persist()
        try:
            rows = fresh.count()
            record(lake.metrics, name, writer, batch_id, "silver_books", rows)
            if rows:
                books.merge(with_merge_keys(fresh, known), BOOK_HISTORY, writer, batch_id)
        finally:
            fresh.unpersist()
            known.unpersist()

    return handle


def silver_books(
    lake: Lake, trigger: Trigger = Trigger(), name: str = "silver_books", forget_after: str | None = None
) -> StreamingQuery:
    rows = clean_books(lake.topic("books"), forget_after=forget_after)
    return for_each_batch(rows, upsert_books(lake, name), lake.checkpoint("silver", "silver_books"), name, trigger)


# --- customers ---------------------------------------------------------------


def clean_customers(messages: DataFrame) -> DataFrame:
    """Customer messages to typed rows, still with a country code."""
    return keep_usable_keys(parse_payload(messages, schemas.CUSTOMER_MESSAGE), "customer_id")


def upsert_customers(lake: Lake, name: str) -> BatchHandler:
    """Type 1 with deletes, from the newest row per customer of the batch.

    The lookup is read per batch, so a reload takes effect with the next one.
    """

    def handle(batch: DataFrame, writer: str, batch_id: int) -> None:
        customers = add_country(batch, lake.country_lookup)
        rows = customers.count()
        record(lake.metrics, name, writer, batch_id, "silver_customers", rows)
        if rows:
            newest = newest_per_key(customers, ["customer_id"], "row_time")
            lake.customers.merge(newest, CUSTOMER_STATE, writer, batch_id)

    return handle


def silver_customers(lake: Lake, trigger: Trigger = Trigger(), name: str = "silver_customers") -> StreamingQuery:
    rows = clean_customers(lake.topic("customers"))
    checkpoint = lake.checkpoint("silver", "silver_customers")
    return for_each_batch(rows, upsert_customers(lake, name), checkpoint, name, trigger)


# --- orders ------------------------------------------------------------------


def clean_orders(messages: DataFrame, spread: int = SPREAD, forget_after: str | None = None) -> DataFrame:
    """Order messages to typed orders, one per order and time; as for books, dedup first."""
    orders = parse_payload(messages, schemas.ORDER_MESSAGE, keep=_ENVELOPE).filter("quantity > 0")
    orders = keep_usable_keys(orders, "order_id")
    orders = first_messages(orders, ["order_id", "order_timestamp"], spread, forget_after)
    return price_to_number(keep_usable_keys(orders, "customer_id"), "total")


def insert_orders(lake: Lake, name: str) -> BatchHandler:
    """Insert-only: orders not stored yet. Array work happens here, without stream state."""

    def handle(batch: DataFrame, writer: str, batch_id: int) -> None:
        orders = as_schema(clean_subtotals(batch), schemas.ORDERS)
        rows, days = rows_and_days(orders, "order_timestamp")
        record(lake.metrics, name, writer, batch_id, "silver_orders", rows)
        if rows:
            stored = lake.orders.read_days(days)
            lake.orders.append(rows_not_in(orders, stored, ["order_id", "order_timestamp"]), writer, batch_id)

    return handle


def silver_orders(
    lake: Lake, trigger: Trigger = Trigger(), name: str = "silver_orders", forget_after: str | None = None
) -> StreamingQuery:
    rows = clean_orders(lake.topic("orders"), forget_after=forget_after)
    return for_each_batch(rows, insert_orders(lake, name), lake.checkpoint("silver", "silver_orders"), name, trigger)


# --- order lines with books --------------------------------------------------


def append_books_orders(lake: Lake) -> BatchHandler:
    """Join each batch with the books as they are now; lines without a book are lost."""

    def handle(batch: DataFrame, writer: str, batch_id: int) -> None:
        lines = lines_with_books(explode_lines(batch), lake.books.read())
        lake.books_orders.append(as_schema(lines, schemas.BOOKS_ORDERS), writer, batch_id)

    return handle


def silver_books_orders(
    lake: Lake, trigger: Trigger = Trigger(), name: str = "silver_books_orders"
) -> StreamingQuery:
    checkpoint = lake.checkpoint("silver", "silver_books_orders")
    orders = lake.orders.stream(**lake.pace)
    return for_each_batch(orders, append_books_orders(lake), checkpoint, name, trigger, reread=False)


# --- orders with customers ---------------------------------------------------


def upsert_customers_orders(lake: Lake, name: str) -> BatchHandler:
    """Bring each order's customer columns to the newest change."""

    def handle(batch: DataFrame, writer: str, batch_id: int) -> None:
        moment = "_commit_timestamp"
        rows, first, last = batch.agg(F.count("*"), F.min(F.struct(moment)), F.max(moment)).first()
        record(lake.metrics, name, writer, batch_id, "silver_customers_orders", rows)
        if not rows:
            return
        newest = batch.filter(F.col("_change_type").isin(_EFFECTIVE_CHANGES))
        if first[moment] != last:  # all changes of one commit are equally new
            newest = newest_with_ties(newest, ["order_id", "customer_id"], moment)
        source = newest.drop("_commit_version").withColumnRenamed("_commit_timestamp", "processed_timestamp")
        lake.customers_orders.merge(source, CUSTOMER_ORDER_STATE, writer, batch_id)

    return handle


def customers_orders_stream(
    lake: Lake,
    customers_watermark: str = "70 seconds",
    orders_watermark: str = "40 seconds",
    salts: int = 8,
    within: str | None = None,
    hot: list[str] | None = None,
) -> DataFrame:
    """Customer changes joined with orders, both as streams."""
    changes = lake.customers.changes.stream(**lake.pace).withWatermark("row_time", customers_watermark)
    orders = lake.orders.stream(**lake.pace).withWatermark("order_timestamp", orders_watermark)
    return changes_with_orders(changes, orders, salts, within, hot)


def kept_hot_customers(lake: Lake, checkpoint: str, settled: int = 100_000) -> list[str] | None:
    """The customers whose orders the join deals into slices, for the life of a checkpoint.

    They are found in the orders stored at the query's first start, where at least
    ``settled`` are, and written beside the checkpoint: state that was dealt one way must
    be looked up that way. With fewer orders to go by, None: every customer is sliced.
    """
    path, spark = f"{checkpoint}_hot.json", lake.spark
    if not files.exists(spark, path):
        known = not files.exists(spark, checkpoint)  # else state without a list is there already
        known = known and lake.orders.read().limit(settled).count() == settled
        found = heavy_keys(lake.orders.read(), "customer_id") if known else None
        staged = f"{path}.{uuid.uuid4().hex}"
        files.write_text(spark, staged, json.dumps(found))
        files.publish(spark, staged, path)
    return json.loads(files.read_text(spark, path))


def silver_customers_orders(
    lake: Lake,
    trigger: Trigger = Trigger(),
    customers_watermark: str = "70 seconds",
    orders_watermark: str = "40 seconds",
    name: str = "silver_customers_orders",
    salts: int = 8,
    within: str | None = None,
) -> StreamingQuery:
    checkpoint = lake.checkpoint("silver", "silver_customers_orders")
    hot = kept_hot_customers(lake, checkpoint)
    rows = customers_orders_stream(lake, customers_watermark, orders_watermark, salts, within, hot)
    return for_each_batch(rows, upsert_customers_orders(lake, name), checkpoint, name, trigger)
