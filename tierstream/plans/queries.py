"""The operators and pipelines as queries over the given tables."""

from __future__ import annotations

import functools
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierstream import schemas
from tierstream.operators import clean, stats
from tierstream.operators.clean import keep_usable_keys, price_to_number
from tierstream.operators.dedup import drop_known_rows, first_arrivals
from tierstream.operators.history import with_merge_keys
from tierstream.operators.joins import add_country, changes_with_orders, lines_with_books
from tierstream.operators.latest import newest_per_key, newest_with_ties
from tierstream.operators.orders import clean_subtotals, explode_lines
from tierstream.plans import gold, shop, silver
from tierstream.plans.bronze import ingest_topic
from tierstream.plans.lake import Lake
from tierstream.session import pipeline_session, working_folder
from tierstream.sources import files, lookup
from tierstream.sources.topics import folder_topic, publish
from tierstream.streaming import catalog
from tierstream.streaming.catalog import Namespace
from tierstream.streaming.run import DRAIN, append_to_folder, append_to_table, drain

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}


def query(build: Query) -> Query:
    """Register a query under its name; it runs in a session with our settings."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        return build(pipeline_session(spark), folder)

    QUERIES[build.__name__] = run
    return run


def new_lake(spark: SparkSession, purpose: str) -> Lake:
    return Lake(spark, working_folder(spark, purpose)).create()


def flat_windows(windows: DataFrame) -> DataFrame:
    return windows.select(
        F.col("time.start").alias("window_start"),
        F.col("time.end").alias("window_end"),
        "author", "orders_count", "avg_quantity",
    )


# --- sources and bronze ------------------------------------------------------


def _event_messages(events: DataFrame) -> DataFrame:
    return events.select(
        F.col("event_id").cast("string").cast("binary").alias("key"),
        F.col("props").cast("binary").alias("value"),
        F.lit("events").alias("topic"),
        (F.col("user_id") % 4).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ts").alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )


def _readable(envelopes: DataFrame) -> DataFrame:
    return envelopes.select(
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
        "topic", "partition", "offset", "timestamp", "timestampType",
    )


@query
def bronze_envelope_append(spark: SparkSession, folder: str) -> DataFrame:
    """A topic streamed into its bronze table."""
    lake = new_lake(spark, "bronze_envelope_append")
    messages = _event_messages(shop.table_stream(spark, folder, "events"))
    drain(ingest_topic(lake, "events", messages, DRAIN))
    return _readable(spark.read.parquet(lake.path("bronze", "events")))


@query
def resume_from_checkpoint(spark: SparkSession, folder: str) -> DataFrame:
    """Two runs of the same ingest with new messages in between: nothing twice, nothing lost."""
    lake = new_lake(spark, "resume_from_checkpoint")
    events = _event_messages(shop.table(spark, folder, "events"))
    inbox = lake.path("inbox", "events")
    for part in (0, 1):
        events.filter(F.col("offset") % 2 == part).write.mode("append").parquet(inbox)
        drain(ingest_topic(lake, "events", folder_topic(spark, inbox), DRAIN))
    return _readable(spark.read.parquet(lake.path("bronze", "events")))


@query
def publish_envelope(spark: SparkSession, folder: str) -> DataFrame:
    """JSON lines published as keyed messages."""
    root = working_folder(spark, "publish_envelope")
    documents = shop.table(spark, folder, "customer").select(
        shop.text("c_custkey").alias("customer_id"),
        F.col("c_name").alias("name"),
        shop.text("c_nationkey").alias("country_code"),
    )
    documents.write.json(f"{root}/lines")
    publish(spark, f"{root}/lines", "customer_id", "customers", f"{root}/topic")
    messages = spark.read.schema(schemas.ENVELOPE).parquet(f"{root}/topic")
    return messages.select(
        F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"), "topic"
    )


@query
def country_lookup_csv(spark: SparkSession, folder: str) -> DataFrame:
    """The lookup through CSV: missing values, the code NA and quoted commas."""
    lake = new_lake(spark, "country_lookup_csv")
    number = F.col("n_nationkey")
    rows = shop.table(spark, folder, "nation").select(
        F.when(number % 4 > 0, F.concat(F.lit("+1-"), number.cast("string"))).alias("calling_code"),
        F.when(number == 0, "NA").otherwise(number.cast("string")).alias("code"),
        F.when(number % 3 == 0, F.concat("n_name", F.lit(", Republic of"))).otherwise(F.col("n_name")).alias("country"),
    )
    rows.write.option("header", True).csv(lake.path("inbox", "countries"))
    lookup.load_countries(spark, lake.path("inbox", "countries"), lake.path("bronze", "country_lookup"))
    return lake.country_lookup


# --- cleaning ----------------------------------------------------------------


@query
def parse_payload(spark: SparkSession, folder: str) -> DataFrame:
    """JSON bytes to typed columns, some of them not JSON."""
    broken = F.when(F.col("event_id") % 10 == 0, F.concat(F.lit("broken "), "props")).otherwise(F.col("props"))
    envelopes = shop.table(spark, folder, "events").select("event_id", broken.cast("binary").alias("value"))
    return clean.parse_payload(envelopes, "k BIGINT", keep=("event_id",)).select("event_id", "k")


@query
def clean_keys(spark: SparkSession, folder: str) -> DataFrame:
    kind = F.col("c_custkey") % 6
    key = (
        F.when(kind == 0, "NULL").when(kind == 1, "None").when(kind == 2, "  ")
        .when(kind == 3, " null ").when(kind == 4, F.lit(None)).otherwise(F.col("c_name"))
    )
    return keep_usable_keys(shop.table(spark, folder, "customer").select("c_custkey", key.alias("key")), "key")


@query
def extract_price(spark: SparkSession, folder: str) -> DataFrame:
    kind, amount = F.col("p_partkey") % 7, F.substring(shop.money(shop.cents("p_retailprice")), 2, 40)
    price = (
        F.when(kind == 0, F.concat(F.lit("$"), amount)).when(kind == 1, F.concat(amount, F.lit(" USD")))
        .when(kind == 2, "No price").when(kind == 3, F.concat(F.lit("€"), F.floor(F.col("p_retailprice")).cast("string")))
        .when(kind == 4, F.concat(F.lit("-"), amount)).when(kind == 5, F.concat(F.lit("1,"), amount))
    )
    return price_to_number(shop.table(spark, folder, "part").select("p_partkey", price.alias("price")), "price")


@query
def order_subtotals(spark: SparkSession, folder: str) -> DataFrame:
    orders = clean_subtotals(shop.order_documents(spark, folder))
    return explode_lines(orders).select(
        shop.order_number().alias("order_id"),
        F.col("books.book_id").alias("book_id"),
        F.col("books.quantity").alias("quantity"),
        F.col("books.subtotal").cast("bigint").alias("subtotal"),
    )


@query
def order_lines_explode(spark: SparkSession, folder: str) -> DataFrame:
    return explode_lines(shop.order_documents(spark, folder)).select(
        shop.order_number().alias("order_id"), "customer_id",
        F.col("books.book_id").alias("book_id"), F.col("books.subtotal").alias("subtotal"),
    )


# --- dedup and ranking -------------------------------------------------------


@query
def dedup_against_target(spark: SparkSession, folder: str) -> DataFrame:
    source = price_to_number(shop.books(spark, folder, "2024-02-01"), "price")
    third = F.col("p_partkey") % 3
    target = source.filter(third > 0).select(
        "book_id",
        F.when(third == 2, F.concat("title", F.lit(" old"))).otherwise(F.col("title")).alias("title"),
        "author", "price",
        F.lit(True).alias("current"),
        F.col("updated").alias("effective_date"),
        F.lit(None).cast("timestamp").alias("end_date"),
    )
    fresh = drop_known_rows(source.select(*shop.BOOK_FIELDS), target, ["current", "effective_date", "end_date"])
    return fresh.select("book_id", "title", "author", "price")


@query
def latest_per_key(spark: SparkSession, folder: str) -> DataFrame:
    events = shop.table(spark, folder, "events").select("event_id", "user_id", "event_type", "ts")
    return newest_per_key(events, ["user_id"], "ts", ties=["event_id"])


@query
def latest_change_rank(spark: SparkSession, folder: str) -> DataFrame:
    events = shop.table(spark, folder, "events").select(
        "event_id", "user_id", "event_type", F.date_trunc("day", "ts").alias("day")
    )
    return newest_with_ties(events, ["user_id", "event_type"], "day")


@query
def stream_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """First arrival per key on a stream, copies spread over tasks first."""
    lake = new_lake(spark, "stream_dedup")
    events = shop.table_stream(spark, folder, "events").select("user_id", "event_type", "event_id")
    first = first_arrivals(events, ["user_id", "event_type"], silver.SPREAD, ["event_id"])
    out = lake.path("out", "stream_dedup")
    drain(append_to_folder(first, out, lake.checkpoint("out", "stream_dedup"), "stream_dedup", DRAIN))
    return spark.read.parquet(out).select("user_id", "event_type")


@query
def stream_dedup_bounded(spark: SparkSession, folder: str) -> DataFrame:
    """Events sent twice, a third of their time span per run, through a dedup that forgets after a day."""
    lake = new_lake(spark, "stream_dedup_bounded")
    events = shop.table(spark, folder, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"))
    inbox, out = lake.path("inbox", "events"), lake.path("out", "events")
    copies = events.withColumn("copy", F.explode(F.array(F.lit(0), F.lit(1))))
    first, last = events.agg(F.min("ts"), F.max("ts")).first()
    borders = [first + (last - first) * i / 3 for i in (1, 2)] if first else []
    part_of = sum((F.lit(border) < F.col("ts")).cast("int") for border in borders)
    files.make_folder(spark, out)
    for part in range(3 if first else 0):
        copies.filter(part_of == part).write.mode("append").parquet(inbox)
        stream = spark.readStream.schema("event_id BIGINT, ts TIMESTAMP, copy INT").parquet(inbox)
        once = first_arrivals(stream.withWatermark("ts", "1 day"), ["event_id"], silver.SPREAD, ["copy"], True)
        drain(append_to_folder(once, out, lake.checkpoint("out", "events"), "stream_dedup_bounded", DRAIN))
    return spark.read.schema("event_id BIGINT, ts TIMESTAMP").parquet(out).select("event_id", "ts")


@query
def order_dedup_pipeline(spark: SparkSession, folder: str) -> DataFrame:
    """Order messages with copies and every kind of dirt through the cleaning stream."""
    lake = new_lake(spark, "order_dedup_pipeline")
    number = F.col("o_orderkey")
    dirty = shop.orders(spark, folder).withColumns(
        {
            "quantity": F.when(number % 7 > 0, F.col("quantity")).otherwise(0),
            "order_id": F.when(number % 11 > 0, F.col("order_id")).otherwise("null"),
            "customer_id": F.when(number % 13 > 0, F.col("customer_id")).otherwise("  "),
            "total": F.when(number % 17 > 0, F.col("total")).otherwise("n/a"),
            "copies": F.sequence(F.lit(0), F.when(number % 2 == 0, 2).otherwise(0)),
        }
    )
    copies = dirty.withColumn("copy", F.explode("copies")).select(*shop.ORDER_FIELDS)
    shop.send(lake, "orders", copies, "order_id")
    out = lake.path("out", "orders")
    rows = silver.clean_orders(lake.topic("orders"))
    drain(append_to_folder(rows, out, lake.checkpoint("out", "orders"), "order_dedup_pipeline", DRAIN))
    return spark.read.parquet(out).select("order_id", "order_timestamp", "customer_id", "quantity", "total")


# --- books -------------------------------------------------------------------


@query
def scd2_merge_keys(spark: SparkSession, folder: str) -> DataFrame:
    rows = price_to_number(shop.books(spark, folder, "2024-02-01"), "price")
    number = F.col("p_partkey")
    source = rows.select(*shop.BOOK_FIELDS)
    target = rows.filter(number % 3 < 2).select(
        "book_id", "title", "author", "price", (number % 3 == 0).alias("current")
    )
    return with_merge_keys(source, target).select(
        "book_id", "merge_key", "target_book_id", "current", "effective_date", "end_date"
    )


@query
def scd2_books(spark: SparkSession, folder: str) -> DataFrame:
    """Three rounds of book messages: new, changed, unchanged, changed back, retitled."""
    lake = new_lake(spark, "scd2_books")
    number = F.col("p_partkey")
    dearer = shop.money(F.col("cents") + 100)
    first = shop.books(spark, folder, "2024-01-01")
    nameless = first.filter(number % 11 == 0).withColumn("book_id", F.lit("None"))
    second = shop.books(spark, folder, "2024-02-01").filter(number % 3 < 2).withColumn(
        "price", F.when(number % 3 == 0, dearer).otherwise(F.col("price"))
    )
    third = shop.books(spark, folder, "2024-03-01")
    back = third.filter(number % 6 == 0)
    retitled = third.filter(number % 6 == 3).withColumns(
        {"price": dearer, "title": F.concat("title", F.lit(" 2nd edition"))}
    )
    added = third.filter(number % 5 == 0).withColumn("book_id", F.concat(F.lit("N"), "book_id"))
    for messages in (first.union(nameless), second, back.union(retitled).union(added)):
        shop.send(lake, "books", messages.select(*shop.BOOK_FIELDS), "book_id")
        drain(silver.silver_books(lake, DRAIN))
    return lake.books.read()


# --- customers ---------------------------------------------------------------


def _customer_rounds(spark: SparkSession, folder: str) -> list[DataFrame]:
    """All customers, then updates, deletes, stale rows, other statuses and strangers."""
    number = F.col("c_custkey")
    first = shop.customers(spark, folder, "insert", "2024-01-01")
    later = shop.customers(spark, folder, "update", "2024-02-01")
    kind = number % 4
    second = later.withColumns(
        {
            "row_status": F.when(kind == 1, "delete").when(kind == 3, "moved").otherwise("update"),
            "row_time": F.when(kind == 2, shop.at("2023-12-01")).otherwise(F.col("row_time")),
            "street": F.concat(F.lit("New "), "street"),
        }
    )
    again = later.filter(number % 8 == 0).withColumns(
        {"row_time": shop.at("2024-02-02"), "street": F.concat(F.lit("Newer "), "street")}
    )
    abroad = later.filter(number % 10 == 9).withColumns(
        {"customer_id": F.concat(F.lit("X"), "customer_id"), "country_code": F.lit("nowhere")}
    )
    unknown = later.filter(number % 20 == 0).withColumns(
        {"customer_id": F.concat(F.lit("D"), "customer_id"), "row_status": F.lit("delete")}
    )
    return [first, second.union(again).union(abroad).union(unknown)]


def _run_customers(lake: Lake, folder: str) -> Lake:
    shop.countries(lake.spark, folder).write.parquet(lake.path("bronze", "country_lookup"))
    for messages in _customer_rounds(lake.spark, folder):
        shop.send(lake, "customers", messages.select(*shop.CUSTOMER_FIELDS), "customer_id")
        drain(silver.silver_customers(lake, DRAIN))
    return lake


@query
def scd1_customers(spark: SparkSession, folder: str) -> DataFrame:
    lake = _run_customers(new_lake(spark, "scd1_customers"), folder)
    return lake.customers.read()


@query
def change_feed(spark: SparkSession, folder: str) -> DataFrame:
    """Everything that happened to the customers, read as a stream."""
    lake = _run_customers(new_lake(spark, "change_feed"), folder)
    out = lake.path("out", "feed")
    drain(append_to_folder(lake.customers.changes.stream(), out, lake.checkpoint("out", "feed"), "feed", DRAIN))
    return spark.read.parquet(out).select("customer_id", "street", "row_status", "_change_type", "_commit_version")


@query
def ingest_metrics(spark: SparkSession, folder: str) -> DataFrame:
    lake = _run_customers(new_lake(spark, "ingest_metrics"), folder)
    return lake.metrics.read().select("query", "batch_id", "target", "source_rows")


@query
def country_enrich(spark: SparkSession, folder: str) -> DataFrame:
    """Customers with their country's name; codes missing from the lookup drop out."""
    names = shop.countries(spark, folder).filter(F.col("code").cast("int") < 20)
    customers = shop.customers(spark, folder, "insert", "2024-01-01")
    return add_country(customers, names).select("customer_id", "last_name", "country")


# --- orders ------------------------------------------------------------------


@query
def insert_only_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Orders ingested once, then everything again by a second stream that knows nothing of it."""
    lake = new_lake(spark, "insert_only_orders")
    number = F.col("o_orderkey")
    orders = shop.orders(spark, folder)
    shop.send(lake, "orders", orders.filter(number % 2 == 0).select(*shop.ORDER_FIELDS), "order_id")
    drain(silver.silver_orders(lake, DRAIN))

    moved = orders.filter(number % 5 == 0).withColumn(
        "order_timestamp", F.col("order_timestamp") + F.expr("INTERVAL 1 DAY")
    )
    rest = orders.filter(number % 2 == 1).union(moved)
    shop.send(lake, "orders", rest.select(*shop.ORDER_FIELDS), "order_id")
    second = Lake(spark, lake.root, checkpoint_root=f"{lake.root}/_second_stream")
    drain(silver.silver_orders(second, DRAIN))
    return lake.orders.read().select(
        "order_id", "order_timestamp", "customer_id", "quantity", "total",
        F.size("books").cast("bigint").alias("line_count"),
    )


@query
def books_orders_join(spark: SparkSession, folder: str) -> DataFrame:
    """Books and order documents through bronze tables, silver tables and the line join."""
    lake = new_lake(spark, "books_orders_join")
    known = shop.books(spark, folder, "2024-01-01").filter("p_partkey % 10 < 9")
    shop.send(lake, "books", known.select(*shop.BOOK_FIELDS), "book_id")
    drain(silver.silver_books(lake, DRAIN))
    shop.send(lake, "orders", shop.order_documents(spark, folder), "order_id")
    drain(silver.silver_orders(lake, DRAIN))
    drain(silver.silver_books_orders(lake, DRAIN))
    return lake.books_orders.read().select(
        shop.order_number().alias("order_id"), "order_timestamp", "customer_id",
        F.col("quantity").alias("order_quantity"), "total",
        F.col("books.book_id").alias("book_id"), F.col("books.quantity").alias("line_quantity"),
        F.col("books.subtotal").alias("subtotal"), "title", "author", "price",
    )


def _run_orders(lake: Lake, folder: str) -> None:
    shop.send(lake, "orders", shop.orders(lake.spark, folder).select(*shop.ORDER_FIELDS), "order_id")
    drain(silver.silver_orders(lake, DRAIN))


@query
def customers_orders_stream_join(spark: SparkSession, folder: str) -> DataFrame:
    """Customer changes and orders, joined as two streams."""
    lake = new_lake(spark, "customers_orders_stream_join")
    shop.countries(spark, folder).write.parquet(lake.path("bronze", "country_lookup"))
    customers = shop.customers(spark, folder, "insert", "2024-01-01").select(*shop.CUSTOMER_FIELDS)
    shop.send(lake, "customers", customers, "customer_id")
    drain(silver.silver_customers(lake, DRAIN))
    _run_orders(lake, folder)
    out, checkpoint = lake.path("out", "joined"), lake.checkpoint("out", "joined")
    joined = silver.customers_orders_stream(lake, hot=silver.kept_hot_customers(lake, checkpoint))
    drain(append_to_folder(joined, out, checkpoint, "customers_orders", DRAIN))
    return spark.read.parquet(out).select(
        "order_id", "order_timestamp", "customer_id", "quantity", "total", "email", "country", "_change_type"
    )


@query
def customers_orders_upsert(spark: SparkSession, folder: str) -> DataFrame:
    """The joined table before and after customers change or leave."""
    lake = new_lake(spark, "customers_orders_upsert")
    shop.countries(spark, folder).write.parquet(lake.path("bronze", "country_lookup"))
    _run_orders(lake, folder)
    for messages in _customer_rounds(spark, folder):
        shop.send(lake, "customers", messages.select(*shop.CUSTOMER_FIELDS), "customer_id")
        drain(silver.silver_customers(lake, DRAIN))
        drain(silver.silver_customers_orders(lake, DRAIN))
    return lake.customers_orders.read().select(
        "order_id", "customer_id", "quantity", "total", "street", "country", "row_time", "_change_type"
    )


# --- gold --------------------------------------------------------------------


def _lines(spark: SparkSession, folder: str) -> DataFrame:
    books = price_to_number(shop.books(spark, folder, "2024-01-01"), "price")
    current = books.withColumn("current", F.lit(True))
    orders = clean_subtotals(price_to_number(shop.order_documents(spark, folder), "total"))
    return lines_with_books(explode_lines(orders), current)


@query
def authors_stats_window(spark: SparkSession, folder: str) -> DataFrame:
    return flat_windows(stats.authors_stats(_lines(spark, folder)))


@query
def authors_stats_upsert(spark: SparkSession, folder: str) -> DataFrame:
    """Every window is opened by one batch and updated by the next."""
    lake = new_lake(spark, "authors_stats_upsert")
    silver.as_schema(_lines(spark, folder), schemas.BOOKS_ORDERS).write.parquet(lake.path("inbox", "lines"))
    lines = spark.read.schema(schemas.BOOKS_ORDERS).parquet(lake.path("inbox", "lines"))
    half = F.pmod(F.hash("order_id", "books.book_id", "books.subtotal"), F.lit(2))
    for part in (0, 1):
        lake.books_orders.append(lines.filter(half == part), "lines", part)
        drain(gold.gold_authors_stats(lake, DRAIN, watermark="4000 days", window="1 day"))
    return flat_windows(lake.authors_stats.read())


@query
def late_data_update(spark: SparkSession, folder: str) -> DataFrame:
    """Late rows inside the watermark update their window, rows far outside are dropped."""
    lake = new_lake(spark, "late_data_update")
    events = shop.table(spark, folder, "events")
    lines = events.select(
        shop.text("event_id").alias("order_id"), F.col("ts").alias("order_timestamp"),
        shop.text("user_id").alias("customer_id"), F.col("user_id").alias("quantity"),
        F.lit(0).cast("bigint").alias("total"),
        F.struct(F.lit("b").alias("book_id"), F.lit(1).cast("bigint").alias("quantity"),
                 F.lit(0).cast("bigint").alias("subtotal")).alias("books"),
        F.lit("title").alias("title"), F.col("event_type").alias("author"), F.lit(1.0).alias("price"),
        "event_id",
    )
    moment, number = F.col("order_timestamp"), F.col("event_id")
    far_late = (moment < shop.at("2024-01-05")) & (number % 50 == 0)
    late = moment.between(shop.at("2024-01-13 12:00:00"), shop.at("2024-01-15")) & (number % 5 == 0)
    before = moment < shop.at("2024-01-15")
    rounds = (
        before & ~late & ~far_late,
        late | (~before & ~late),
        far_late,
    )
    for batch_id, chosen in enumerate(rounds):
        part = silver.as_schema(lines.filter(chosen), schemas.BOOKS_ORDERS)
        lake.books_orders.append(part, "lines", batch_id)
        drain(gold.gold_authors_stats(lake, DRAIN, watermark="2 days", window="1 hour"))
    return flat_windows(lake.authors_stats.read())


@query
def countries_stats(spark: SparkSession, folder: str) -> DataFrame:
    customers = add_country(shop.customers(spark, folder, "insert", "2024-01-01"), shop.countries(spark, folder))
    joined = changes_with_orders(customers, shop.orders(spark, folder).select(*shop.ORDER_FIELDS))
    return stats.countries_stats(joined)


# --- catalog -----------------------------------------------------------------


def _set_up_catalog(spark: SparkSession, folder: str) -> dict[str, Namespace]:
    """The three layers as databases under names of their own: the lookup loaded, customers'
    orders streamed into their table, and the statistics as a persistent view."""
    root, run, before = working_folder(spark, "catalog"), uuid.uuid4().hex, spark.catalog.currentDatabase()
    layers = {}
    for layer, specs in (("bronze", catalog.BRONZE), ("silver", catalog.SILVER), ("gold", catalog.GOLD)):
        layers[layer] = Namespace(f"{layer}_{run}")
        catalog.set_up_layer(spark, layers[layer], f"{root}/{layer}", specs, table_format="parquet")
    spark.catalog.setCurrentDatabase(before)

    lookup_table = layers["bronze"].table("country_lookup")
    shop.countries(spark, folder).select("calling_code", "code", "country").write.insertInto(lookup_table)
    customers = add_country(shop.customers(spark, folder, "insert", "2024-01-01"), spark.table(lookup_table))
    orders = price_to_number(shop.orders(spark, folder).select(*shop.ORDER_FIELDS), "total")
    joined = changes_with_orders(customers, orders)
    target = layers["silver"].table("silver_customers_orders")
    columns = [
        F.col(f.name).cast(f.dataType) for f in spark.table(target).schema
        if f.name in joined.columns and f.name != "books"  # order lines stay out, the statistics need none
    ]
    joined.select(*columns).write.parquet(f"{root}/joined")
    arriving = spark.readStream.schema(schemas.CUSTOMERS_ORDERS).parquet(f"{root}/joined")
    drain(append_to_table(arriving, target, f"{root}/joined_cp", "catalog_orders", DRAIN))
    catalog.create_countries_view(spark, layers["gold"], layers["silver"])
    return layers


@query
def catalog_pipeline(spark: SparkSession, folder: str) -> DataFrame:
    """Statistics read from the view of a catalog that was set up and filled by a stream."""
    return spark.table(_set_up_catalog(spark, folder)["gold"].table("countries_stats_vw"))


@query
def catalog_tables(spark: SparkSession, folder: str) -> DataFrame:
    """What the catalog lists for each layer, and the rows in it."""
    found = [
        spark.table(space.table(t.name)).agg(F.count("*").alias("row_count")).select(
            F.lit(layer).alias("layer"), F.lit(t.name).alias("name"), F.lit(t.tableType).alias("kind"), "row_count"
        )
        for layer, space in _set_up_catalog(spark, folder).items()
        for t in spark.catalog.listTables(str(space)) if not t.isTemporary
    ]
    return functools.reduce(DataFrame.unionByName, found)
