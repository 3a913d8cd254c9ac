"""The streams end to end, on a few messages at a time."""

import json

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tests.helpers import day, rows
from tierstream import schemas
from tierstream.operators.dedup import first_arrivals
from tierstream.operators.joins import changes_with_orders, heavy_keys
from tierstream.plans import gold, silver
from tierstream.plans.bronze import ingest_topic
from tierstream.plans.lake import Lake
from tierstream.sources import topics
from tierstream.sources.lookup import load_countries
from tierstream.streaming.run import DRAIN, Trigger, append_to_folder, drain


@pytest.fixture
def lake(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"), buckets=2).create()
    spark.createDataFrame([("+371", "LV", "Latvia"), (None, "NA", "Namibia")], schemas.COUNTRY_LOOKUP).write.parquet(
        lake.path("bronze", "country_lookup")
    )
    return lake


def send(lake, topic, *documents):
    """Messages straight into a bronze table; strings go as they are."""
    texts = [(d if isinstance(d, str) else json.dumps(d),) for d in documents]
    frame = lake.spark.createDataFrame(texts, "value STRING").coalesce(1)
    topics.to_envelope(frame, f"{topic[:-1]}_id", topic).write.mode("append").parquet(lake.path("bronze", topic))


def book(number, title="A", at=1, price="$9.50", author="Ann"):
    return {"book_id": number, "title": title, "author": author, "price": price, "updated": f"2024-01-{at:02}T00:00:00"}


def order(number, at="2024-01-01T10:00:00", customer="c1", quantity=2, total="$20.99", books=(("b1", 2, "$20.99"),)):
    lines = books if books is None else [{"book_id": b, "quantity": q, "subtotal": s} for b, q, s in books]
    return {"order_id": number, "order_timestamp": at, "customer_id": customer, "quantity": quantity, "total": total, "books": lines}


def customer(number, status="insert", at="2024-01-01T00:00:00", code="LV", city="Riga"):
    return {"customer_id": number, "city": city, "country_code": code, "row_status": status, "row_time": at}


def test_books(lake):
    send(lake, "books", book("b1"), book("b1"), book("None"), book("b2", price="free"), "not json", book("b3", price="1,5"))
    drain(silver.silver_books(lake, DRAIN))
    # b2's first copy had no price and used up its key; a later good copy is lost.
    send(lake, "books", book("b2", price="$1"), book("b1", "B", at=2))
    drain(silver.silver_books(lake, DRAIN))
    assert rows(lake.books.read(), "book_id", "title", "price", "current") == [
        ("b1", "A", 9.5, False), ("b1", "B", 9.5, True), ("b3", "A", 1.0, True),
    ]


def test_ambiguous_books_stop_the_stream(lake):
    send(lake, "books", book("b1"))
    drain(silver.silver_books(lake, DRAIN))
    send(lake, "books", book("b1", "B", at=2), book("b1", "C", at=3))
    with pytest.raises(StreamingQueryException, match="same target row"):
        drain(silver.silver_books(lake, DRAIN))


def test_orders(lake):
    send(
        lake, "orders",
        order("o1"), order("o1"), order("o1", at="2024-01-02T10:00:00"),
        order("o2", quantity=0), order("o3", quantity=-1), order("o4", quantity=None), order("null"),
        order("o5", customer="  "), order("o6", total="?"), order("o7", books=()), order("o8", books=None),
        order("o9", at=None), order("o10", books=(("b1", 1, "$1.50"), ("b2", 1, "no"))),
    )
    drain(silver.silver_orders(lake, DRAIN))
    assert rows(lake.orders.read(), "order_id", F.dayofmonth("order_timestamp"), "total") == [
        ("o1", 1, 20), ("o1", 2, 20), ("o10", 1, 20), ("o9", None, 20),
    ]
    lines = lake.orders.read().filter("order_id = 'o10'").first()["books"]
    assert [tuple(line) for line in lines] == [("b1", 1, 150), ("b2", 1, None)]


def test_replayed_orders_by_a_new_stream(spark, lake):
    send(lake, "orders", order("o1"), order("o9", at=None))
    drain(silver.silver_orders(lake, DRAIN))
    again = Lake(spark, lake.root, checkpoint_root=f"{lake.root}/_other", buckets=2)
    drain(silver.silver_orders(again, DRAIN))
    # A null time never matches, so that order is stored once per replay.
    assert rows(lake.orders.read(), "order_id") == [("o1",), ("o9",), ("o9",)]


def test_customers(lake):
    send(lake, "customers", customer("c1"), customer("c2", code="NA"), customer("c3", code="XX"), customer("NULL"))
    drain(silver.silver_customers(lake, DRAIN))
    send(lake, "customers", customer("c1", "update", "2024-01-02T00:00:00", city="Oslo"), customer("c2", "delete", "2024-01-02T00:00:00"))
    drain(silver.silver_customers(lake, DRAIN))
    assert rows(lake.customers.read(), "customer_id", "city", "country") == [("c1", "Oslo", "Latvia")]


def test_running_stream_sees_a_reloaded_lookup(lake, tmp_path):
    csv = tmp_path / "countries.csv"

    def load(mode, *lines):
        csv.write_text("\n".join(("calling_code,code,country", *lines)) + "\n")
        load_countries(lake.spark, str(csv), lake.path("bronze", "country_lookup"), mode)

    def send_both(number):
        send(lake, "customers", customer(f"c{number}"), customer(f"e{number}", code="EE"))

    send_both(0)
    query = silver.silver_customers(lake, Trigger(every="0 seconds"))
    try:
        query.processAllAvailable()
        for number, load_args in enumerate((("overwrite", "+371,LV,Latvija"), ("append", "+372,EE,Estonia")), 1):
            load(*load_args)
            send_both(number)
            query.processAllAvailable()
    finally:
        query.stop()
    assert rows(lake.customers.read(), "customer_id", "country") == [
        ("c0", "Latvia"), ("c1", "Latvija"), ("c2", "Latvija"), ("e2", "Estonia"),
    ]
    load("ignore", "+1,XX,Nowhere")
    assert lake.country_lookup.count() == 2
    with pytest.raises(ValueError, match="already there"):
        load("error", "+1,XX,Nowhere")


def test_books_orders_reads_books_afresh(lake):
    send(lake, "books", book("b1"))
    drain(silver.silver_books(lake, DRAIN))
    send(lake, "orders", order("o1", books=(("b1", 1, "$1"), ("b2", 1, "$1"))))
    drain(silver.silver_orders(lake, DRAIN))
    drain(silver.silver_books_orders(lake, DRAIN))
    send(lake, "books", book("b2"), book("b1", "B", at=2))
    drain(silver.silver_books(lake, DRAIN))
    send(lake, "orders", order("o2", books=(("b1", 1, "$1"), ("b2", 1, "$1"))))
    drain(silver.silver_orders(lake, DRAIN))
    drain(silver.silver_books_orders(lake, DRAIN))
    # o1's line of b2 came before the book and is lost for good; o2 sees b1's new version only.
    assert rows(lake.books_orders.read(), "order_id", "books.book_id", "title") == [
        ("o1", "b1", "A"), ("o2", "b1", "B"), ("o2", "b2", "A"),
    ]


def test_running_stream_sees_later_books(lake):
    """The books table is read per batch even within one run of the stream."""
    send(lake, "books", book("b1"))
    drain(silver.silver_books(lake, DRAIN))
    query = silver.silver_books_orders(lake, Trigger(every="0 seconds"))
    try:
        for number in ("b1", "b2"):
            send(lake, "books", book(number))
            drain(silver.silver_books(lake, DRAIN))
            send(lake, "orders", order(f"o-{number}", books=((number, 1, "$1"),)))
            drain(silver.silver_orders(lake, DRAIN))
            query.processAllAvailable()
    finally:
        query.stop()
    assert rows(lake.books_orders.read(), "order_id") == [("o-b1",), ("o-b2",)]


def test_customers_orders_follow_the_change_feed(lake):
    send(lake, "orders", order("o1"), order("o2", customer="c2"))
    drain(silver.silver_orders(lake, DRAIN))
    send(lake, "customers", customer("c1"), customer("c2"))
    drain(silver.silver_customers(lake, DRAIN))
    drain(silver.silver_customers_orders(lake, DRAIN))
    send(
        lake, "customers",
        customer("c1", "update", "2024-01-02T00:00:00", city="Oslo"), customer("c2", "delete", "2024-01-02T00:00:00"),
    )
    drain(silver.silver_customers(lake, DRAIN))
    drain(silver.silver_customers_orders(lake, DRAIN))
    assert rows(lake.customers_orders.read(), "order_id", "city", "_change_type") == [("o1", "Oslo", "update_postimage")]
    stats = gold.gold_countries_stats(lake, view="countries_stats_vw")
    assert rows(stats) == [("Latvia", day(1), 1, 2)]
    assert lake.spark.table("countries_stats_vw").count() == 1


def test_authors_stats_and_late_rows(lake):
    def lines(number, *moments):
        frame = lake.spark.createDataFrame([(m,) for m in moments], "at STRING").select(
            F.lit("o").alias("order_id"), F.col("at").cast("timestamp").alias("order_timestamp"),
            F.lit(4).alias("quantity"), F.lit("Ann").alias("author"),
            *[F.lit(None).alias(c) for c in ("customer_id", "total", "books", "title", "price")],
        )
        lake.books_orders.append(silver.as_schema(frame, schemas.BOOKS_ORDERS), "lines", number)
        drain(gold.gold_authors_stats(lake, DRAIN))

    def counts():
        return rows(lake.authors_stats.read(), F.date_format("time.start", "HH:mm"), "orders_count", "avg_quantity")

    lines(0, "2024-01-01 10:01:00", "2024-01-01 10:02:00", "2024-01-01 10:12:00")
    assert counts() == [("10:00", 2, 4.0), ("10:10", 1, 4.0)]
    lines(1, "2024-01-01 10:04:00", "2024-01-01 12:00:00")
    assert counts() == [("10:00", 3, 4.0), ("10:10", 1, 4.0), ("12:00", 1, 4.0)]
    lines(2, "2024-01-01 12:01:00")
    lines(3, "2024-01-01 10:04:00", "2024-01-01 11:59:00")
    assert counts() == [("10:00", 3, 4.0), ("10:10", 1, 4.0), ("11:55", 1, 4.0), ("12:00", 2, 4.0)]


def test_pace_cuts_a_backlog_into_batches(spark, lake):
    for number in range(3):
        send(lake, "books", book(f"b{number}"))
    paced = Lake(spark, lake.root, buckets=2, pace={"maxFilesPerTrigger": "1"})
    drain(silver.silver_books(paced, DRAIN))
    assert rows(lake.metrics.read(), "batch_id", "source_rows") == [(0, 1), (1, 1), (2, 1)]
    assert rows(lake.books.read(), "book_id") == [("b0",), ("b1",), ("b2",)]


def test_metrics(lake):
    send(lake, "books", book("b1"), book("b2"))
    drain(silver.silver_books(lake, DRAIN, name="books_writer"))
    send(lake, "books", book("b1", at=2), book("b2", "B", at=2))
    drain(silver.silver_books(lake, DRAIN, name="books_writer"))
    assert rows(lake.metrics.read(), "query", "batch_id", "target", "source_rows") == [
        ("books_writer", 0, "silver_books", 2), ("books_writer", 1, "silver_books", 1),
    ]
    hours = lake.metrics.read().select((F.unix_seconds("committed_local") - F.unix_seconds("committed_at")) / 3600)
    assert {r[0] for r in hours.collect()} <= {0.0}


def test_bronze_from_a_published_file(spark, lake, tmp_path):
    source = tmp_path / "books.json"
    source.write_text("\n".join(json.dumps(book(f"b{i}")) for i in range(5)))
    inbox = str(tmp_path / "inbox")
    topics.publish(spark, str(source), "book_id", "books", inbox, count=3)
    drain(ingest_topic(lake, "books", topics.folder_topic(spark, inbox), DRAIN))
    drain(ingest_topic(lake, "books", topics.folder_topic(spark, inbox), DRAIN))
    stored = spark.read.parquet(lake.path("bronze", "books"))
    assert rows(stored, F.col("key").cast("string"), "topic") == [("b0", "books"), ("b1", "books"), ("b2", "books")]
    topics.publish(spark, str(source), "book_id", "books", inbox)
    query = ingest_topic(lake, "books", topics.folder_topic(spark, inbox), Trigger(every="0 seconds"), name="bronze")
    assert query.name == "bronze"
    query.processAllAvailable()
    query.stop()
    assert spark.read.parquet(lake.path("bronze", "books")).count() == 8
    places = spark.read.parquet(inbox).select("partition", "offset")
    assert places.distinct().count() == places.count() == 8
    drain(silver.silver_books(lake, DRAIN))
    assert lake.books.read().count() == 5


def test_kafka_settings():
    options = topics.kafka_options("broker:9092", "me", "secret")
    assert options["kafka.security.protocol"] == "SASL_SSL" and options["kafka.sasl.mechanism"] == "PLAIN"
    assert "username='me' password='secret';" in options["kafka.sasl.jaas.config"]


def test_spread_dedup_across_batches(spark, tmp_path):
    inbox, out = str(tmp_path / "in"), str(tmp_path / "out")
    for start in (0, 50):
        frame = spark.range(start, start + 100).select((F.col("id") % 7).alias("key"), F.col("id").alias("n"))
        frame.write.mode("append").parquet(inbox)
        stream = spark.readStream.schema("key BIGINT, n BIGINT").parquet(inbox)
        first = first_arrivals(stream, ["key"], spread=4, spread_by=["n"])
        drain(append_to_folder(first, out, str(tmp_path / "cp"), "dedup", DRAIN))
    assert rows(spark.read.parquet(out), "key") == [(i,) for i in range(7)]


def test_bounded_dedup(spark, tmp_path):
    frame = spark.createDataFrame([("a", day(1)), ("a", day(1)), ("b", day(2))], "key STRING, at TIMESTAMP")
    frame.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(frame.schema).parquet(str(tmp_path / "in")).withWatermark("at", "1 day")
    first = first_arrivals(stream, ["key"], within_watermark=True)
    out = str(tmp_path / "out")
    drain(append_to_folder(first, out, str(tmp_path / "cp"), "bounded", DRAIN))
    assert rows(spark.read.parquet(out), "key") == [("a",), ("b",)]


def state_rows(spark, checkpoint):
    return sum(
        spark.read.format("statestore").option("operatorId", n).load(checkpoint).count() for n in (0, 1)
    )


def test_order_dedup_forgets(spark, lake):
    """Each day's orders come twice; the state holds the last day's keys, not all of them."""
    held = []
    for at in range(1, 5):
        orders = [order(f"{at}-{i}") for i in range(at == 1 and 40 or 5)]
        texts = spark.createDataFrame([(json.dumps(o),) for o in [*orders, *orders]], "value STRING").coalesce(1)
        sent = topics.to_envelope(texts, "order_id", "orders").withColumn("timestamp", F.lit(day(at)))
        sent.write.mode("append").parquet(lake.path("bronze", "orders"))
        drain(silver.silver_orders(lake, DRAIN, forget_after="1 hour"))
        held.append(state_rows(spark, lake.checkpoint("silver", "silver_orders")))
    assert lake.orders.read().count() == 55
    assert held[0] >= 40 and max(held[2:]) < 40


def test_only_hot_customers_are_dealt_out(spark):
    orders = spark.range(3000).select(
        F.col("id").cast("string").alias("order_id"), F.current_timestamp().alias("order_timestamp"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("c"), "id")).alias("customer_id"),
    )
    assert heavy_keys(orders, "customer_id") == ["hot"]
    assert heavy_keys(orders.limit(0), "customer_id") == []
    changes = orders.select("customer_id").distinct().withColumn("row_time", F.current_timestamp())
    got = changes_with_orders(changes, orders, 16, hot=["hot"])
    assert got.count() == 3000 and got.select("order_id").distinct().count() == 3000
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "hot" in plan
    assert changes_with_orders(changes, orders, 16, hot=[]).count() == 3000


def test_hot_customers_are_kept_with_the_checkpoint(spark, lake):
    checkpoint = lake.checkpoint("silver", "some_join")
    send(lake, "orders", *[order(f"o{i}") for i in range(20)])
    drain(silver.silver_orders(lake, DRAIN))
    assert silver.kept_hot_customers(lake, checkpoint, settled=10) == ["c1"]
    send(lake, "orders", *[order(f"p{i}", customer="c2") for i in range(20)])
    drain(silver.silver_orders(lake, DRAIN))
    assert silver.kept_hot_customers(lake, checkpoint, settled=10) == ["c1"]
    assert silver.kept_hot_customers(lake, checkpoint + "_too_early", settled=1000) is None
    (spark.range(1).write.parquet(checkpoint + "_older"))
    assert silver.kept_hot_customers(lake, checkpoint + "_older", settled=10) is None


@pytest.mark.parametrize("salts", [1, 5])
def test_salted_join_equals_a_plain_one(spark, salts):
    changes = spark.createDataFrame([("c1", "x", day(1)), ("c1", "y", day(9)), ("c2", "z", day(1))], "customer_id STRING, city STRING, row_time TIMESTAMP")
    orders = spark.createDataFrame(
        [(f"o{i}", "c1" if i % 3 else "c3", day(1 + i % 5)) for i in range(30)], "order_id STRING, customer_id STRING, order_timestamp TIMESTAMP"
    )
    expected = rows(changes.join(orders, "customer_id"), "order_id", "city", "customer_id")
    got = changes_with_orders(changes, orders, salts)
    assert rows(got, "order_id", "city", "customer_id") == expected
    near = changes_with_orders(changes, orders, salts, within="2 days")
    assert {r["city"] for r in near.collect()} == {"x"}


def test_bounded_stream_join_returns_the_same_rows(spark, lake):
    """A time bound wide enough for all rows changes nothing in the result."""
    send(lake, "orders", order("o1"))
    drain(silver.silver_orders(lake, DRAIN))
    send(lake, "customers", customer("c1"))
    drain(silver.silver_customers(lake, DRAIN))
    drain(silver.silver_customers_orders(lake, DRAIN, within="1 day", salts=2))
    assert rows(lake.customers_orders.read(), "order_id", "country") == [("o1", "Latvia")]
