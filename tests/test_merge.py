"""The five merge policies and their edge cases, on tables."""

import pytest
from pyspark.sql import functions as F

from tests.helpers import day, rows
from tierstream import schemas
from tierstream.operators.dedup import drop_known_rows
from tierstream.operators.history import with_merge_keys
from tierstream.operators.latest import newest_per_key, newest_with_ties
from tierstream.operators.merge import (
    AUTHOR_WINDOWS,
    BOOK_HISTORY,
    CUSTOMER_ORDER_STATE,
    CUSTOMER_STATE,
    MergeError,
    merge_effects,
)
from tierstream.plans.lake import Lake


@pytest.fixture
def lake(spark, tmp_path):
    return Lake(spark, str(tmp_path), buckets=3).create()


# --- type 2 history ----------------------------------------------------------


class Books:
    def __init__(self, lake):
        self.lake, self.batch = lake, 0

    def merge(self, *versions):
        batch = self.lake.spark.createDataFrame(
            [(b, title, "author", 1.0, day(d)) for b, title, d in versions],
            "book_id STRING, title STRING, author STRING, price DOUBLE, updated TIMESTAMP",
        )
        table = self.lake.books
        known = table.read_like(batch)
        fresh = drop_known_rows(batch, known, ["current", "effective_date", "end_date"])
        table.merge(with_merge_keys(fresh, known), BOOK_HISTORY, "test", self.batch)
        self.batch += 1

    def state(self):
        return rows(self.lake.books.read(), "book_id", "title", "current", F.dayofmonth("effective_date"), F.dayofmonth("end_date"))


@pytest.fixture
def books(lake):
    return Books(lake)


def test_history_new_unchanged_changed(books):
    books.merge(("b1", "A", 1), ("b2", "X", 1))
    books.merge(("b1", "B", 2), ("b2", "X", 2), ("b3", "N", 2))
    assert books.state() == [
        ("b1", "A", False, 1, 2), ("b1", "B", True, 2, None), ("b2", "X", True, 1, None), ("b3", "N", True, 2, None),
    ]


def test_history_return_to_old_content_is_lost(books):
    for number, title in enumerate("ABA", start=1):
        books.merge(("b1", title, number))
    assert books.state() == [("b1", "A", False, 1, 2), ("b1", "B", True, 2, None)]


def test_history_two_versions_of_known_book_in_a_batch_fail(books):
    books.merge(("b1", "A", 1))
    with pytest.raises(MergeError):
        books.merge(("b1", "B", 2), ("b1", "C", 3))
    assert books.state() == [("b1", "A", True, 1, None)]


def test_history_two_versions_of_new_book_are_both_current(books):
    books.merge(("b1", "A", 1), ("b1", "B", 2))
    assert books.state() == [("b1", "A", True, 1, None), ("b1", "B", True, 2, None)]
    # From here on every later version comes in twice and closes both.
    with pytest.raises(MergeError):
        books.merge(("b1", "C", 3))


def test_history_late_version_becomes_current(books):
    books.merge(("b1", "B", 5))
    books.merge(("b1", "A", 2))
    assert books.state() == [("b1", "A", True, 2, None), ("b1", "B", False, 5, 2)]


def test_history_replay_under_a_new_number_changes_nothing(books):
    books.merge(("b1", "A", 1))
    books.merge(("b1", "B", 2))
    before = books.state()
    books.merge(("b1", "A", 1))
    books.merge(("b1", "B", 2))
    assert books.state() == before


def test_merge_keys(spark):
    source = spark.createDataFrame([("old", day(2)), ("new", day(2)), ("shut", day(2))], "book_id STRING, updated TIMESTAMP")
    target = spark.createDataFrame([("old", True), ("shut", False)], "book_id STRING, current BOOLEAN")
    got = with_merge_keys(source, target)
    assert rows(got, "book_id", "merge_key", "target_book_id", "current", "end_date") == [
        ("new", "new", None, True, None), ("old", None, "old", True, None),
        ("old", "old", "old", True, None), ("shut", "shut", None, True, None),
    ]


# --- type 1 with deletes -----------------------------------------------------


class Customers:
    def __init__(self, lake):
        self.lake, self.batch = lake, 0

    def merge(self, *changes, batch_id=None):
        blank = [F.lit(None).cast("string").alias(c) for c in ("email", "first_name", "last_name", "gender", "street", "country")]
        frame = self.lake.spark.createDataFrame(
            [(c, city, status, day(d)) for c, city, status, d in changes],
            "customer_id STRING, city STRING, row_status STRING, row_time TIMESTAMP",
        ).select("*", *blank)
        newest = newest_per_key(frame, ["customer_id"], "row_time")
        number = self.batch if batch_id is None else batch_id
        done = self.lake.customers.merge(newest, CUSTOMER_STATE, "test", number)
        self.batch = number + 1
        return done

    def state(self):
        return rows(self.lake.customers.read(), "customer_id", "city", "row_status", F.dayofmonth("row_time"))

    def feed(self):
        feed = self.lake.customers.changes.read()
        return rows(feed, "_commit_version", "customer_id", "_change_type", "city")


@pytest.fixture
def customers(lake):
    table = Customers(lake)
    table.merge(("c1", "Riga", "insert", 5))
    return table


@pytest.mark.parametrize(
    "change, after",
    [
        (("c1", "Oslo", "update", 6), [("c1", "Oslo", "update", 6)]),
        (("c1", "Oslo", "update", 4), [("c1", "Riga", "insert", 5)]),
        (("c1", "Oslo", "update", 5), [("c1", "Riga", "insert", 5)]),
        (("c1", "Oslo", "delete", 6), []),
        (("c1", "Oslo", "delete", 5), [("c1", "Riga", "insert", 5)]),
        (("c1", "Oslo", "moved", 6), [("c1", "Riga", "insert", 5)]),
        (("c2", "Oslo", "delete", 6), [("c1", "Riga", "insert", 5), ("c2", "Oslo", "delete", 6)]),
    ],
)
def test_customer_state(customers, change, after):
    customers.merge(change)
    assert customers.state() == after


def test_customer_newest_row_of_the_batch_counts(customers):
    customers.merge(("c1", "Oslo", "update", 6), ("c1", "Bern", "update", 8), ("c1", "Kiel", "delete", 7))
    assert customers.state() == [("c1", "Bern", "update", 8)]


def test_customer_replay_after_delete_inserts_again(customers):
    customers.merge(("c1", "Riga", "delete", 6))
    customers.merge(("c1", "Riga", "insert", 5))
    assert customers.state() == [("c1", "Riga", "insert", 5)]


def test_customer_change_feed(customers):
    customers.merge(("c1", "Oslo", "update", 6), ("c2", "Bern", "insert", 6))
    customers.merge(("c1", "?", "delete", 7), ("c2", "?", "update", 1))
    assert customers.feed() == [
        (0, "c1", "insert", "Riga"),
        (1, "c1", "update_postimage", "Oslo"), (1, "c1", "update_preimage", "Riga"), (1, "c2", "insert", "Bern"),
        (2, "c1", "delete", "Oslo"),
    ]
    times = [r[0] for r in rows(customers.lake.customers.changes.read().groupBy("_commit_version").agg(F.countDistinct("_commit_timestamp").alias("n")), "n")]
    assert times == [1, 1, 1]


def test_same_batch_number_is_applied_once(customers):
    assert customers.merge(("c1", "Oslo", "update", 6), batch_id=7)
    assert not customers.merge(("c1", "Bern", "update", 9), batch_id=7)
    assert customers.state() == [("c1", "Oslo", "update", 6)]


# --- change-feed upsert ------------------------------------------------------


def joined(spark, *changes):
    known = {"order_id", "customer_id", "city", "_change_type", "processed_timestamp"}
    frame = spark.createDataFrame(
        [(o, c, city, kind, day(d)) for o, c, city, kind, d in changes],
        "order_id STRING, customer_id STRING, city STRING, _change_type STRING, processed_timestamp TIMESTAMP",
    )
    rest = [part.split()[0] for part in ("order_timestamp quantity total email first_name last_name gender street country row_time").split()]
    types = {"order_timestamp": "timestamp", "row_time": "timestamp", "quantity": "bigint", "total": "bigint"}
    blank = [F.lit(None).cast(types.get(c, "string")).alias(c) for c in rest if c not in known]
    array = F.lit(None).cast("array<struct<book_id:string,quantity:bigint,subtotal:bigint>>").alias("books")
    # A column the target lacks must be ignored.
    return frame.select("*", *blank, array, F.lit("x").alias("row_status"))


def order_state(lake):
    return rows(lake.customers_orders.read(), "order_id", "city", "_change_type")


@pytest.mark.parametrize(
    "change, after",
    [
        (("o1", "c1", "Oslo", "update_postimage", 6), [("o1", "Oslo", "update_postimage")]),
        (("o1", "c1", "Oslo", "update_postimage", 5), [("o1", "Riga", "insert")]),
        (("o1", "c1", "Oslo", "insert", 6), [("o1", "Riga", "insert")]),
        (("o1", "c1", "Oslo", "delete", 6), []),
        (("o2", "c1", "Oslo", "delete", 6), [("o1", "Riga", "insert"), ("o2", "Oslo", "delete")]),
    ],
)
def test_customer_order_state(spark, lake, change, after):
    lake.customers_orders.merge(joined(spark, ("o1", "c1", "Riga", "insert", 5)), CUSTOMER_ORDER_STATE, "test", 0)
    lake.customers_orders.merge(joined(spark, change), CUSTOMER_ORDER_STATE, "test", 1)
    assert order_state(lake) == after


def test_tied_changes(spark, lake):
    """Ties insert twice; once stored, newer ties are ambiguous and older ones harmless."""
    tie = [("o1", "c1", "Riga", "insert", 5), ("o1", "c1", "Oslo", "insert", 5)]
    source = newest_with_ties(joined(spark, *tie), ["order_id", "customer_id"], "processed_timestamp")
    lake.customers_orders.merge(source, CUSTOMER_ORDER_STATE, "test", 0)
    both = [("o1", "Oslo", "insert"), ("o1", "Riga", "insert")]
    assert order_state(lake) == both
    lake.customers_orders.merge(source, CUSTOMER_ORDER_STATE, "test", 1)
    assert order_state(lake) == both
    newer = joined(spark, *[(o, c, city, "update_postimage", 9) for o, c, city, _, _ in tie])
    with pytest.raises(MergeError):
        lake.customers_orders.merge(newer, CUSTOMER_ORDER_STATE, "test", 2)
    assert order_state(lake) == both


def test_recreated_customer_inserts_again(spark, lake):
    for batch, change in enumerate([("insert", 1), ("delete", 2), ("insert", 3)]):
        kind, at = change
        lake.customers_orders.merge(joined(spark, ("o1", "c1", "Riga", kind, at)), CUSTOMER_ORDER_STATE, "test", batch)
    assert order_state(lake) == [("o1", "Riga", "insert")]


# --- plain upsert ------------------------------------------------------------


def windows(spark, *values):
    frame = spark.createDataFrame(
        [((day(d), day(d + 1)), author, n, float(n)) for d, author, n in values], schemas.AUTHORS_STATS
    )
    return frame


def test_author_windows(spark, lake):
    table = lake.authors_stats
    table.merge(windows(spark, (1, "a", 1), (1, None, 1)), AUTHOR_WINDOWS, "test", 0)
    table.merge(windows(spark, (1, "a", 5), (2, "a", 1), (1, None, 2)), AUTHOR_WINDOWS, "test", 1)
    # Running values replace, they do not add; a null author never matches.
    assert rows(table.read(), F.dayofmonth("time.start"), "author", "orders_count") == [
        (1, None, 1), (1, None, 2), (1, "a", 5), (2, "a", 1),
    ]


def test_recent_windows_write_only_themselves(spark, tmp_path):
    table = Lake(spark, str(tmp_path)).create().authors_stats
    old = windows(spark, *[(d, author, 1) for d in range(1, 28) for author in "abc"])
    table.merge(old, AUTHOR_WINDOWS, "test", 0)
    table.merge(windows(spark, (27, "a", 9), (27, "b", 9), (27, "z", 9)), AUTHOR_WINDOWS, "test", 1)
    assert rows(table.changes.read().filter("_commit_version = 1"), "author", "_change_type") == [
        ("a", "update_postimage"), ("b", "update_postimage"), ("z", "insert"),
    ]
    assert table.read().count() == 27 * 3 + 1


# --- merge_effects itself ----------------------------------------------------


def test_merge_effects_with_repeated_target_and_source_keys(spark):
    """Rows that stay are not mentioned; contradicting source rows show as two effects on one row."""
    schema = "customer_id STRING, row_time TIMESTAMP, row_status STRING"
    target = spark.createDataFrame([("c", day(1), "t1"), ("c", day(5), "t2"), ("d", day(1), "t3")], schema).withColumn(
        "number", F.substring("row_status", 2, 1).cast("int")
    )
    source = spark.createDataFrame(
        [("c", day(3), "update"), ("c", day(1), "update"), ("e", day(1), "x"), ("e", day(2), "y"), (None, day(3), "z")], schema
    )
    got = merge_effects(target, source, CUSTOMER_STATE, ["number"])
    assert rows(got, "t.row_status", "action", F.dayofmonth("after.row_time"), "number") == [
        (None, "insert", 1, None), (None, "insert", 2, None), (None, "insert", 3, None), ("t1", "update", 3, 1),
    ]
    twice = merge_effects(target, source.withColumn("row_time", F.lit(day(9))), CUSTOMER_STATE, ["number"])
    assert rows(twice.groupBy("number").count().filter("count > 1 AND number IS NOT NULL"), "number") == [(1,), (2,)]
