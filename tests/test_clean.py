from datetime import date

import pytest
from pyspark.sql import functions as F
from pyspark.testing import assertDataFrameEqual

from tests.helpers import rows
from tierstream import schemas
from tierstream.functions import digits_number, first_number
from tierstream.operators.clean import keep_usable_keys, parse_payload, price_to_number
from tierstream.operators.dedup import drop_known_rows
from tierstream.operators.orders import clean_subtotals, explode_lines


@pytest.mark.parametrize(
    "names, kept",
    [
        (["Alice", "  ", "None", "null", "Bob"], ["Alice", "Bob"]),
        (["null", "None", "  "], []),
        (["Alice", "Bob"], ["Alice", "Bob"]),
        ([None, "NULL", "nOnE", ""], []),
        # Not trimmed before the word check, and only spaces count as blank.
        ([" null ", "\t"], ["\t", " null "]),
    ],
)
def test_usable_keys(spark, names, kept):
    frame = spark.createDataFrame([(n,) for n in names], "name STRING")
    assert [r[0] for r in rows(keep_usable_keys(frame, "name"))] == kept


def test_price_extraction(spark):
    prices = ["$123", "45 USD", "$67.89", "€100", "$2000"]
    frame = spark.createDataFrame(
        [(p, i, f"Book {i}") for i, p in enumerate(prices)], "price_details STRING, book_id INT, book_name STRING"
    )
    expected = spark.createDataFrame(
        [(v, i, f"Book {i}") for i, v in enumerate([123.0, 45.0, 67.89, 100.0, 2000.0])],
        "price_details DOUBLE, book_id INT, book_name STRING",
    )
    assertDataFrameEqual(price_to_number(frame, "price_details"), expected)


def test_price_oddities(spark):
    texts = ["No price", None, "", "1,234.5", ".5", "-7", "12."]
    frame = spark.createDataFrame([(t,) for t in texts], "price STRING")
    assert rows(price_to_number(frame, "price")) == [(1.0,), (12.0,), (5.0,), (7.0,)]


def test_number_functions(spark):
    frame = spark.createDataFrame([("$12.50",), ("none",), (None,)], "t STRING")
    got = [tuple(r) for r in frame.select(first_number(F.col("t")), digits_number(F.col("t"))).collect()]
    assert got == [(12.5, 1250.0), (None, None), (None, None)]


def test_payload_is_permissive(spark):
    texts = ['{"book_id": "b1", "price": "$1", "updated": "2024-01-01T00:00:00"}', "not json", '{"book_id": "b2", "updated": "soon"}']
    frame = spark.createDataFrame([(bytearray(t, "utf-8"),) for t in texts], "value BINARY")
    parsed = parse_payload(frame, schemas.BOOK_MESSAGE)
    assert parsed.columns == ["book_id", "title", "author", "price", "updated"]
    got = rows(parsed, "book_id", "price", F.col("updated").isNotNull())
    assert got == [(None, None, False), ("b1", "$1", True), ("b2", None, False)]


ORDERS = (
    "order_id STRING, order_timestamp TIMESTAMP, customer_id STRING, quantity BIGINT, total DOUBLE, "
    "books ARRAY<STRUCT<book_id: STRING, quantity: BIGINT, subtotal: STRING>>"
)


def test_subtotals(spark):
    frame = spark.createDataFrame(
        [
            ("o1", None, "c", 3, 9.0, [("b1", 1, "$12.50"), ("b2", 2, "free")]),
            ("o2", None, "c", 1, 9.0, []),
            ("o3", None, "c", 1, 9.0, None),
        ],
        ORDERS,
    )
    cleaned = clean_subtotals(frame)
    assert cleaned.schema["books"].dataType.simpleString() == "array<struct<book_id:string,quantity:bigint,subtotal:double>>"
    assert [r["books"] for r in cleaned.collect()] == [[("b1", 1, 1250.0), ("b2", 2, None)]]
    assert rows(explode_lines(frame), "order_id", "books.book_id") == [("o1", "b1"), ("o1", "b2")]


def test_content_dedup(spark):
    source = spark.createDataFrame([(1, "Alice"), (2, "Bob"), (3, "Charlie")], "id INT, name STRING")
    target = spark.createDataFrame(
        [(1, "Alice", date(2021, 1, 1), date(2023, 1, 1), True), (2, "Bob", date(2022, 1, 1), date(2024, 1, 1), True)],
        "id INT, name STRING, start_date DATE, end_date DATE, is_active BOOLEAN",
    )
    expected = spark.createDataFrame([(3, "Charlie")], "id INT, name STRING")
    for exact in (False, True):
        got = drop_known_rows(source, target, ["start_date", "end_date", "is_active"], exact)
        assertDataFrameEqual(got, expected)


def test_content_dedup_skips_nulls_unless_exact(spark):
    source = spark.createDataFrame([("a", None, "b")], "x STRING, y STRING, z STRING")
    target = spark.createDataFrame([("a", "b", None)], "x STRING, y STRING, z STRING")
    assert drop_known_rows(source, target, []).count() == 0
    assert drop_known_rows(source, target, [], exact=True).count() == 1
    assert drop_known_rows(source, source, [], exact=True).count() == 0
