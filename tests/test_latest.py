from tests.helpers import day, rows
from tierstream.operators.dedup import first_arrivals, rows_not_in, time_span
from tierstream.operators.latest import newest_per_key, newest_with_ties


def test_one_row_per_key(spark):
    frame = spark.createDataFrame(
        [("a", day(1), "old"), ("a", day(2), "x"), ("a", day(2), "y"), ("b", None, "n"), (None, day(1), "k")],
        "key STRING, at TIMESTAMP, what STRING",
    )
    assert rows(newest_per_key(frame, ["key"], "at")) == [
        (None, day(1), "k"), ("a", day(2), "y"), ("b", None, "n"),
    ]


def test_ties_are_kept(spark):
    frame = spark.createDataFrame(
        [("a", 1, day(1)), ("a", 2, day(2)), ("a", 3, day(2)), ("b", 4, None), ("b", 5, None), (None, 6, day(1)), (None, 7, day(3))],
        "key STRING, n INT, at TIMESTAMP",
    )
    got = newest_with_ties(frame, ["key"], "at")
    assert got.columns == frame.columns
    assert rows(got, "n") == [(2,), (3,), (4,), (5,), (7,)]


def test_hot_key(spark):
    """A third of all rows under one key: same answers as on the driver."""
    data = [("hot" if i % 3 == 0 else f"k{i % 50}", i * 7919 % 1000, i) for i in range(6000)]
    frame = spark.createDataFrame(data, "key STRING, at INT, n INT").repartition(4)
    best = {}
    for key, at, n in data:
        best.setdefault(key, []).append((at, n))
    one = {(k, *max(v)) for k, v in best.items()}
    assert set(map(tuple, newest_per_key(frame, ["key"], "at").collect())) == one
    tied = {(k, at, n) for k, v in best.items() for at, n in v if at == max(v)[0]}
    assert set(map(tuple, newest_with_ties(frame, ["key"], "at").collect())) == tied


def test_first_arrivals_in_batch(spark):
    frame = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "key STRING, n INT")
    assert rows(first_arrivals(frame, ["key"], 4, ["n"]), "key") == [("a",), ("b",)]


def test_rows_not_in_ignores_null_keys(spark):
    schema = "id STRING, at TIMESTAMP"
    source = spark.createDataFrame([("a", day(1)), ("a", day(9)), ("b", None)], schema)
    target = spark.createDataFrame([("a", day(1)), ("a", day(1)), ("b", None), ("c", day(5))], schema)

    def new(frame):
        count, first, last = time_span(frame, "at")
        assert count == frame.count()
        return rows(rows_not_in(frame, target, ["id", "at"], "at", first, last))

    assert new(source) == [("a", day(9)), ("b", None)]
    assert new(source.filter("at IS NULL")) == [("b", None)]
