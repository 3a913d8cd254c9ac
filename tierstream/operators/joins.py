"""Joins between streams and tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A lookup above this row count is joined as Spark sees fit instead of broadcast.
LOOKUP_ROWS = 100_000


def broadcast_if_small(table: DataFrame, max_rows: int = LOOKUP_ROWS) -> DataFrame:
    """Mark a table for broadcast after counting that it has at most ``max_rows``."""
    fits = table.limit(max_rows + 1).count() <= max_rows
    return F.broadcast(table) if fits else table


def add_country(customers: DataFrame, lookup: DataFrame) -> DataFrame:
    """Replace ``country_code`` by the country's name; unknown codes are dropped."""
    names = broadcast_if_small(lookup.select("code", "country"))
    return customers.join(names, F.col("country_code") == F.col("code"), "inner").select(
        "customer_id", "email", "first_name", "last_name", "gender",
        "street", "city", "country", "row_status", "row_time",
    )


def lines_with_books(lines: DataFrame, books: DataFrame) -> DataFrame:
    """Order lines with title, author and price of the book's current version."""
    current = books.filter("current").select(
        F.col("book_id").alias("_book_id"), "title", "author", "price"
    )
    return lines.join(current, F.col("books.book_id") == F.col("_book_id"), "inner").drop("_book_id")


def heavy_keys(rows: DataFrame, key: str, share: int = 256) -> list[str]:
    """Keys that hold about one row in ``share`` or more, by a mergeable frequency sketch.

    The sketch tracks 16 * share keys, which bounds its error to a fraction of that share;
    as fewer than ``share`` keys can hold so much, the list is short whatever the table.
    """
    top = F.expr(f"approx_top_k({key}, {share}, {16 * share})")
    found = rows.filter(F.col(key).isNotNull()).agg(F.count("*").alias("n"), top.alias("top"))
    keys = found.select("n", F.explode("top").alias("t")).filter(F.col("t.count") * share >= F.col("n"))
    return sorted(row[0] for row in keys.select("t.item").collect())


def changes_with_orders(
    changes: DataFrame,
    orders: DataFrame,
    salts: int = 8,
    within: str | None = None,
    hot: list[str] | None = None,
) -> DataFrame:
    """Every customer change with every order of that customer.

    Orders are dealt into ``salts`` slices per customer and the (far fewer) changes
    repeated for each, so one customer with a third of all orders fills several
    tasks and several state stores. With ``hot`` only the customers named there are dealt
    out, and everyone else's changes are not repeated; the rows are the same either way.
    ``within`` adds a time bound between change and
    order, which lets a stream drop old state; without it nothing is ever dropped.
    """
    dealt = F.lit(True) if hot is None else F.col("customer_id").isin(hot)
    of_change = F.sequence(F.lit(0), F.when(dealt, salts - 1).otherwise(0))
    of_order = F.when(dealt, F.pmod(F.hash("order_id", "order_timestamp"), F.lit(salts))).otherwise(0)
    left = changes.withColumn("_slice", F.explode(of_change))
    right = orders.select(
        F.col("customer_id").alias("_customer"),
        *[c for c in orders.columns if c != "customer_id"],
        of_order.alias("_order_slice"),
    )
    condition: Column = (F.col("customer_id") == F.col("_customer")) & (
        F.col("_slice") == F.col("_order_slice")
    )
    if within is not None:
        span = F.expr(f"INTERVAL {within}")
        condition &= F.col("order_timestamp").between(F.col("row_time") - span, F.col("row_time") + span)
    return left.join(right, condition, "inner").drop("_slice", "_order_slice", "_customer")
