"""Order documents: nested lines in and out of rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierstream.functions import digits_number


def clean_subtotals(orders: DataFrame) -> DataFrame:
    """Turn every line's subtotal text into a number; orders without lines go.

    Rewrites the array in place of exploding and regrouping it: no shuffle, line
    order kept, and an order with very many lines never meets others in a group.
    Expects one row per order, which the arrival dedup guarantees.
    """
    lines = F.transform(
        "books",
        lambda line: F.struct(
            line["book_id"].alias("book_id"),
            line["quantity"].alias("quantity"),
            digits_number(line["subtotal"]).alias("subtotal"),
        ),
    )
    return orders.filter(F.size("books") > 0).select(
        "order_id", "order_timestamp", "customer_id", "quantity", "total", lines.alias("books")
    )


def explode_lines(orders: DataFrame) -> DataFrame:
    """One row per order line, the line as struct ``books``. Null and empty arrays vanish."""
    return orders.withColumn("books", F.explode("books"))
