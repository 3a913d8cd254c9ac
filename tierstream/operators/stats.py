"""Aggregates of the gold layer. Spark combines before each shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def authors_stats(lines: DataFrame, window: str = "5 minutes") -> DataFrame:
    """Order lines and mean order quantity per author and tumbling window.

    ``quantity`` is the order's, repeated for each of its lines.
    """
    return lines.groupBy(F.window("order_timestamp", window).alias("time"), "author").agg(
        F.count("order_id").alias("orders_count"), F.avg("quantity").alias("avg_quantity")
    )


def countries_stats(customers_orders: DataFrame) -> DataFrame:
    """Orders and ordered books per country and day (a timestamp at midnight)."""
    day = F.date_trunc("DD", F.col("order_timestamp")).alias("order_date")
    return customers_orders.groupBy("country", day).agg(
        F.count("order_id").alias("orders_count"), F.sum("quantity").alias("total_books")
    )
