"""Gold: windowed author statistics and daily country statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tierstream.operators.merge import AUTHOR_WINDOWS
from tierstream.operators.stats import authors_stats, countries_stats
from tierstream.plans.lake import Lake
from tierstream.streaming.metrics import record
from tierstream.streaming.run import BatchHandler, Trigger, for_each_batch


def upsert_authors_stats(lake: Lake, name: str) -> BatchHandler:
    """Replace the windows a batch has changed by their running values."""

    def handle(batch: DataFrame, writer: str, batch_id: int) -> None:
        rows = batch.count()
        record(lake.metrics, name, writer, batch_id, "gold_authors_stats", rows)
        if rows:
            lake.authors_stats.merge(batch, AUTHOR_WINDOWS, writer, batch_id)

    return handle


def gold_authors_stats(
    lake: Lake,
    trigger: Trigger = Trigger(),
    watermark: str = "10 minutes",
    window: str = "5 minutes",
    name: str = "gold_authors_stats",
) -> StreamingQuery:
    """Rows later than the watermark allows are dropped, others update their window."""
    lines = lake.books_orders.stream(**lake.pace).withWatermark("order_timestamp", watermark)
    checkpoint = lake.checkpoint("gold", "gold_authors_stats")
    return for_each_batch(
        authors_stats(lines, window), upsert_authors_stats(lake, name), checkpoint, name, trigger, mode="update"
    )


def gold_countries_stats(lake: Lake, view: str | None = None) -> DataFrame:
    """Orders per country and day as of now, optionally also as a temporary view."""
    stats = countries_stats(lake.customers_orders.read())
    if view:
        stats.createOrReplaceTempView(view)
    return stats
