"""Bronze: topics and the country lookup, stored as they come."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tierstream import schemas
from tierstream.plans.lake import CatalogLake, Lake
from tierstream.streaming.catalog import Namespace
from tierstream.streaming.run import Trigger, append_to_folder, append_to_table


def ingest_topic(
    lake: Lake, topic: str, messages: DataFrame, trigger: Trigger = Trigger(), name: str | None = None,
    mode: str = "append",
) -> StreamingQuery:
    """Append a topic's messages (books, customers or orders) to its bronze table."""
    columns = [part.split()[0] for part in schemas.ENVELOPE.split(", ")]
    rows = messages.select(*columns)
    checkpoint = lake.checkpoint("bronze", topic)
    name = name or f"bronze_{topic}"
    if isinstance(lake, CatalogLake):
        table = Namespace("bronze", lake.env).table(topic)
        return append_to_table(rows, table, checkpoint, name, trigger, mode)
    if mode != "append":
        raise ValueError("a folder table can only be appended to")
    return append_to_folder(rows, lake.path("bronze", topic), checkpoint, name, trigger)
