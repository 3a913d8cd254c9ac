"""Starting streams: triggers, append sinks and per-batch handlers."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from tierstream.session import adaptive
from tierstream.sources import files

# Gets the micro-batch, the id of the query that wrote it, and the batch's number.
BatchHandler = Callable[[DataFrame, str, int], None]


@dataclass(frozen=True)
class Trigger:
    """Drain what is there and stop, or run every so often."""

    available_now: bool = False
    every: str = "30 seconds"

    def on(self, writer: DataStreamWriter) -> DataStreamWriter:
        if self.available_now:
            return writer.trigger(availableNow=True)
        return writer.trigger(processingTime=self.every)


DRAIN = Trigger(available_now=True)


def append_to_folder(
    rows: DataFrame, path: str, checkpoint: str, name: str, trigger: Trigger = Trigger()
) -> StreamingQuery:
    """Append a stream to a Parquet folder, exactly once, by Spark's own file sink."""
    writer = rows.writeStream.format("parquet").option("path", path).outputMode("append")
    return trigger.on(writer.option("checkpointLocation", checkpoint).queryName(name)).start()


def append_to_table(
    rows: DataFrame,
    table: str,
    checkpoint: str,
    name: str,
    trigger: Trigger = Trigger(),
    mode: str = "append",
    table_format: str | None = None,
) -> StreamingQuery:
    """Append a stream to a catalog table."""
    writer = rows.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).queryName(name)
    if table_format:
        writer = writer.format(table_format)
    return trigger.on(writer).toTable(table)


def for_each_batch(
    rows: DataFrame,
    handle: BatchHandler,
    checkpoint: str,
    name: str,
    trigger: Trigger = Trigger(),
    mode: str = "append",
    reread: bool = True,
) -> StreamingQuery:
    """Hand every micro-batch to ``handle``, as files if that will read it more than once
    (``reread``). Errors end the query.

    The files lie beside the checkpoint while the batch is handled. A persisted batch would
    not do: Spark does not find it again where a plan holds the batch twice, and computes the
    stream's state once more for each such place, and all that was persisted on top of it.
    """

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        writer = session.sparkContext.getLocalProperty("sql.streaming.queryId")
        staged = f"{checkpoint}_batch/{batch_id}"
        if reread:
            batch.write.mode("overwrite").parquet(staged)
            batch = session.read.schema(batch.schema).parquet(staged)
        try:
            with adaptive(session):
                handle(batch, writer, batch_id)
        finally:
            if reread:
                files.remove(session, staged)

    writer = rows.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).queryName(name)
    return trigger.on(writer.foreachBatch(on_batch)).start()


def drain(query: StreamingQuery) -> StreamingQuery:
    """Wait for an available-now query and raise what went wrong in it."""
    query.awaitTermination()
    return query
