"""One row per micro-batch: which query, which target, how many rows."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tierstream import schemas
from tierstream.streaming.tables import AppendTable


def metrics_table(spark: SparkSession, path: str) -> AppendTable:
    return AppendTable(spark, path, schemas.BATCH_METRICS)


def record(
    table: AppendTable, query: str, writer: str, batch_id: int, target: str, rows: int, zone: str = "UTC"
) -> None:
    """Note a batch, with its time in UTC and in ``zone``, before its merge; a repeated attempt adds nothing."""
    line = table.spark.range(1).select(
        F.lit(query).alias("query"),
        F.lit(batch_id).cast("bigint").alias("batch_id"),
        F.lit(target).alias("target"),
        F.lit(rows).cast("bigint").alias("source_rows"),
        F.current_timestamp().alias("committed_at"),
        F.from_utc_timestamp(F.current_timestamp(), zone).alias("committed_local"),
    )
    table.append(line.coalesce(1), writer, batch_id)
