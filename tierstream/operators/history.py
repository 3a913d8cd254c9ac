"""Preparing incoming versions for a type 2 history table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_merge_keys(source: DataFrame, target: DataFrame) -> DataFrame:
    """Incoming book versions, once to close the old version and once as the new one.

    Every row comes back keyed by its book; a row whose book has a current version
    comes back a second time without key, so that it matches nothing and is inserted.
    Columns: the source's with ``updated`` renamed, ``current``, ``end_date``,
    ``target_book_id`` and ``merge_key``.
    """
    live = target.filter("current").select(F.col("book_id").alias("target_book_id"))
    versions = source.withColumnRenamed("updated", "effective_date").withColumns(
        {"current": F.lit(True), "end_date": F.lit(None).cast("timestamp")}
    )
    found = versions.join(live, F.col("book_id") == F.col("target_book_id"), "left")
    # One pass: a found row fans out in place instead of a second join and a union.
    keys = F.when(
        F.col("target_book_id").isNotNull(), F.array(F.col("book_id"), F.lit(None).cast("string"))
    ).otherwise(F.array("book_id"))
    return found.withColumn("merge_key", F.explode(keys))
