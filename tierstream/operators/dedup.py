"""Duplicate removal: by content against a table, and by arrival on a stream."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierstream.functions import fingerprint


def drop_known_rows(
    source: DataFrame, target: DataFrame, meta_columns: list[str], exact: bool = False
) -> DataFrame:
    """Source rows whose content occurs nowhere in the target.

    Content is every target column outside ``meta_columns``. By default rows are
    compared by fingerprint, which treats a null as absent; ``exact`` compares the
    columns themselves, null equal to null. The target is reduced to distinct
    contents before the shuffle, so content repeated a billion times costs one row.
    """
    content = [name for name in target.columns if name not in meta_columns]
    if exact:
        known = target.select(*[F.col(c).alias(f"_known_{c}") for c in content]).distinct()
        same = [source[c].eqNullSafe(known[f"_known_{c}"]) for c in content]
        return source.join(known, same, "left_anti")
    known = target.select(fingerprint(content).alias("_content")).distinct()
    return source.withColumn("_content", fingerprint(content)).join(known, "_content", "left_anti").drop("_content")


def first_arrivals(
    rows: DataFrame,
    keys: list[str],
    spread: int = 1,
    spread_by: list[str] | None = None,
    within_watermark: bool = False,
) -> DataFrame:
    """First row per key, over the whole life of the stream.

    With ``spread`` above 1 a key's copies are first thinned out in that many
    slices (chosen by ``spread_by``, columns that differ between copies), so one
    key with a third of all rows does not end up in one task. It costs a second
    state entry per key. ``within_watermark`` forgets keys once the watermark has
    passed, which bounds the state but may let very late copies through.
    """
    def thin(frame: DataFrame, columns: list[str]) -> DataFrame:
        if within_watermark:
            return frame.dropDuplicatesWithinWatermark(columns)
        return frame.dropDuplicates(columns)

    # A batch dropDuplicates already combines before its shuffle.
    if rows.isStreaming and spread > 1 and spread_by:
        slice_number = F.pmod(F.xxhash64(*spread_by), F.lit(spread))
        rows = thin(rows.withColumn("_slice", slice_number), [*keys, "_slice"]).drop("_slice")
    return thin(rows, keys)


def rows_and_days(rows: DataFrame, time_column: str) -> tuple[int, list[date]]:
    """Row count and the distinct days (UTC) of a time: one pass, one row."""
    count, days = rows.agg(F.count("*"), F.collect_set(F.to_date(time_column))).first()
    return count, sorted(days)


def rows_not_in(source: DataFrame, target: DataFrame, keys: list[str]) -> DataFrame:
    """Source rows whose keys are not in the target; a null key is never found there."""
    return source.join(target.select(*keys).distinct(), keys, "left_anti")
