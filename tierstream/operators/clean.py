"""Parsing and cleaning. Every function works on batch and streaming frames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierstream.functions import first_number, usable_key


def parse_payload(envelopes: DataFrame, schema: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """JSON bytes in ``value`` to typed top-level columns.

    Text that is not JSON gives a row of nulls, a field of the wrong type a null.
    ``keep`` names envelope columns to carry along. The document passes through a generator,
    which a later filter on its fields cannot be pushed below: each message is parsed once.
    """
    document = F.from_json(F.col("value").cast("string"), schema)
    return envelopes.select(F.inline(F.array(document)), *keep)


def keep_usable_keys(rows: DataFrame, *columns: str) -> DataFrame:
    """Drop rows in which any of the key columns is missing or a spelled-out null."""
    for column in columns:
        rows = rows.filter(usable_key(column))
    return rows


def price_to_number(rows: DataFrame, column: str) -> DataFrame:
    """Replace a price text by its first number and drop rows without one."""
    return rows.withColumn(column, first_number(F.col(column))).filter(F.col(column).isNotNull())
