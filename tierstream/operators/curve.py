"""Laying rows out so that each of several columns has few values per file."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 6  # of a rank; 64 ranges per column


def ranks(rows: DataFrame, columns: list[str], accuracy: int = 1000) -> list[Column]:
    """For each column, the number of the range of values (of about equally many rows) that a
    row falls in: 0 to 63, nulls in range 0.

    Borders are approximate percentiles: one row with at most 63 values per column, from a
    single pass that combines before its shuffle. Texts go by the number that their first
    eight bytes make up.
    """
    numbers = [_number(rows, name) for name in columns]
    wanted = [k / 2**BITS for k in range(1, 2**BITS)]
    found = rows.agg(*[F.percentile_approx(n, wanted, accuracy).alias(f"c{i}") for i, n in enumerate(numbers)]).first()
    return [_range(number, sorted(set(borders or []))) for number, borders in zip(numbers, found)]


def _number(rows: DataFrame, name: str) -> Column:
    """A column as a number that rises with it."""
    kind, column = rows.schema[name].dataType.typeName(), F.col(f"`{name}`")
    if kind in ("string", "binary"):
        digits = F.rpad(F.substring(F.hex(F.substring(column.cast("binary"), 1, 7)), 1, 14), 14, "0")
        return F.conv(digits, 16, 10).cast("bigint")
    if kind in ("timestamp", "timestamp_ntz"):
        return F.unix_micros(column.cast("timestamp"))
    if kind == "date":
        return F.unix_date(column).cast("bigint")
    return column.cast("double")


def _range(number: Column, borders: list, first: int = 0) -> Column:
    """How many borders a number reaches, by halving."""
    if not borders:
        return F.lit(first)
    middle = len(borders) // 2
    below = _range(number, borders[:middle], first)
    return F.when(number >= F.lit(borders[middle]), _range(number, borders[middle + 1 :], first + middle + 1)).otherwise(below)


def curve(numbers: list[Column]) -> Column:
    """The bits of several ranks, interleaved from the highest on: the place on a Z-order curve."""
    place = F.lit(0).cast("bigint")
    for bit in range(BITS - 1, -1, -1):
        for number in numbers:
            place = F.shiftleft(place, 1).bitwiseOR(F.shiftright(number, bit).bitwiseAND(F.lit(1)).cast("bigint"))
    return place
