"""Small-table shorthand for the tests."""

from datetime import datetime


def rows(frame, *columns):
    """All rows as sorted tuples; nulls first."""
    picked = frame.select(*columns) if columns else frame
    return sorted((tuple(r) for r in picked.collect()), key=lambda r: [(v is not None, str(v)) for v in r])


def day(number, month=1):
    return datetime(2024, month, number)
