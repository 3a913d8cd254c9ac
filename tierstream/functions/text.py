"""Column expressions for dirty text. All stay inside whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words that senders write instead of leaving a key out.
MISSING_WORDS = ("null", "none")


def usable_key(column: str) -> Column:
    """False or null for keys that are missing, blank or spelled-out nulls.

    The word check does not trim and the blank check trims spaces only, so
    ``" null "`` and a tab count as usable.
    """
    key = F.col(column)
    return ~F.lower(key).isin(*MISSING_WORDS) & (F.trim(key) != "")


def first_number(text: Column) -> Column:
    """First unsigned number in a text as double, null if there is none."""
    return F.regexp_extract(text, r"\d+(\.\d+)?", 0).try_cast("double")


def digits_number(text: Column) -> Column:
    """All digits of a text read as one number; the decimal point is lost."""
    return F.regexp_replace(text, r"\D", "").try_cast("double")


def fingerprint(columns: list[str]) -> Column:
    """Content hash of a row. Nulls are skipped, so rows that differ only in
    where a null stands share a fingerprint."""
    return F.md5(F.concat_ws("|", *columns))
