"""Newest row per key, with and without ties."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def newest_per_key(rows: DataFrame, keys: list[str], by: str, ties: list[str] | None = None) -> DataFrame:
    """Exactly one row per key: the one with the greatest ``by``, nulls last.

    Ties fall to the greatest of the ``ties`` columns, by default all others, so
    that a recomputed partition picks the same row again. Spark cuts each key to
    one row per task before the shuffle, which keeps a hot key cheap.
    """
    if ties is None:
        ties = [c for c in rows.columns if c not in keys and c != by]
    order = [F.col(c).desc() for c in (by, *ties)]
    newest_first = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("_place", F.row_number().over(newest_first)).filter("_place = 1").drop("_place")


def newest_with_ties(rows: DataFrame, keys: list[str], by: str) -> DataFrame:
    """All rows that share their key's greatest ``by``, nulls last.

    The greatest value is aggregated (combined before the shuffle) and joined back.
    A window would gather every tie of a hot key in one task; the join can be split.
    """
    top = rows.groupBy(*[F.col(k).alias(f"_top_{k}") for k in keys]).agg(F.max(by).alias("_top"))
    same = [F.col(k).eqNullSafe(F.col(f"_top_{k}")) for k in keys]
    joined = rows.join(top, [*same, F.col(by).eqNullSafe(F.col("_top"))])
    return joined.select(*rows.columns)
