"""Documents dealt into segments, and key lists dealt into buckets.

A segment is a set of whole documents, chosen by their id; a bucket is a range of key
hashes. Each segment sends a bucket one row with its distinct keys, so a key in a third of
all documents weighs no more than one entry per segment, and the bucket answers each
segment with one row. Both counts follow ``spark.sql.shuffle.partitions``, which is set for
the data: a segment holds about half of what a shuffle partition holds. Segments are a
shuffle on the document's text; Spark reuses it for every pass of one query.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierstream.llm import blocks as B

KEY_LISTS = "bucket int, segment int, kind int, keys binary"


def parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def segmented(docs: DataFrame, carry: Sequence[str] = (), segments: int | None = None) -> DataFrame:
    """doc_id, text, segment, and the columns to carry along as one struct ``rest``."""
    n = segments or 2 * parts(docs.sparkSession)
    place = F.pmod(F.xxhash64("doc_id"), F.lit(n))
    rest = [F.struct(*(F.col(f"`{c}`") for c in carry)).alias("rest")] if carry else []
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", *rest, place.cast("int").alias("segment")
    )


def rest_type(docs: DataFrame, carry: Sequence[str]) -> str:
    """The part of a result's schema that holds the carried columns."""
    if not carry:
        return ""
    return ", rest " + docs.select(F.struct(*(F.col(f"`{c}`") for c in carry)).alias("r")).schema["r"].dataType.simpleString()


def lists(rows: list[tuple[int, int, int, bytes]]) -> pa.Table:
    """Rows of KEY_LISTS."""
    columns = list(zip(*rows, strict=True)) or [[], [], [], []]
    kinds = (pa.int32(), pa.int32(), pa.int32(), pa.binary())
    return pa.table(
        [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
        names=["bucket", "segment", "kind", "keys"],
    )


def received(replies: pa.Table, columns: int = 1) -> list[np.ndarray]:
    """The columns of all lists sent to a segment, in the order of the keys."""
    got = [B.load(x) for x in replies["keys"].to_pylist()]
    if not got:
        return [np.zeros(0, np.uint64)] * columns
    joined = [np.concatenate(x) for x in zip(*got, strict=True)]
    order = np.argsort(joined[0], kind="stable")
    return [x[order] for x in joined]
