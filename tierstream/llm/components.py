"""Connected components of links: union-find in each task, then stars across tasks."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The links of each batch reduced to (node, smallest node it reaches in the batch)."""
    for batch in batches:
        parent: dict[int, int] = {}

        def root(x: int) -> int:
            top = x
            while parent.get(top, top) != top:
                top = parent[top]
            while parent.get(x, x) != top:
                parent[x], x = top, parent[x]
            return top

        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            one, other = root(a), root(b)
            parent.setdefault(a, a), parent.setdefault(b, b)
            parent[max(one, other)] = min(one, other)
        nodes = [n for n in parent if root(n) != n]
        yield pa.RecordBatch.from_arrays(
            [pa.array(nodes, pa.int64()), pa.array([root(n) for n in nodes], pa.int64())], names=["node", "root"]
        )


def connected(links: DataFrame, folder: str) -> DataFrame:
    """node, root (smallest node of the component) for every node but the roots themselves.

    ``links`` has columns a and b. Rounds alternate between pointing a node's larger
    neighbours and its smaller ones at the smallest; each round is written to ``folder``,
    a place that all executors share, and the number of rounds grows with the logarithm of
    the component's size.
    """
    spark = links.sparkSession
    links.select("a", "b").where("a <> b").mapInArrow(_forest, "node long, root long").distinct().write.parquet(f"{folder}/0")
    step = 0
    while True:
        edges = spark.read.parquet(f"{folder}/{step}")
        if _are_stars(edges):
            return edges
        both = edges.select("node", "root").unionByName(edges.select(F.col("root").alias("node"), F.col("node").alias("root")))
        least = both.groupBy("node").agg(F.least(F.min("root"), F.col("node")).alias("least"))
        large = (
            both.join(least, "node").where("root > node")
            .select(F.col("root").alias("node"), F.col("least").alias("root"))
            .repartition("node").withColumn("least", F.min("root").over(Window.partitionBy("node")))
        )
        pairs = F.array(*(F.struct(F.col(c).alias("node"), F.col("least").alias("root")) for c in ("node", "root")))
        small = large.select(F.inline(pairs)).where("node <> root")
        step += 1
        small.distinct().write.parquet(f"{folder}/{step}")


def _are_stars(edges: DataFrame) -> bool:
    """Whether every node has one root and no root has one itself: one aggregate, one row."""
    ends = edges.select("node", "root").unionByName(
        edges.select(F.col("root").alias("node"), F.lit(None).cast("long").alias("root"))
    )
    odd = ends.groupBy("node").agg(
        (F.bool_or(F.col("root").isNull()) & F.bool_or(F.col("root").isNotNull())).alias("both"),
        (F.min("root") < F.max("root")).alias("several"),
    )
    return not odd.agg(F.bool_or(F.col("both") | F.coalesce("several", F.lit(False)))).first()[0]
