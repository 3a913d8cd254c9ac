"""Approximate nearest neighbours in balanced posting lists.

Fit (on a bounded sample): vectors are halved again and again between two centres until
every part has at most ``per_list`` sample vectors, so the parts are of equal size; their
means are the centroids, linked to a navigable graph. At most ``sample`` vectors and
2 * sample / per_list centroids are held by the driver and each task; up to that many
vectors, the number of lists grows with the table.

Index (every vector): the graph is searched for a vector's nearest centroids. It goes into
the nearest one's posting list and, being near a boundary, into further ones whose distance
is within ``spread`` of the nearest, unless a list already chosen lies nearer to that
centroid than the vector does.

Search: from a query's nearest centroids the graph is followed to every centroid whose
distance is at most ``ratio`` times the nearest one's, however many they are, and their
lists are read. How far the lists of true neighbours lie depends on the vectors, so unless
it is given, ``ratio`` is the one that reaches a share ``recall`` of the ``k`` nearest of
256 sample vectors among the sample. A query for which these lists hold fewer than ``k`` others reads all lists;
with an infinite ``ratio`` every query does, and the result is exact. Scores are cosines of the original vectors in double
precision. Neighbouring lists stand on one of at most 64 shelves. A query goes to a shelf once,
with the numbers of the lists it reads there, and gets the best of all of them back, so what
it is sent does not grow with the lists it reads. Shelves and the queries for them are cut
into blocks of bounded size, each pair of
blocks one task's work, so neither a crowded list nor one that all queries read meets a
limit. Equal vectors are indexed and searched once; of each, the ``k + 1`` smallest ids are
all that any result can need.

Vectors that are null, zero, or hold null or non-finite components take no part, nor do
rows without vec_id and vectors of another length than the most frequent one. Of several
rows with the same vec_id the smallest vector counts. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tierstream.llm import blocks as B
from tierstream.session import working_folder

_LINKS, _ENTRIES, _AT_ONCE, _ROWS = 24, 16, 512, 8_192
_SHELVES, _COMPONENTS, _SCORES = 64, 4_194_304, 4_194_304


@dataclass(frozen=True)
class CentroidGraph:
    centroids: np.ndarray  # unit length
    links: np.ndarray  # of each centroid, the numbers of its neighbours
    entries: np.ndarray

    def nearest(self, unit: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """Numbers and squared distances of about the ``beam`` nearest centroids, nearest
        first; best-first search for all vectors at once."""
        n, k = len(unit), len(self.centroids)
        beam = min(beam, k)
        seen = np.zeros((n, k), bool)
        row = np.arange(n)[:, None]

        def far(at: np.ndarray) -> np.ndarray:
            return 2 - 2 * np.einsum("nd,nmd->nm", unit, self.centroids[at])

        first = np.broadcast_to(self.entries, (n, len(self.entries)))
        seen[row, first] = True
        found, distance, done = first.copy(), far(first), np.zeros(first.shape, bool)
        while True:
            order = np.argsort(distance, 1, kind="stable")[:, :beam]
            found, distance, done = (np.take_along_axis(x, order, 1) for x in (found, distance, done))
            waiting = ~done & np.isfinite(distance)
            if not waiting.any():
                return found, distance
            at = waiting.argmax(1)
            active = waiting.any(1)
            done[np.arange(n), at] = True
            near = self.links[found[np.arange(n), at]]
            fresh = ~seen[row, near] & active[:, None]
            seen[row, near] |= active[:, None]
            more = np.where(fresh, far(near), np.inf)
            found, distance = np.hstack([found, near]), np.hstack([distance, more])
            done = np.hstack([done, ~fresh])

    def within(self, unit: np.ndarray, ratio: float, beam: int = 32) -> np.ndarray:
        """Which centroids lie within ``ratio`` times the nearest one's distance, as one row of
        booleans for each vector. The graph is flooded from the ``beam`` nearest, a ring of
        neighbours at a time; only the ratio ends the search."""
        if not np.isfinite(ratio):
            return np.ones((len(unit), len(self.centroids)), bool)
        found, distance = self.nearest(unit, beam)
        far = np.full((len(unit), len(self.centroids)), np.inf, np.float32)
        row = np.arange(len(unit))[:, None]
        seen = np.isfinite(distance)
        far[np.broadcast_to(row, found.shape)[seen], found[seen]] = np.maximum(distance[seen], 0)
        limit = ratio**2 * np.maximum(far.min(1, keepdims=True), 1e-12)
        followed = np.zeros(far.shape, bool)
        while True:
            ring = (far <= limit) & ~followed
            if not ring.any():
                return far <= limit
            followed |= ring
            fresh = np.zeros(far.shape, bool)
            rows, at = np.nonzero(ring)
            for link in self.links.T:
                fresh[rows, link[at]] = True
            rows, at = np.nonzero(fresh & np.isinf(far))
            for low in range(0, len(rows), 65_536):
                r, c = rows[low : low + 65_536], at[low : low + 65_536]
                far[r, c] = np.maximum(2 - 2 * np.einsum("nd,nd->n", unit[r], self.centroids[c]), 0)
            limit = ratio**2 * np.maximum(far.min(1, keepdims=True), 1e-12)


def fit(vectors: np.ndarray, per_list: int, seed: int = 0) -> CentroidGraph:
    """Centroids of equal parts of the vectors (rows of unit length), and their graph."""
    random = np.random.default_rng(seed)
    parts, todo = [], [np.arange(len(vectors))]
    while todo:
        own = todo.pop()
        if len(own) <= per_list:
            parts.append(own)
            continue
        x = vectors[own]
        one, other = x[random.integers(len(own))], x[random.integers(len(own))]
        for _ in range(8):  # two centres, always with half of the vectors each
            order = np.argsort(x @ (one - other), kind="stable")
            other, one = x[order[: len(own) // 2]].mean(0), x[order[len(own) // 2 :]].mean(0)
        order = np.argsort(x @ (one - other), kind="stable")
        todo += [own[order[: len(own) // 2]], own[order[len(own) // 2 :]]]
    means = np.array([vectors[p].mean(0) for p in parts])
    centroids = means / np.maximum(np.linalg.norm(means, axis=1, keepdims=True), 1e-12)
    k = len(centroids)
    near = np.argsort(-(centroids @ centroids.T), 1, kind="stable")[:, : min(_LINKS, k)]
    far = random.integers(0, k, (k, min(4, k)))  # long links keep the graph in one piece
    return CentroidGraph(
        centroids.astype(np.float32), np.hstack([near, far]),
        random.choice(k, min(_ENTRIES, k), replace=False),
    )


def _matrix(column: pa.Array | pa.ChunkedArray, dimension: int) -> np.ndarray:
    values = B.plain(column).flatten().to_numpy(zero_copy_only=False)
    return values.reshape(-1, dimension)


def _unit(x: np.ndarray) -> np.ndarray:
    return (x / np.linalg.norm(x.astype(np.float64), axis=1, keepdims=True)).astype(np.float32)


def _route(graph: CentroidGraph, dimension: int, schema: pa.Schema, choose):
    """One row for each vector and shelf, with those of its lists that ``choose`` names (vectors'
    and lists' numbers)."""
    lists = len(graph.centroids)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, _AT_ONCE):
                part = batch.slice(low, _AT_ONCE)
                rows, chosen = choose(graph, _unit(_matrix(part.column("vector"), dimension)))
                order = np.lexsort((chosen, rows))
                rows, chosen = rows[order], chosen[order]
                shelf = chosen * min(_SHELVES, lists) // lists  # lists are numbered along the halving
                first, sizes = B.groups(rows * _SHELVES + shelf)
                for start in range(0, len(first), _ROWS):
                    at, n = first[start : start + _ROWS], sizes[start : start + _ROWS]
                    read = pa.ListArray.from_arrays(
                        pa.array(np.append(0, np.cumsum(n)), pa.int32()), pa.array(chosen[at[0] : at[-1] + n[-1]], pa.int32())
                    )
                    row = pa.array(rows[at])
                    columns = [pa.array(shelf[at], pa.int32()), read, part.column("node").take(row), part.column("vector").take(row)]
                    yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    return route


def _replicas(spread: float, most: int):
    def choose(graph: CentroidGraph, unit: np.ndarray):
        found, distance = graph.nearest(unit, 4 * most)
        distance = np.maximum(distance, 0)
        taken = np.zeros(found.shape, bool)
        taken[:, 0] = True
        near = distance <= (1 + spread) ** 2 * distance[:, :1]
        for j in range(1, found.shape[1]):
            # Not if a chosen list's centroid is nearer to this one than the vector is.
            between = 2 - 2 * np.einsum("nd,nmd->nm", graph.centroids[found[:, j]], graph.centroids[found[:, :j]])
            hidden = (taken[:, :j] & (between < distance[:, j : j + 1])).any(1)
            taken[:, j] = near[:, j] & ~hidden & (taken.sum(1) < most)
        rows, columns = np.nonzero(taken)
        return rows, found[rows, columns]

    return choose


def _within(ratio: float):
    return lambda graph, unit: np.nonzero(graph.within(unit, ratio))


def fit_ratio(
    graph: CentroidGraph, sample: np.ndarray, k: int, recall: float, spread: float, replicas: int, queries: int = 256
) -> float:
    """The distance ratio within which a share ``recall`` of the sample's neighbours are listed."""
    asked = sample[:queries]
    score = asked @ sample.T
    score[np.arange(len(asked)), np.arange(len(asked))] = -np.inf
    k = min(k, len(sample) - 1)
    if k < 1:
        return 1.0
    best = np.argpartition(-score, k - 1, 1)[:, :k]
    query, neighbour = np.repeat(np.arange(len(asked)), k), best.reshape(-1)
    far = np.maximum(2 - 2 * asked @ graph.centroids.T, 0)
    far /= np.maximum(far.min(1, keepdims=True), 1e-12)
    needed = np.full(len(query), np.inf, np.float32)
    choose = _replicas(spread, replicas)
    for low in range(0, len(query), _AT_ONCE):
        rows, lists = choose(graph, sample[neighbour[low : low + _AT_ONCE]])
        np.minimum.at(needed, low + rows, far[query[low + rows], lists])
    return float(np.sqrt(np.quantile(needed, recall, method="higher")))


def _by_list(column: pa.ChunkedArray) -> dict[int, np.ndarray]:
    """The rows of each list, rising."""
    read = B.plain(column)
    row = np.repeat(np.arange(len(read)), read.value_lengths().to_numpy())
    lists = read.flatten().to_numpy()
    order = np.argsort(lists, kind="stable")
    starts, sizes = B.groups(lists[order])
    return {int(lists[order[a]]): row[order[a : a + n]] for a, n in zip(starts, sizes, strict=True)}


def _search(k: int, dimension: int):
    """The ``k + 1`` best nodes of each query in all lists that it reads in a block of a shelf."""
    schema = pa.schema([("query", pa.int64()), ("node", pa.int64()), ("score", pa.float64())])

    def search(shelf: pa.Table, queries: pa.Table) -> pa.Table:
        if not shelf.num_rows or not queries.num_rows:
            return schema.empty_table()
        shelf = shelf.take(pa.array(np.argsort(B.ids(shelf["node"]), kind="stable")))
        nodes = B.ids(shelf["node"])
        x = _matrix(shelf["vector"], dimension).astype(np.float64)
        q = _matrix(queries["vector"], dimension).astype(np.float64)
        x_norm, q_norm = np.linalg.norm(x, axis=1), np.linalg.norm(q, axis=1)
        held, score = np.full((len(q), k + 1), -1), np.full((len(q), k + 1), -np.inf)  # rows of the shelf
        asked = _by_list(queries["lists"])
        for number, listed in _by_list(shelf["lists"]).items():
            own, vectors = asked.get(number, np.zeros(0, np.int64)), x[listed]
            step = max(1, _SCORES // len(listed))
            for low in range(0, len(own), step):
                at = own[low : low + step]
                found = (q[at] @ vectors.T) / (q_norm[at, None] * x_norm[None, listed])
                best = np.argsort(-found, 1, kind="stable")[:, : k + 1]  # ties to the smaller id
                found, best = np.take_along_axis(found, best, 1), listed[best]
                found[(best[:, :, None] == held[at][:, None, :]).any(2)] = -np.inf  # a replica found again
                best, found = np.hstack([held[at], best]), np.hstack([score[at], found])
                order = np.lexsort((best, -found), axis=1)[:, : k + 1]
                held[at], score[at] = np.take_along_axis(best, order, 1), np.take_along_axis(found, order, 1)
        full = np.isfinite(score)
        return pa.table(
            [np.repeat(B.ids(queries["node"]), full.sum(1)), nodes[held[full]], score[full]], schema=schema,
        )

    return search


def _blocks(index: DataFrame, wanted: DataFrame, block: int, k: int, dimension: int) -> DataFrame:
    """query, node, score of the best in each pair of blocks of a shelf and its queries."""
    # The counts are two numbers for each of at most 64 shelves.
    sizes = index.groupBy("shelf").count().withColumnRenamed("count", "n").join(
        wanted.groupBy("shelf").count().withColumnRenamed("count", "m"), "shelf"
    ).select("shelf", F.ceil(F.col("n") / block).cast("int").alias("n"), F.ceil(F.col("m") / block).cast("int").alias("m"))
    sizes = F.broadcast(index.sparkSession.createDataFrame(sizes.collect(), "shelf int, n int, m int"))
    at = lambda n: F.pmod(F.xxhash64("node"), F.col(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = index.join(sizes, "shelf").select("shelf", at("n").alias("x"), each("m").alias("y"), "lists", "node", "vector")
    right = wanted.join(sizes, "shelf").select("shelf", each("n").alias("x"), at("m").alias("y"), "lists", "node", "vector")
    return (
        left.groupBy("shelf", "x", "y").cogroup(right.groupBy("shelf", "x", "y"))
        .applyInArrow(_search(k, dimension), "query long, node long, score double")
        .groupBy("query", "node").agg(F.max("score").alias("score"))  # a replica is found again
    )


def _best_ids(found: DataFrame, members: DataFrame, k: int) -> DataFrame:
    """query, vec_id, score, n: the first ``k + 1`` rows of each query.

    They are of its first ``k + 1`` nodes, a node going by its smallest id, so ids are looked
    up for these alone, however many lists were read.
    """
    nodes = Window.partitionBy("query").orderBy(F.desc("score"), "node")
    ids = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("n", F.row_number().over(nodes)).where(F.col("n") <= k + 1)
        .join(members.select("node", "vec_id"), "node")
        .withColumn("n", F.row_number().over(ids)).where(F.col("n") <= k + 1).select("query", "vec_id", "score", "n")
    )


def nearest(
    embeddings: DataFrame, every: int = 50, k: int = 5, sample: int = 131_072, per_list: int = 64,
    spread: float = 0.1, replicas: int = 4, ratio: float | None = None, recall: float = 0.97, block: int | None = None,
) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found for each vec_id divisible by ``every``.

    ``block`` is the number of vectors or queries in a block, unless given as many as have
    four million components.

    The distinct vectors, their posting lists and what was found are written once below
    the shared folder, for what follows reads each of them several times.
    """
    spark = embeddings.sparkSession
    double = embeddings.schema["embedding"].dataType.simpleString() != "array<float>"
    element, arrow = ("double", pa.float64()) if double else ("float", pa.float32())
    finite = F.forall("vector", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    usable = (
        embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast(f"array<{element}>").alias("vector"))
        .where(F.col("vec_id").isNotNull() & F.col("vector").isNotNull() & finite & F.exists("vector", lambda x: x != 0))
        .groupBy("vec_id").agg(F.min("vector").alias("vector"))
    )
    length = usable.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").first()
    if length is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    dimension = length["n"]
    usable = usable.where(F.size("vector") == dimension).select(
        "vec_id", "vector", F.xxhash64("vector").alias("a"), F.xxhash64(F.lit(1), "vector").alias("b")
    )

    # Equal vectors: the k + 1 smallest ids, chosen in two steps because one may be very common.
    some = Window.partitionBy("a", "b", "salt").orderBy("vec_id")
    all_ = Window.partitionBy("a", "b").orderBy("vec_id")
    members = (
        usable.select("vec_id", "a", "b", F.pmod(F.xxhash64("vec_id"), F.lit(32)).alias("salt"))
        .withColumn("n", F.row_number().over(some)).where(F.col("n") <= k + 1)
        .withColumn("n", F.row_number().over(all_)).where(F.col("n") <= k + 1)
        .withColumn("node", F.first("vec_id").over(all_))
        .select("a", "b", "vec_id", "node")
    )
    folder = working_folder(spark, "vectors")

    def written(rows: DataFrame, name: str) -> DataFrame:
        rows.write.parquet(f"{folder}/{name}")
        return spark.read.schema(rows.schema).parquet(f"{folder}/{name}")

    members = written(members, "members")
    nodes = usable.join(members.where("vec_id = node").select(F.col("node").alias("vec_id")), "vec_id", "left_semi")
    nodes = written(nodes.select(F.col("vec_id").alias("node"), "a", "b", "vector"), "nodes")
    asked = usable.where(F.col("vec_id") % every == 0).select(F.col("vec_id").alias("query_id"), "a", "b")
    query_nodes = nodes.join(asked.select("a", "b").distinct(), ["a", "b"], "left_semi").select("node", "vector")

    chosen = nodes.orderBy(F.xxhash64("node"), "node").limit(sample).select("vector").toPandas()
    units = _unit(np.stack(chosen["vector"].to_numpy()))
    graph = fit(units, per_list)
    if ratio is None:
        ratio = fit_ratio(graph, units, k, recall, spread, replicas)
    block = block or max(1, _COMPONENTS // dimension)
    routed = f"shelf int, lists array<int>, node long, vector array<{element}>"
    schema = pa.schema([("shelf", pa.int32()), ("lists", pa.list_(pa.int32())), ("node", pa.int64()), ("vector", pa.list_(arrow))])
    index = nodes.select("node", "vector").mapInArrow(_route(graph, dimension, schema, _replicas(spread, replicas)), routed)
    index = written(index, "lists")

    def found_for(queries: DataFrame, reach: float) -> DataFrame:
        wanted = queries.mapInArrow(_route(graph, dimension, schema, _within(reach)), routed)
        return _best_ids(_blocks(index, wanted, block, k, dimension), members, k)

    top = written(found_for(query_nodes, ratio), "found")
    if np.isfinite(ratio):
        whole = top.where(F.col("n") == k + 1).select(F.col("query").alias("node"))
        short = query_nodes.join(whole, "node", "left_anti")
        if not short.isEmpty():
            top = top.join(whole.withColumnRenamed("node", "query"), "query", "left_semi")
            top = top.unionByName(written(found_for(short, float("inf")), "found_in_all"))
    top = top.join(nodes.select(F.col("node").alias("query"), "a", "b"), "query")
    ranked = Window.partitionBy("query_id").orderBy("n")
    return (
        asked.join(top, ["a", "b"]).where("vec_id <> query_id")
        .withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
