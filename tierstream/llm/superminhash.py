"""Near-duplicate grouping by SuperMinHash.

A document's set is its distinct shingles of five words (A-Z lower-cased), or the whole
word sequence where it has fewer. For each element, SuperMinHash draws a random permutation
of the m slots and a random fraction; the j-th slot of the permutation gets j + fraction if
that is smaller than what it has. The draws for j + 1 are made only while some slot of the
document is still above j + 1, so a long document stops after one draw per element.

Signatures are cut into bands; documents that share a band are candidates, and every
candidate link is confirmed on the full sets (56-bit shingle hashes). Documents with
equal sets are one node, so a group of copies costs one row. Within a band the smallest node
is compared with all others first; links found are joined by union-find, and only pairs of
a band that are then still in different groups are compared with each other; union-find
then goes on from the groups. Where many nodes are still apart, their elements are counted
first: two sets that share no element of few sets have at most the smaller one's common
elements together, which most sets that link with nothing show to be too few. With 32 bands of 4 slots a pair at similarity 0.75 is missed
with a chance of 5 in a million.

Empty sets link with nothing. Null doc_id: linked with nothing, no component, kept. Rows
with the same doc_id are one document that holds all their sets: it links what any of them
links. Null text is empty. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tierstream.llm import blocks as B
from tierstream.llm.components import connected
from tierstream.session import working_folder

SLOTS, ROWS = 128, 4
_BYTES_AT_ONCE = 4_000_000
_FRACTION = np.uint64(56)
_CROWDED, _BLOCK = 8, 128
_ELEMENTS, _ELEMENT_BITS = 131_072, 56
_COLUMNS = 16_384


def signatures(elements: np.ndarray, owner: np.ndarray, docs: int, m: int = SLOTS) -> np.ndarray:
    """One row of m slots per document: the draw's number in the high byte, the fraction below.

    ``elements`` are 64-bit hashes, sorted by ``owner``; a document without any keeps the
    largest value in all slots.
    """
    best = np.full(docs * m, np.uint64(2**64 - 1))
    permuted = None
    for draw in range(m):
        if not len(elements):
            break
        random = B.mix(elements + B.series(1, 1000 + draw)[0])
        left = np.uint64(m - draw)
        pick = draw + (((random >> np.uint64(32)) * left) >> np.uint64(32)).astype(np.int64)
        if permuted is None:
            slot = pick
        else:
            row = np.arange(len(elements))
            slot = permuted[row, pick].astype(np.int64)
            permuted[row, pick] = permuted[row, draw]
            permuted[row, draw] = slot
        value = (np.uint64(draw) << _FRACTION) | (B.mix(random) >> np.uint64(8))
        np.minimum.at(best, owner * m + slot, value)
        full = best.reshape(docs, m).max(1) < (np.uint64(draw + 1) << _FRACTION)
        more = ~full[owner]
        if permuted is None:
            permuted = np.tile(np.arange(m, dtype=np.uint8), (int(more.sum()), 1))
            row, first = np.arange(len(permuted)), pick[more]
            permuted[row, first] = 0
            permuted[:, 0] = first
        else:
            permuted = permuted[more]
        elements, owner = elements[more], owner[more]
    return best.reshape(docs, m)


def shingles(texts: pa.Array | pa.ChunkedArray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes and the number of their text, sorted by text and hash."""
    data, offsets = B.utf8(texts)
    data = B.LOWER[data]
    starts, ends, owner = B.words(data, offsets)
    hashes = B.hash_spans(data, starts, ends, 31)
    at = np.flatnonzero(B.inside(owner, width))
    found, of = B.rolling(hashes, width, 32)[at], owner[at]
    # Texts with fewer words: the whole sequence, folded with its length.
    counts = np.bincount(owner, minlength=len(offsets) - 1)
    short = np.flatnonzero((counts > 0) & (counts < width))
    first = np.searchsorted(owner, short)
    whole = B.series(width + 1, 33)[counts[short]]
    factors = B.series(width, 34) | np.uint64(1)
    for k in range(width - 1):
        has = counts[short] > k
        whole[has] += hashes[first[has] + k] * factors[k]
    found, of = np.append(found, B.mix(whole)), np.append(of, short)
    order = np.lexsort((found, of))
    found, of = found[order], of[order]
    new = np.ones(len(found), bool)
    new[1:] = (found[1:] != found[:-1]) | (of[1:] != of[:-1])
    return found[new], of[new]


def slices(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about _BYTES_AT_ONCE bytes, one row at least."""
    sizes = np.cumsum(np.diff(B.utf8(texts)[1]))
    low = 0
    while low < len(texts):
        done = sizes[low - 1] if low else 0
        high = max(low + 1, int(np.searchsorted(sizes, done + _BYTES_AT_ONCE, "right")))
        yield low, high
        low = high


def set_digests(found: np.ndarray, of: np.ndarray, docs: int) -> list[pa.Array]:
    """Two 64-bit numbers that name a document's set."""
    digests = []
    starts, _ = B.groups(of)
    for seed in (37, 38):
        total = np.zeros(docs, np.uint64)
        if len(starts):
            total[of[starts]] = np.add.reduceat(B.mix(found ^ B.series(1, seed)[0]), starts)
        digests.append(pa.array(total.view(np.int64)))
    return digests


def _sketch(width: int):
    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text")
            for low, high in slices(texts):
                found, of = shingles(texts.slice(low, high - low), width)
                docs = high - low
                sizes = np.bincount(of, minlength=docs)
                bands = np.zeros((docs, SLOTS // ROWS), np.uint64)
                slots = signatures(found, of, docs)
                factors = B.series(ROWS, 35) | np.uint64(1)
                for k in range(ROWS):
                    bands += slots[:, k::ROWS] * factors[k]
                bands = B.mix(bands + B.series(SLOTS // ROWS, 36))
                digests = set_digests(found, of, docs)
                lists = pa.ListArray.from_arrays(
                    pa.array(np.arange(docs + 1) * (SLOTS // ROWS), pa.int32()),
                    pa.array(bands.reshape(-1).view(np.int64)),
                )
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(low, docs), pa.array(sizes, pa.int64()), *digests, lists],
                    names=["doc_id", "n_shingles", "set_a", "set_b", "bands"],
                )

    return sketch


def _full_sets(width: int):
    def full_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text")
            for low, high in slices(texts):
                found, of = shingles(texts.slice(low, high - low), width)
                digests = set_digests(found, of, high - low)
                found = found >> np.uint64(8)
                cuts = np.searchsorted(of, np.arange(high - low + 1))
                blobs = [B.dump(found[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(low, high - low), *digests, pa.array(blobs, pa.binary())],
                    names=["doc_id", "set_a", "set_b", "elements"],
                )

    return full_sets


def _linked(percent: int):
    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep, last = [], (None, None)
            for one, other in zip(batch.column("a_set").to_pylist(), batch.column("b_set").to_pylist(), strict=True):
                if last[0] != one:
                    last = (one, B.load(one)[0])
                x, y = last[1], B.load(other)[0]
                common = int(B.member(y, x).sum())
                keep.append(100 * common >= percent * (len(x) + len(y) - common))
            yield pa.RecordBatch.from_arrays(
                [batch.column("a"), batch.column("b")], names=["a", "b"]
            ).filter(pa.array(keep, pa.bool_()))

    return linked


def _trees(percent: int):
    """Of each block of sets: every node with the smallest one that its links reach there."""

    def trees(table: pa.Table) -> pa.Table:
        nodes = B.ids(table["node"])
        order = np.argsort(nodes, kind="stable")
        nodes, blobs = nodes[order], table["elements"].take(pa.array(order)).to_pylist()
        sets = [B.load(x)[0] for x in blobs]
        sizes = np.array([len(x) for x in sets])
        owner, elements = np.repeat(np.arange(len(sets)), sizes), np.concatenate(sets)
        by_value = np.argsort(elements, kind="stable")
        _, counts = B.groups(elements[by_value])
        shared = np.repeat(counts > 1, counts)
        owner, column = owner[by_value][shared], np.repeat(np.cumsum(counts > 1) - 1, counts)[shared]
        common = np.zeros((len(sets), len(sets)), np.float64)
        for low in range(0, int(column[-1]) + 1 if len(column) else 0, _COLUMNS):
            a, b = np.searchsorted(column, [low, low + _COLUMNS])
            part = np.zeros((len(sets), _COLUMNS), np.float32)
            part[owner[a:b], column[a:b] - low] = 1
            common += part @ part.T
        linked = 100 * common >= percent * (sizes[:, None] + sizes[None, :] - common)
        np.fill_diagonal(linked, True)
        label = np.arange(len(sets))
        while True:
            least = np.where(linked, label[None, :], len(sets)).min(1)
            if (least == label).all():
                break
            label = least
        return pa.table({"a": nodes[label], "b": nodes})

    return trees


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each set cut into ``parts`` ranges of hashes, those that hold any."""
    for batch in batches:
        if not batch.num_rows:
            continue
        rows, part, blobs = [], [], []
        for row, (n, blob) in enumerate(zip(batch.column("parts").to_pylist(), batch.column("elements").to_pylist(), strict=True)):
            elements = B.load(blob)[0] if n > 1 else None
            for p, held in B.dealt(elements, n, _ELEMENT_BITS) if n > 1 else [(0, None)]:
                rows.append(row), part.append(p), blobs.append(B.dump(elements[held]) if n > 1 else blob)
        own = [batch.column(c).take(pa.array(rows, pa.int64())) for c in ("cluster", "node", "root")]
        yield pa.RecordBatch.from_arrays(
            [*own, pa.array(part, pa.int32()), pa.array(blobs, pa.binary())], names=["cluster", "node", "root", "part", "elements"]
        )


def _counts(few: int):
    """Of each part of a cluster's sets, counting only elements that sets of several groups hold:
    the size of each node's part and its elements in more than ``few`` sets; and for each
    pair of nodes of different groups, the elements they share of those in at most ``few``."""
    schema = pa.schema([(c, pa.int64()) for c in ("cluster", "node", "root", "size", "common", "other", "shared")])

    def counts(table: pa.Table) -> pa.Table:
        nodes, roots = B.ids(table["node"]), B.ids(table["root"])
        order = np.argsort(nodes, kind="stable")
        nodes, roots = nodes[order], roots[order]
        sets = [B.load(x)[0] for x in table["elements"].take(pa.array(order)).to_pylist()]
        sizes = np.array([len(x) for x in sets])
        owner, elements = np.repeat(np.arange(len(sets)), sizes), np.concatenate(sets)
        by_value = np.argsort(elements, kind="stable")
        owner = owner[by_value]
        starts, held = B.groups(elements[by_value])
        between = np.minimum.reduceat(roots[owner], starts) < np.maximum.reduceat(roots[owner], starts)
        common = np.bincount(owner[np.repeat(between & (held > few), held)], minlength=len(sets))
        pairs = [np.zeros(0, np.int64)]
        for n in range(2, few + 1):
            among = owner[starts[between & (held == n)][:, None] + np.arange(n)]
            a, b = (among[:, i].reshape(-1) for i in np.triu_indices(n, 1))
            apart = roots[a] != roots[b]
            pairs.append(a[apart] * len(sets) + b[apart])
        pairs, shared = np.unique(np.concatenate(pairs), return_counts=True)
        cluster = table["cluster"][0].as_py()
        none = lambda n: pa.nulls(n, pa.int64())
        columns = [
            (np.full(len(sets), cluster), nodes, roots, sizes, common, none(len(sets)), none(len(sets))),
            (np.full(len(pairs), cluster), nodes[pairs // len(sets)], *[none(len(pairs))] * 3, nodes[pairs % len(sets)], shared),
        ]
        return pa.concat_tables(pa.table([pa.array(x, pa.int64()) for x in c], schema=schema) for c in columns)

    return counts


def _open(members: DataFrame, sets: DataFrame, percent: int, written) -> tuple[DataFrame, DataFrame]:
    """Which nodes of a cluster (cluster, node, root), and which single pairs (a, b), may have
    links between its groups.

    Elements are told apart by the number of the cluster's sets that hold them. Two nodes
    share at most the smaller one's elements held by many, and besides, those held by few,
    which are counted for each pair that shares any. A pair that shares none can only link
    if each node's number of common elements allows for the other's size. For that, each size
    is given the smallest size among the nodes that allow for it. No link is lost.
    """
    sizes = members.groupBy("cluster").agg(F.ceil(F.sum("n_shingles") / _ELEMENTS).cast("int").alias("parts"))
    counts = written(
        members.join(sizes, "cluster").join(sets, "node").select("cluster", "node", "root", "parts", "elements")
        .mapInArrow(_cut, "cluster long, node long, root long, part int, elements binary")
        .groupBy("cluster", "part").applyInArrow(
            _counts(2 * _CROWDED), "cluster long, node long, root long, size long, common long, other long, shared long"
        ),
        "counts",
    )
    nodes = (
        counts.where("other IS NULL").groupBy("cluster", "node", "root").agg(F.sum("size").alias("size"), F.sum("common").alias("common"))
        .withColumn("reach", F.expr(f"{100 + percent} * common DIV {percent} - size"))
    )
    by_size = nodes.groupBy("cluster", "size").agg(F.max("reach").alias("reach"))
    order = Window.partitionBy("cluster").orderBy(F.desc("at"))
    least = (
        by_size.selectExpr("cluster", "reach AS at", "size AS partner", "CAST(NULL AS LONG) AS size")
        .unionByName(by_size.selectExpr("cluster", "size AS at", "CAST(NULL AS LONG) AS partner", "size"))
        .withColumn("least", F.min("partner").over(order)).where("size IS NOT NULL").select("cluster", "size", "least")
    )
    alive = nodes.join(least, ["cluster", "size"]).where("least <= reach").select("cluster", "node", "root")
    one, other = (nodes.select("cluster", F.col("node").alias(c), *(F.col(x).alias(f"{c}_{x}") for x in ("size", "common"))) for c in ("a", "b"))
    pairs = (
        counts.where("other IS NOT NULL").groupBy("cluster", F.col("node").alias("a"), F.col("other").alias("b"))
        .agg(F.sum("shared").alias("shared")).join(one, ["cluster", "a"]).join(other, ["cluster", "b"])
        .where(f"{100 + percent} * (shared + least(a_common, b_common)) >= {percent} * (a_size + b_size)")
    )
    return alive, pairs.select("a", "b")


def _clusters(crowd: DataFrame) -> DataFrame:
    """cluster, node, root, n_shingles: the nodes of crowded bands.

    Bands that share nodes should be one cluster, so that a pair is compared once: two steps
    of passing on the smallest band number do most of that, and whatever they leave is right
    all the same, as all nodes of a band are in that band's cluster.
    """
    clusters = crowd.select("node", "band", "root", "n_shingles", F.col("band").alias("cluster"))
    for _ in range(2):
        of_node = clusters.groupBy("node").agg(F.min("cluster").alias("least"))
        passed = clusters.join(of_node, "node").groupBy("band").agg(F.min("least").alias("cluster"))
        clusters = clusters.drop("cluster").join(passed, "band")
    return clusters.select("cluster", "node", "root", "n_shingles").distinct()


def _blockwise(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links among the nodes of clusters that are in different groups so far.

    In a cluster, the nodes outside its largest group are cut into blocks, and so are those
    inside; each pair of blocks with an outer one is one task's work. Two nodes of the
    largest group never meet.
    """
    sizes = members.groupBy("cluster", "root").agg(F.count("*").alias("n"))
    largest = sizes.groupBy("cluster").agg(
        F.max_by("root", F.struct("n", "root")).alias("largest"), F.max("n").alias("inner"), F.sum("n").alias("all")
    ).select(
        "cluster", "largest", F.ceil((F.col("all") - F.col("inner")) / _BLOCK).cast("int").alias("outer"),
        F.ceil(F.col("inner") / _BLOCK).cast("int").alias("inner"),
    ).where("outer > 0")
    outside = F.col("root") != F.col("largest")
    hashed = F.xxhash64("node")
    own = F.when(outside, F.pmod(hashed, F.col("outer"))).otherwise(F.col("outer") + F.pmod(hashed, F.col("inner")))
    others = F.sequence(F.lit(0), F.when(outside, F.col("outer") + F.col("inner")).otherwise(F.col("outer")) - 1)
    each = (
        members.join(largest, "cluster").select("node", "cluster", own.cast("int").alias("own"), F.explode(others).alias("other"))
        .select("node", "cluster", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"))
    )
    return each.join(sets, "node").groupBy("cluster", "x", "y").applyInArrow(_trees(percent), "a long, b long").where("a <> b")


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 75) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id that links reach) and kept.

    Intermediate tables go under ``spark.checkpoint.dir``.
    """
    spark = docs.sparkSession
    folder = working_folder(spark, "near-duplicates")

    def written(frame: DataFrame, name: str) -> DataFrame:
        frame.write.parquet(f"{folder}/{name}")
        return spark.read.parquet(f"{folder}/{name}")

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sketches = written(
        texts.mapInArrow(
            _sketch(width), "doc_id long, n_shingles long, set_a long, set_b long, bands array<long>"
        ),
        "sketches",
    )
    # A node is a distinct set; the number it gets is written, so that it stays what it is.
    filled = sketches.where("n_shingles > 0 AND doc_id IS NOT NULL")
    distinct = filled.groupBy("set_a", "set_b").agg(
        F.min("doc_id").alias("doc_id"), F.any_value("bands").alias("bands"), F.min("n_shingles").alias("n_shingles")
    )
    nodes = written(distinct.withColumn("node", F.monotonically_increasing_id()), "nodes")

    # Bands that hold several nodes; the smallest node of each is compared with the others.
    banded = nodes.select("node", "n_shingles", F.explode("bands").alias("band"))
    heads = (
        banded.groupBy("band").agg(F.min(F.struct("node", "n_shingles")).alias("head"), F.max("node").alias("other"))
        .where("head.node < other").select("band", "head")
    )
    shared = written(banded.join(heads, "band").select("band", "head", "node", "n_shingles"), "bands")
    candidates = shared.select("node").distinct().join(nodes.select("node", "doc_id", "set_a", "set_b"), "node")
    sets = written(
        texts.join(candidates.select("doc_id").distinct(), "doc_id", "left_semi")
        .mapInArrow(_full_sets(width), "doc_id long, set_a long, set_b long, elements binary")
        .join(candidates.select("node", "set_a", "set_b"), ["set_a", "set_b"])
        .select("node", "elements").dropDuplicates(["node"]),
        "sets",
    )

    def confirmed(pairs: DataFrame) -> DataFrame:
        one = sets.select(F.col("node").alias("a"), F.col("elements").alias("a_set"))
        other = sets.select(F.col("node").alias("b"), F.col("elements").alias("b_set"))
        return pairs.join(one, "a").join(other, "b").select("a", "b", "a_set", "b_set").mapInArrow(
            _linked(percent), "a long, b long"
        )

    near = f"100 * least(x.n_shingles, y.n_shingles) >= {percent} * greatest(x.n_shingles, y.n_shingles)"
    stars = shared.selectExpr("head AS x", "struct(node, n_shingles) AS y").where(f"x.node <> y.node AND {near}")
    pairs = written(stars.selectExpr("x.node AS a", "y.node AS b").distinct(), "star-pairs")
    roots = connected(written(confirmed(pairs), "star-links"), f"{folder}/star-groups")

    # What is left: bands whose nodes are still in several groups.
    placed = shared.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    per_band = (
        placed.groupBy("band", "root").agg(F.count("*").alias("n"))
        .groupBy("band").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("n")).alias("squares"), F.count("*").alias("groups"))
        .where("groups > 1")
        .select("band", F.expr(f"n * n - squares > {2 * _CROWDED} * n").alias("crowded"))
    )
    mixed = written(placed.drop("head").join(per_band, "band"), "mixed")
    few = mixed.where("NOT crowded")
    open_nodes, open_pairs = _open(_clusters(mixed.where("crowded")), sets, percent, written)
    rest = (
        few.alias("x").join(few.alias("y"), F.expr(f"x.band = y.band AND x.root <> y.root AND x.node < y.node AND {near}"))
        .select(F.col("x.node").alias("a"), F.col("y.node").alias("b")).unionByName(open_pairs).distinct().join(pairs, ["a", "b"], "left_anti")
    )
    links = confirmed(rest).unionByName(_blockwise(open_nodes, sets, percent))

    def merged(found: DataFrame, roots: DataFrame, name: str) -> DataFrame:
        """The groups after further links, which are few, between groups."""
        one, other = (roots.select(F.col("node").alias(c), F.col("root").alias(f"{c}_root")) for c in ("a", "b"))
        between = found.join(one, "a", "left").join(other, "b", "left").select(
            F.coalesce("a_root", "a").alias("a"), F.coalesce("b_root", "b").alias("b")
        ).where("a <> b").distinct()
        further = connected(written(between, f"{name}-links"), f"{folder}/{name}-groups")
        up = further.select(F.col("node").alias("root"), F.col("root").alias("top"))
        moved = roots.join(up, "root", "left").select("node", F.coalesce("top", "root").alias("root"))
        return written(moved.unionByName(further.join(roots, "node", "left_anti")), name)

    roots = merged(links, roots, "all")
    # A doc_id with several texts holds their sets together.
    one_set = F.struct("set_a", "set_b")
    several = filled.groupBy("doc_id").agg(F.min(one_set).alias("x"), F.max(one_set).alias("y")).where("x < y")
    held = filled.join(several.select("doc_id"), "doc_id", "left_semi").select("doc_id", "set_a", "set_b")
    held = held.join(nodes.select("set_a", "set_b", "node"), ["set_a", "set_b"])
    together = held.groupBy("doc_id").agg(F.min("node").alias("a")).join(held, "doc_id").selectExpr("a", "node AS b")
    roots = merged(together.where("a <> b").distinct(), roots, "texts")

    groups = nodes.select("node", "doc_id", "set_a", "set_b").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = groups.groupBy("root").agg(F.min("doc_id").alias("component"))
    named = groups.join(least, "root").select("set_a", "set_b", "component")
    own = F.when(F.col("n_shingles") > 0, F.col("component")).otherwise(F.col("doc_id"))
    component = F.when(F.col("doc_id").isNotNull(), own)
    return (
        sketches.join(named, ["set_a", "set_b"], "left")
        .select("doc_id", "n_shingles", component.alias("component_id"))
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    )
