"""Best-fit packing planned on the histogram of lengths.

Documents become token ids with an end id; only longer ones than a sequence are cut, into
full pieces, of which the first may be shorter. The plan looks at how many pieces there are
of each length, never at single pieces: lengths go from long to short, and each takes the
open sequences whose free space it fits best. Sequences with the same content form a range
of numbers, so a step of the plan fills a whole range at once. The plan then says, for every
range of ranks among the pieces of a length, the range of sequences and the offset; a piece
finds its slot by its rank. The plan's size depends on ``capacity`` alone.

Ranks are counted in two steps, within a part of a length and then by the parts' sizes, so
that a length a third of all pieces have is not ranked in one task.

Null or empty text: just the end id. Null doc_id: packed like any other. Repeated rows are
packed once each. Other columns are ignored.
"""

from __future__ import annotations

import bisect
import functools
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tierstream.llm.chunks import ChunkEncoder, id_bytes
from tierstream.llm.frames import parts
from tierstream.llm.superminhash import slices
from tierstream.session import working_folder

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def best_fit_plan(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """(length, first rank, number, first sequence, offset) of each range of pieces."""
    rows = []
    open_by_room: dict[int, list[tuple[int, int]]] = {}
    rooms: list[int] = []  # the free spaces that open sequences have, rising
    sequences = 0

    def put(room: int, first: int, n: int) -> None:
        if n and room:
            if room not in open_by_room:
                open_by_room[room] = []
                bisect.insort(rooms, room)
            open_by_room[room].append((first, n))

    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        while left:
            at = bisect.bisect_left(rooms, length)
            if at < len(rooms):
                room = rooms[at]
                first, n = open_by_room[room].pop()
                if not open_by_room[room]:
                    del open_by_room[room], rooms[at]
            else:
                room, first = capacity, sequences
                n = -(-left // (capacity // length))
                sequences += n
            each = min(room // length, left)  # a sequence is filled up before the next is begun
            used = min(n, left // each)
            for k in range(each):
                rows.append((length, rank, used, first, capacity - room + k * length))
                rank += used
            left -= used * each
            put(room - each * length, first, used)
            put(room, first + used, n - used)
    return rows


@functools.lru_cache(maxsize=1)  # what it has learned serves all tasks of a worker
def _encoder(tokenizer: str) -> ChunkEncoder:
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(tokenizer)
    return ChunkEncoder(
        lambda t: [e.ids for e in model.encode_batch_fast(t, add_special_tokens=False)], id_bytes=id_bytes(model)
    )


def _pieces(tokenizer: str, capacity: int, end: int, with_ids: bool):
    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer)
        for batch in batches:
            doc_ids = batch.column("doc_id").to_pylist()
            for low, high in slices(batch.column("text")):
                ids, cuts = encoder(batch.column("text").slice(low, high - low))
                rows = {"doc_id": [], "piece": [], "start": [], "length": [], "ids_crc32": []}
                lists = []
                for doc, a, b in zip(doc_ids[low:high], cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                    own = np.append(ids[a:b], np.uint32(end)).astype("<u4")
                    start, stop = 0, (len(own) - 1) % capacity + 1
                    piece = 0
                    while start < len(own):
                        part = own[start:stop]
                        for name, value in zip(rows, (doc, piece, start, stop - start, zlib.crc32(part)), strict=True):
                            rows[name].append(value)
                        if with_ids:
                            lists.append(part.astype(np.int32))
                        start, stop, piece = stop, stop + capacity, piece + 1
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
                arrays = [pa.array(v, k) for v, k in zip(rows.values(), kinds, strict=True)]
                if with_ids:
                    arrays.append(pa.array(lists, pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(arrays, names=[*rows, *["ids"] * with_ids])

    return pieces


def packed(
    docs: DataFrame, tokenizer: str, capacity: int = 2048, end: int = 0, with_ids: bool = False
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset, and
    ``ids`` if asked for.

    ``tokenizer`` is a file of the tokenizers library that every executor can open.
    """
    spark = docs.sparkSession
    folder = working_folder(spark, "packing")
    docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        _pieces(tokenizer, capacity, end, with_ids), PIECES + (", ids array<int>" if with_ids else "")
    ).write.parquet(folder)
    pieces = spark.read.parquet(folder)
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    slots = np.array(best_fit_plan(counts, capacity), np.int64).reshape(-1, 5)
    names = ["length", "first", "n", "sequence", "offset"]
    plan = spark.createDataFrame(pa.table(list(slots.T), names))  # from Arrow: without further Python workers
    placed = pieces.withColumn("part", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(4 * parts(spark))))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("length", "part").agg(F.count("*").alias("size"))
        .select("length", "part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("before"))
    )
    within = Window.partitionBy("length", "part").orderBy("doc_id", "piece")
    ranked = placed.withColumn("within", F.row_number().over(within) - 1).join(offsets, ["length", "part"])
    ranked = ranked.withColumn("rank", F.col("before") + F.col("within"))
    slot = (F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("first") + F.col("n"))
    found = ranked.join(F.broadcast(plan.withColumnRenamed("length", "planned")), (F.col("length") == F.col("planned")) & slot)
    return found.select(
        "doc_id", "piece", "start", "length", "ids_crc32",
        (F.col("sequence") + F.col("rank") - F.col("first")).alias("sequence_id"), "offset",
        *["ids"] * with_ids,
    )
