"""Contiguous shards of the least possible largest size, in DataFrame operations only.

Documents with equal texts are one atom; atoms are ordered by their smallest doc_id. The
capacity of a shard is found by binary search: a capacity is feasible if filling shards
greedily, in order, needs no more than there are. Where a single atom alone sets the
capacity it fills a shard, and the atoms on either side are cut by themselves, each side with
the shards it needs at least and the others by its size. While a shard is empty, the largest
one of several atoms is cut in two. So no shard is above the least possible largest size, and
one large group of copies leaves no other shard empty.

The search runs on sums over ranges of the order, some ten thousand at a time. Taking a
range of several atoms as divisible gives a lower bound for the capacity, taking it as one
piece an upper bound. Ranges in which a cut can still fall are cut by further bits of the
order number until the two meet, so the result is that of a search over all atoms. Each round is one aggregation over
(order, bytes) rows, and their number grows with the logarithm of the data.

Null text counts as empty. Texts found only under a null doc_id sort before all others, by a
hash of the text (below ids under -2^62, among them). Rows with the same doc_id
are placed one by one; they share a shard if their texts are equal. An empty table gives
an empty result. Other columns are ignored.
"""

from __future__ import annotations

import bisect
from dataclasses import dataclass
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierstream.llm.frames import parts
from tierstream.session import working_folder

_RANGES = 1 << 15  # summed in one round, at most
_LOWEST = -(2**63)


@dataclass(frozen=True)
class _Range:
    """The atoms whose order numbers are equal but for the last ``shift`` bits."""

    shift: int
    block: int
    low: int  # smallest and largest order number of its atoms
    high: int
    size: int
    largest: int  # its largest atom

    @property
    def single(self) -> bool:
        return self.low == self.high


def _block(shift: int) -> Column:
    """The order number without its last bits; with the sign bit turned, order is unsigned."""
    return F.shiftrightunsigned(F.col("first").bitwiseXOR(F.lit(_LOWEST)), shift)


def _sums(rows: DataFrame, shift: Column | int, block: Column) -> list[_Range]:
    found = (
        rows.select("first", "bytes", F.lit(shift).alias("shift"), block.alias("block")).where("block IS NOT NULL")
        .groupBy("shift", "block").agg(
            F.min("first").alias("low"), F.max("first").alias("high"),
            F.sum("bytes").alias("size"), F.max("bytes").alias("largest"),
        )
        .collect()  # at most _RANGES rows and as many again
    )
    return [_Range(**r.asDict()) for r in found]


def _finer(atoms: DataFrame, ranges: list[_Range], chosen: set[int]) -> list[_Range]:
    """The ranges in order, the chosen ones cut into as many parts as a round can sum."""
    bits = max(1, min(11, (_RANGES // len(chosen)).bit_length() - 1))
    shift, block = F.lit(None).cast("int"), F.lit(None).cast("long")
    for old in {ranges[i].shift for i in chosen}:  # at most 64 / bits
        within = _block(old).isin([ranges[i].block for i in chosen if ranges[i].shift == old])
        new = max(0, old - bits)
        shift, block = F.when(within, F.lit(new)).otherwise(shift), F.when(within, _block(new)).otherwise(block)
    kept = [r for i, r in enumerate(ranges) if i not in chosen]
    return sorted([*kept, *_sums(atoms, shift, block)], key=lambda r: r.low)


def _reach(ends: list[int], solid: list[bool], capacity: int, shards: int) -> list[int]:
    """Bytes before each cut of a greedy filling; no cut falls inside a solid range."""
    cuts, at = [], 0
    for _ in range(shards):
        at = min(at + capacity, ends[-1])
        k = bisect.bisect_right(ends, at)
        if k < len(ends) and solid[k]:
            at = max(ends[k - 1] if k else 0, cuts[-1] if cuts else 0)
        cuts.append(at)
    return cuts


def _least(ends: list[int], solid: list[bool], shards: int, low: int) -> int:
    """The smallest capacity, ``low`` at least, with which ``shards`` shards hold everything."""
    high = ends[-1]
    while low < high:
        middle = (low + high) // 2
        if _reach(ends, solid, middle, shards)[-1] >= ends[-1]:
            high = middle
        else:
            low = middle + 1
    return low


def _pieces(atoms: DataFrame, ranges: list[_Range], shards: int) -> list[list[_Range]]:
    """The ranges in order, as the contents of at most ``shards`` shards; cut finer where a shard ends."""
    if shards == 1:
        return [ranges]
    while True:
        ends = list(accumulate(r.size for r in ranges))
        total, largest = ends[-1], max(r.largest for r in ranges)
        # Single atoms are solid for both bounds, so they meet once no open range is left.
        solid, loose = [True] * len(ranges), [r.single for r in ranges]
        below = _least(ends, loose, shards, max(largest, -(-total // shards)))
        above = _least(ends, solid, shards, below)
        if above == below:
            break
        early, late = _reach(ends, solid, below, shards), _reach(ends, loose, above, shards)
        spans = [sorted(ab) for ab in zip(early, late, strict=True)]
        near = {
            k for a, b in spans
            for k in range(bisect.bisect_left(ends, a), min(bisect.bisect_right(ends, b) + 1, len(ranges)))
            if not ranges[k].single
        }
        ranges = _finer(atoms, ranges, near or {k for k, r in enumerate(ranges) if not r.single})
    # A range with an atom as large as the capacity is that atom alone, or it would not fit.
    at = next((i for i, r in enumerate(ranges) if r.largest == above), None)
    if at is not None and above * shards > total and len(ranges) > 1:
        pieces = _around(atoms, ranges, at, above, shards)
    else:
        starts = [bisect.bisect_right(ends, b) for b in [0, *_reach(ends, solid, above, shards)] if b < total]
        starts = [*dict.fromkeys(starts), len(ranges)]
        pieces = [ranges[a:b] for a, b in zip(starts, starts[1:], strict=False)]
    while len(pieces) < shards:
        several = [i for i, p in enumerate(pieces) if len(p) > 1 or not p[0].single]
        if not several:
            break
        i = max(several, key=lambda i: sum(r.size for r in pieces[i]))
        pieces[i : i + 1] = _pieces(atoms, pieces[i], 2)
    return pieces


def _needed(ranges: list[_Range], capacity: int) -> int:
    """How many shards a greedy filling with whole ranges takes."""
    if not ranges:
        return 0
    ends = list(accumulate(r.size for r in ranges))
    return 1 + sum(b < ends[-1] for b in _reach(ends, [True] * len(ends), capacity, len(ends)))


def _around(atoms: DataFrame, ranges: list[_Range], at: int, capacity: int, shards: int) -> list[list[_Range]]:
    """An atom that fills a shard; the sides share the other shards by size, as far as they fit."""
    sides, rest = (ranges[:at], ranges[at + 1 :]), shards - 1
    left, right = (sum(r.size for r in side) for side in sides)
    if left and right:
        possible = range(_needed(sides[0], capacity), rest - _needed(sides[1], capacity) + 1)
        for_left = min(possible, key=lambda n: (max(left / n, right / (rest - n)), n))
    else:
        for_left = rest if left else 0
    return [
        *(_pieces(atoms, sides[0], for_left) if left else []), [ranges[at]],
        *(_pieces(atoms, sides[1], rest - for_left) if right else []),
    ]


def sharded(docs: DataFrame, shards: int = 16) -> DataFrame:
    """doc_id, size (UTF-8 bytes and 1), text_crc32, shard and slot (gapless within a shard)."""
    spark = docs.sparkSession
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.unhex(F.sha2(text, 256)).alias("digest"),
    )
    groups = rows.groupBy("digest").agg(
        F.min("doc_id").alias("first"), F.sum("size").alias("bytes")
    )
    hashed = F.lit(_LOWEST) + F.xxhash64("digest").bitwiseAND(F.lit((1 << 62) - 1))
    groups = groups.withColumn("first", F.coalesce("first", hashed))
    folder = working_folder(spark, "sharding")
    groups.write.parquet(f"{folder}/groups")
    groups = spark.read.parquet(f"{folder}/groups")
    # Groups whose smallest doc_id is the same cannot be told apart in the order.
    groups.groupBy("first").agg(F.sum("bytes").alias("bytes")).write.parquet(f"{folder}/atoms")
    atoms = spark.read.parquet(f"{folder}/atoms")
    ends = atoms.agg(F.min("first"), F.max("first")).first()
    cuts = []
    if ends[0] is not None:
        shift = max(0, (ends[1] - ends[0]).bit_length() - 11)
        ranges = sorted(_sums(atoms, shift, _block(shift)), key=lambda r: r.low)
        cuts = [piece[0].low for piece in _pieces(atoms, ranges, shards)[1:]]
    shard = sum((F.when(F.col("first") >= c, 1).otherwise(0) for c in cuts), F.lit(0))
    part = F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(4 * parts(spark)))
    placed = (
        rows.join(groups.select("digest", "first"), "digest")
        .select("doc_id", "size", "text_crc32", shard.cast("int").alias("shard"), part.alias("part"))
    )
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("shard", "part").agg(F.count("*").alias("n"))  # at most shards x parts rows
        .select("shard", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    )
    within = Window.partitionBy("shard", "part").orderBy("doc_id", "text_crc32")
    return (
        placed.withColumn("within", F.row_number().over(within) - 1).join(offsets, ["shard", "part"])
        .select("doc_id", "size", "text_crc32", "shard", (F.col("before") + F.col("within")).alias("slot"))
    )
