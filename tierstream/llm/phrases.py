"""Phrase collocations from an FM-index per shard, over word ids.

Texts are cut into pieces and words; the words of about ``shard_bytes`` of one language's
texts are a shard. Its index holds the words in byte order, how often each occurs, and two
transforms of the sequence of word numbers: for every place, in the order of the words from
there on, the word before it; and the same of the sequence read backwards. The order looks
only as many words ahead as the longest phrase has, which is all that phrases of that length
need. A phrase is an interval in both orders, and all its extensions by a word on either side
are read off the transforms inside the interval, with their counts and their own intervals.

Phrases are counted level by level, each level summed over all shards before the next, so
that only phrases of frequent parts are extended:

1. words: counts of all shards give the lexicon, that is the words that occur ``least``
   times in their language, numbered without gaps;
2. word pairs of each shard, as two numbers in one 64-bit key, in one compact list for each
   bucket of keys; a bucket sums its lists and tells each shard which of its pairs remain;
3. triples: what the left extensions and the right extensions of the remaining pairs have in
   common, that is the triples both of whose pairs remain; summed likewise.

Sums are exact, keys are no hashes. A word or pair in a third of all texts is one entry per
shard. Scores use decimals of 38 digits, exact while counts are below 10^15.

Null text is empty, null lang is ``und`` (and joins texts that say so), doc_id is not used;
repeated rows count as often as they occur. Without words the result is empty. Other columns,
whatever their names, are ignored. Ties in score and count fall to the smaller phrase in
UTF-8 byte order.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tierstream.llm import blocks as B
from tierstream.llm.frames import parts
from tierstream.llm.superminhash import slices
from tierstream.session import working_folder

LONGEST = 3  # words of a phrase
_BREAK = np.zeros(256, bool)
_BREAK[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_GAP = _BREAK.copy()
_GAP[[0x20, 0x09]] = True
_HALF = np.uint64(32)
_LOW = np.uint64(2**32 - 1)

INDEX = (
    "shard long, lang string, words array<string>, counts array<int>, places int, before binary, after binary"
)
_LISTS = "bucket int, shard long, keys binary"


# --- the index of one shard ----------------------------------------------------


def word_sequence(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Word numbers from 1 on, 0 between pieces and at both ends; and the words, in byte order."""
    data, offsets = B.utf8(texts)
    data = B.LOWER[data]
    solid = ~_GAP[data]
    starts, ends, owner = B.runs(solid, offsets)
    # Arrays of eight bytes per word are fine, per letter they would set the task's memory.
    at = np.searchsorted(np.flatnonzero(_BREAK[data]), starts)  # how many breaks are before a word
    new = np.ones(len(starts), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (at[1:] != at[:-1])
    cuts = np.append(0, np.cumsum(ends - starts)).astype(np.int64)
    letters = data[solid]  # words hold all solid bytes, in this order
    found = pa.Array.from_buffers(
        pa.large_binary(), len(starts), [None, pa.py_buffer(cuts.tobytes()), pa.py_buffer(letters.tobytes())]
    ).dictionary_encode()
    order = pc.sort_indices(found.dictionary).to_numpy()
    number = np.empty(len(order), np.uint32)
    number[order] = np.arange(1, len(order) + 1, dtype=np.uint32)
    place = np.arange(len(starts)) + np.cumsum(new)
    sequence = np.zeros(len(starts) + int(new.sum()) + 1, np.uint32)
    sequence[place] = number[found.indices.to_numpy()] if len(starts) else 0
    return sequence, found.dictionary.take(pa.array(order)).cast(pa.large_string())


def transform(sequence: np.ndarray, depth: int) -> np.ndarray:
    """For each place, ordered by the ``depth`` words from there on, the word before it."""
    rank = sequence.astype(np.uint64)
    for ahead in range(1, depth):
        following = np.append(sequence[ahead:], np.zeros(min(ahead, len(sequence)), sequence.dtype))
        key = (rank << _HALF) | following
        order = np.argsort(key)
        if ahead < depth - 1:
            sorted_key = key[order]
            rank[order] = np.append(0, np.cumsum(sorted_key[1:] != sorted_key[:-1])).astype(np.uint64)
    return sequence[order - 1]


@dataclass(frozen=True)
class Intervals:
    """Phrases: their words' numbers (one row per word place) and their intervals."""

    words: np.ndarray
    low: np.ndarray  # in the order of the words from a place on
    back: np.ndarray  # in the order of the words read backwards
    size: np.ndarray

    def take(self, which: np.ndarray) -> Intervals:
        return Intervals(self.words[:, which], self.low[which], self.back[which], self.size[which])


class Index:
    """Both transforms of a shard."""

    def __init__(self, counts: np.ndarray, before: np.ndarray, after: np.ndarray):
        gaps = len(before) - int(counts.sum())
        self._first = np.cumsum(np.append([0, gaps], counts))  # where a word's places start, 0 for gaps
        self._before, self._after = before, after
        self._steps: dict[str, np.ndarray] = {}

    def single_words(self) -> Intervals:
        words = np.arange(1, len(self._first) - 1)
        low = self._first[1:-1]
        return Intervals(words[None, :], low, low, np.diff(self._first[1:]))

    def extended_left(self, of: Intervals) -> Intervals:
        """All phrases of one more word in front."""
        word, source, low, smaller, size = self._extended(self._before, of.low, of.size, "before")
        return Intervals(np.vstack([word[None, :], of.words[:, source]]), low, of.back[source] + smaller, size)

    def extended_right(self, of: Intervals) -> Intervals:
        """All phrases of one more word behind."""
        word, source, back, smaller, size = self._extended(self._after, of.back, of.size, "after")
        return Intervals(np.vstack([of.words[:, source], word[None, :]]), of.low[source] + smaller, back, size)

    def _extended(self, column: np.ndarray, low: np.ndarray, size: np.ndarray, name: str):
        """Word, number of the phrase, new interval, places of the phrase with smaller words
        at that side, and count of each extension."""
        if name not in self._steps:  # where a place's word stands in the other order
            step = np.empty(len(column), np.int64)
            step[np.argsort((column.astype(np.uint64) << _HALF) | np.arange(len(column), dtype=np.uint64))] = np.arange(len(column))
            self._steps[name] = step
        places = B.expand(low, size)
        phrase = np.repeat(np.arange(len(low), dtype=np.uint64), size)
        order = np.argsort(key := (phrase << _HALF) | column[places])
        starts, count = B.groups(key[order])
        if not len(starts):
            return (np.zeros(0, np.int64),) * 5
        word = (key[order][starts] & _LOW).astype(np.int64)
        source = (key[order][starts] >> _HALF).astype(np.int64)
        new = np.minimum.reduceat(self._steps[name][places][order], starts)
        smaller = starts - (np.cumsum(size) - size)[source]
        keep = word > 0
        return word[keep], source[keep], new[keep], smaller[keep], count[keep]


def _squeezed(values: np.ndarray) -> bytes:
    """Byte by byte, all first bytes and so on, which compresses better."""
    return pa.compress(values.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes(), "zstd", asbytes=True)


def _unsqueezed(blob: bytes, n: int) -> np.ndarray:
    raw = np.frombuffer(pa.decompress(blob, 4 * n, "zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(raw.reshape(4, n).T).view("<u4").reshape(n)


def _opened(row: pa.Table) -> Index:
    counts = np.asarray(row["counts"][0].values)
    n = row["places"][0].as_py()
    return Index(counts, _unsqueezed(row["before"][0].as_py(), n), _unsqueezed(row["after"][0].as_py(), n))


def _index(shard_bytes: int):
    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        waiting: dict[str, list[pa.Array]] = {}
        size: dict[str, int] = {}

        def built(lang: str) -> pa.RecordBatch:
            nonlocal number
            sequence, words = word_sequence(pa.concat_arrays(waiting.pop(lang)))
            pa.default_memory_pool().release_unused()  # the worker lives on, beside the others
            del size[lang]
            number += 1
            counts = np.bincount(sequence, minlength=len(words) + 1)[1:]
            cuts = pa.array([0, len(words)], pa.int32())
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([number], pa.int64()), pa.array([lang]),
                    pa.ListArray.from_arrays(cuts, words.cast(pa.string())),
                    pa.ListArray.from_arrays(cuts, pa.array(counts, pa.int32())),
                    pa.array([len(sequence)], pa.int32()),
                    pa.array([_squeezed(transform(sequence, LONGEST))], pa.binary()),
                    pa.array([_squeezed(transform(sequence[::-1], LONGEST))], pa.binary()),
                ],
                names=[x.split()[0] for x in INDEX.split(", ")],
            )

        for batch in batches:
            langs = batch.column("lang").dictionary_encode()
            for code, lang in enumerate(langs.dictionary.to_pylist()):
                texts = batch.column("text").filter(pc.equal(langs.indices, code)).cast(pa.large_string())
                for low, high in slices(texts):
                    part = texts.slice(low, high - low)
                    more = len(B.utf8(part)[0])
                    if size.get(lang, 0) and size[lang] + more > shard_bytes:
                        yield built(lang)
                    # A copy, or the slice would hold on to its whole batch.
                    waiting.setdefault(lang, []).append(pa.concat_arrays([part.take(pa.array(range(len(part))))]))
                    size[lang] = size.get(lang, 0) + more
        for lang in sorted(waiting):
            yield built(lang)

    return index


# --- summing a level over all shards ------------------------------------------------


def _sent(shard: int, route: np.ndarray, keys: np.ndarray, columns: list[np.ndarray], buckets: int) -> pa.Table:
    """One list for each bucket; rising keys, equal ones in the order of the columns."""
    bucket = ((route >> _HALF) * np.uint64(buckets) >> _HALF).astype(np.int64)
    order = np.lexsort((*reversed(columns), keys, bucket))
    bucket, keys = bucket[order], keys[order]
    columns = [c[order] for c in columns]
    starts, sizes = B.groups(bucket)
    blobs = [B.dump(keys[a : a + n], *(c[a : a + n] for c in columns)) for a, n in zip(starts, sizes, strict=True)]
    return pa.table([
        pa.array(bucket[starts], pa.int32()), pa.array(np.full(len(starts), shard), pa.int64()), pa.array(blobs, pa.binary()),
    ], names=["bucket", "shard", "keys"])


_NOTHING_SENT = pa.table({
    "bucket": pa.array([], pa.int32()), "shard": pa.array([], pa.int64()), "keys": pa.array([], pa.binary()),
})


def _numbers(row: pa.Table, told: pa.Table) -> np.ndarray:
    """The lexicon's number of each word of a shard, 0 for words that are not in it."""
    out = np.zeros(len(row["words"][0]), np.uint64)
    is_word = told.filter(pc.is_valid(told["place"]))
    out[is_word["place"].to_numpy()] = is_word["number"].to_numpy().astype(np.uint64)
    return out


def _pairs_of(row: pa.Table, told: pa.Table) -> tuple[Index, Intervals, np.ndarray, np.ndarray]:
    index, numbers = _opened(row), np.append(np.uint64(0), _numbers(row, told))
    known = index.single_words()
    known = known.take(numbers[known.words[0]] > 0)
    pairs = index.extended_left(known)
    pairs = pairs.take(numbers[pairs.words[0]] > 0)
    return index, pairs, (numbers[pairs.words[0]] << _HALF) | numbers[pairs.words[1]], numbers


def _count_pairs(buckets: int):
    def count(row: pa.Table, told: pa.Table) -> pa.Table:
        if not row.num_rows or not told.num_rows:
            return _NOTHING_SENT
        _, pairs, keys, _ = _pairs_of(row, told)
        return _sent(row["shard"][0].as_py(), B.mix(keys), keys, [pairs.size.astype(np.uint64)], buckets)

    return count


def _sum_pairs(least: int):
    def total(table: pa.Table) -> pa.Table:
        lists = [B.load(x) for x in table["keys"].to_pylist()]
        keys, counts = (np.concatenate(c) for c in zip(*lists, strict=True))
        order = np.argsort(keys, kind="stable")
        starts, _ = B.groups(keys[order])
        sums = np.add.reduceat(counts[order].astype(np.int64), starts) if len(starts) else counts.astype(np.int64)
        names = keys[order][starts]
        names, sums = names[sums >= least], sums[sums >= least]
        remain = [own[0][B.member(own[0], names)] for own in lists]
        told = [(s, B.dump(x)) for s, x in zip(table["shard"].to_pylist(), remain, strict=True) if len(x)]
        n, m = len(told), len(names)
        return pa.table({
            "shard": pa.array([s for s, _ in told] + [None] * m, pa.int64()),
            "keys": pa.array([x for _, x in told] + [None] * m, pa.binary()),
            "first": pa.concat_arrays([pa.nulls(n, pa.int64()), pa.array((names >> _HALF).astype(np.int64))]),
            "second": pa.concat_arrays([pa.nulls(n, pa.int64()), pa.array((names & _LOW).astype(np.int64))]),
            "a": pa.concat_arrays([pa.nulls(n, pa.int64()), pa.array(sums)]),
        })

    return total


def _count_triples(buckets: int):
    def count(row: pa.Table, told: pa.Table) -> pa.Table:
        if not row.num_rows or not told.num_rows:
            return _NOTHING_SENT
        lists = told["keys"].drop_null().to_pylist()
        if not lists:
            return _NOTHING_SENT
        index, pairs, keys, numbers = _pairs_of(row, told)
        remain = np.sort(np.concatenate([B.load(x)[0] for x in lists]))
        pairs = pairs.take(B.member(keys, remain))
        left, right = index.extended_left(pairs), index.extended_right(pairs)
        both = left.take(np.isin(left.low, right.low))
        first, second, third = (numbers[w] for w in both.words)
        keys = (first << _HALF) | second
        return _sent(row["shard"][0].as_py(), B.mix(keys ^ B.mix(third)), keys, [third, both.size.astype(np.uint64)], buckets)

    return count


def _sum_triples(least: int):
    def total(table: pa.Table) -> pa.Table:
        keys, third, counts = (np.concatenate(c) for c in zip(*(B.load(x) for x in table["keys"].to_pylist()), strict=True))
        order = np.lexsort((third, keys))
        keys, third, counts = keys[order], third[order], counts[order].astype(np.int64)
        new = np.ones(len(keys), bool)
        new[1:] = (keys[1:] != keys[:-1]) | (third[1:] != third[:-1])
        starts = np.flatnonzero(new)
        sums = np.add.reduceat(counts, starts) if len(starts) else counts
        keep = sums >= least
        keys, third = keys[starts][keep], third[starts][keep]
        return pa.table([
            pa.array(x.astype(np.int64)) for x in (keys >> _HALF, keys & _LOW, third, sums[keep])
        ], names=["first", "second", "third", "a"])

    return total


# --- the whole --------------------------------------------------------------------


def _lexicon(index: DataFrame, least: int, folder: str) -> DataFrame:
    """lang, word, n, number (from 1 on, without gaps over all languages)."""
    spark = index.sparkSession
    words = index.select("lang", F.explode(F.arrays_zip("words", "counts")).alias("w"))
    frequent = words.groupBy("lang", F.col("w.words").alias("word")).agg(F.sum("w.counts").alias("n")).where(F.col("n") >= least)
    # Written before it is numbered: a number must not change when a task runs again.
    place = F.monotonically_increasing_id()
    frequent.select(
        "lang", "word", "n", F.shiftright(place, 33).alias("part"), place.bitwiseAND(F.lit(2**33 - 1)).alias("place")
    ).write.parquet(folder)
    found = spark.read.parquet(folder)
    sizes = found.groupBy("part").agg(F.count("*").alias("size"))  # a row for each task of the writing
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("part", F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("start"))
    if (found.agg(F.count("*")).first()[0]) >= 2**32:
        raise ValueError("more than 2^32 frequent words")
    return found.join(starts, "part").select("lang", "word", "n", (F.col("start") + F.col("place") + 1).alias("number"))


def _score(a: str, left: str, right: str) -> str:
    """floor(1000000 * a * a / (left * right)), exact; at most a million, as a <= left, right."""
    wide = "CAST({} AS DECIMAL(15, 0))"
    square = f"{wide.format(a)} * {wide.format(a)} * CAST(1000000 AS DECIMAL(7, 0))"
    return f"({square}) DIV ({wide.format(left)} * {wide.format(right)})"


def collocations(
    docs: DataFrame, least: int = 10, contained_percent: int = 50, limit: int = 2000, shard_bytes: int = 8_000_000
) -> DataFrame:
    """lang, rank, phrase, a (its count), l and r (counts of the two parts of its weakest
    cut), n (words of the language) and score: each language's first ``limit`` phrases.

    A pair goes if ``contained_percent`` of its occurrences are within one longer phrase.
    Index, lexicon and the sums of each level are written under ``spark.checkpoint.dir``.
    """
    spark = docs.sparkSession
    folder, buckets = working_folder(spark, "phrases"), parts(spark)

    def written(frame: DataFrame, name: str) -> DataFrame:
        frame.write.parquet(f"{folder}/{name}")
        return spark.read.parquet(f"{folder}/{name}")

    index = written(
        docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.col("text").cast("string").alias("text"))
        .mapInArrow(_index(shard_bytes), INDEX),
        "index",
    )
    lexicon = written(_lexicon(index, least, f"{folder}/frequent"), "lexicon")
    places = index.select("shard", "lang", F.posexplode("words").alias("place", "word"))
    told = written(places.join(lexicon, ["lang", "word"]).select("shard", "place", "number"), "places")

    rows = index.drop("lang").groupBy("shard")
    lists = rows.cogroup(told.groupBy("shard")).applyInArrow(_count_pairs(buckets), _LISTS)
    pairs = written(
        lists.groupBy("bucket").applyInArrow(
            _sum_pairs(least), "shard long, keys binary, first long, second long, a long"
        ),
        "pairs",
    )
    answers = told.select("shard", "place", "number", F.lit(None).cast("binary").alias("keys")).unionByName(
        pairs.where("shard IS NOT NULL").select(
            "shard", F.lit(None).cast("int").alias("place"), F.lit(None).cast("long").alias("number"), "keys"
        )
    )
    lists = rows.cogroup(answers.groupBy("shard")).applyInArrow(_count_triples(buckets), _LISTS)
    triples = written(
        lists.groupBy("bucket").applyInArrow(_sum_triples(least), "first long, second long, third long, a long"), "triples"
    )
    found = _with_parts(pairs.where("shard IS NULL").select("first", "second", "a"), triples, lexicon, contained_percent)
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= limit)
    totals = index.groupBy("lang").agg(F.sum(F.aggregate("counts", F.lit(0).cast("long"), lambda x, y: x + y)).alias("n"))
    return ranked.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )


def _with_parts(pairs: DataFrame, triples: DataFrame, lexicon: DataFrame, contained_percent: int) -> DataFrame:
    """Pairs and triples with the words, the counts of their parts and the score."""

    def word(place: str) -> DataFrame:
        return lexicon.select(
            F.col("number").alias(place), F.col("word").alias(f"{place}_word"), F.col("n").alias(f"{place}_n"),
            F.col("lang").alias(f"{place}_lang"),
        )

    within = (
        triples.select("a", F.explode(F.array(
            F.struct("first", "second"), F.struct(F.col("second").alias("first"), F.col("third").alias("second"))
        )).alias("pair"))
        .groupBy("pair.first", "pair.second").agg(F.max("a").alias("longer"))
    )
    stay = pairs.join(within, ["first", "second"], "left").where(
        f"longer IS NULL OR 100 * longer < {contained_percent} * a"
    )
    two = stay.join(word("first"), "first").join(word("second"), "second").selectExpr(
        "first_lang AS lang", "concat_ws(' ', first_word, second_word) AS phrase", "a",
        "first_n AS l", "second_n AS r", f"{_score('a', 'first_n', 'second_n')} AS score",
    )
    head = pairs.select("first", "second", F.col("a").alias("head"))
    rest = pairs.select(F.col("first").alias("second"), F.col("second").alias("third"), F.col("a").alias("rest"))
    three = (
        triples.join(head, ["first", "second"]).join(rest, ["second", "third"])
        .join(word("first"), "first").join(word("second"), "second").join(word("third"), "third")
        .selectExpr(
            "first_lang AS lang", "concat_ws(' ', first_word, second_word, third_word) AS phrase", "a",
            "first_n", "rest", "head", "third_n",
            f"{_score('a', 'first_n', 'rest')} AS cut1", f"{_score('a', 'head', 'third_n')} AS cut2",
        )
        .selectExpr(
            "lang", "phrase", "a", "if(cut1 <= cut2, first_n, head) AS l", "if(cut1 <= cut2, rest, third_n) AS r",
            "least(cut1, cut2) AS score",
        )
    )
    return two.unionByName(three)
