"""Line dedup: cuckoo filters per shard, backed by exact reference counts.

A line's key is the line without white space at both ends, A-Z lower-cased. Keys of at
least ``min_chars`` code points that occur in ``min_docs`` documents or more lose their
lines everywhere but in the largest doc_id that holds them.

Each segment of documents refers to keys; a shard is a range of key hashes and has every
segment's references to them: key, number of the segment's documents, largest doc_id. The
shard's cuckoo filter tells which keys are new, so that only keys met before are counted
exactly. Keys are 96-bit hashes.

``clean_lines`` does all of it in one pass over a table. ``LineStore`` keeps references
and filters in a folder: documents can be added and taken out again later, and the result
is the same as if only those that remain had ever been there.

Null or empty text: one empty line. Null doc_id sorts before all others; rows with the
same doc_id are one document. Other columns are ignored, or carried along if named.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierstream.llm import blocks as B
from tierstream.llm.cuckoo import CuckooFilter
from tierstream.llm.frames import KEY_LISTS, lists, parts, received, rest_type, segmented
from tierstream.sources.files import children, exists, read_text, write_text

_NEWLINE = 0x0A
_SIGN = np.uint64(1 << 63)  # turns the order of signed ids into that of unsigned ones


class _Lines:
    """The lines of a segment's documents, and the keys of those long enough to count."""

    def __init__(self, table: pa.Table, min_chars: int):
        self.doc_ids = B.ids(table["doc_id"])
        self.data, self.offsets = data, offsets = B.utf8(table["text"])
        breaks = np.flatnonzero(data == _NEWLINE)
        self.per_doc = 1 + np.diff(np.searchsorted(breaks, offsets))
        total = int(self.per_doc.sum())
        heads = np.cumsum(self.per_doc) - self.per_doc
        self.owner = np.repeat(np.arange(len(self.doc_ids)), self.per_doc)
        first, last = np.zeros(total, bool), np.zeros(total, bool)
        first[heads] = last[heads + self.per_doc - 1] = True
        self.starts, self.ends = np.empty(total, np.int64), np.empty(total, np.int64)
        self.starts[first], self.starts[~first] = offsets[:-1], breaks + 1
        self.ends[last], self.ends[~last] = offsets[1:], breaks

        solid = np.flatnonzero(~B.SPACE[data])
        low, high = np.searchsorted(solid, self.starts), np.searchsorted(solid, self.ends)
        filled = np.flatnonzero(low < high)
        a, b = solid[low[filled]], solid[high[filled] - 1] + 1
        chars = np.append(0, np.cumsum((data & 0xC0) != 0x80))
        long = chars[b] - chars[a] >= min_chars
        self.lines, a, b = filled[long], a[long], b[long]
        lower = B.LOWER[data]
        self.keys = B.hash_spans(lower, a, b, 21)
        self.check = B.hash_spans(lower, a, b, 22) >> np.uint64(32)


def clean_lines(docs: DataFrame, min_chars: int = 20, min_docs: int = 3, carry: Sequence[str] = ()) -> DataFrame:
    """doc_id, n_lines, n_dropped, ``kept`` (the other lines joined by a line feed), and
    ``rest`` with the carried columns."""
    buckets = parts(docs.sparkSession)
    dealt = segmented(docs, carry)
    texts = dealt.select("doc_id", "text", "segment") if carry else dealt
    verdicts = (
        texts.groupBy("segment").applyInArrow(_references(min_chars, buckets), KEY_LISTS)
        .groupBy("bucket").applyInArrow(_judge(min_docs), KEY_LISTS)
    )
    return _apply(docs, dealt, verdicts, min_chars, carry)


def _apply(docs, dealt, verdicts, min_chars, carry):
    schema = "doc_id long, n_lines long, n_dropped long, kept string" + rest_type(docs, carry)
    return dealt.groupBy("segment").cogroup(verdicts.groupBy("segment")).applyInArrow(
        _drop(min_chars, bool(carry)), schema
    )


def _references(min_chars: int, buckets: int, by_document: bool = False):
    """Key lists of a segment: key, check, then documents and the largest, or each document."""

    def references(table: pa.Table) -> pa.Table:
        if not table.num_rows:
            return lists([])
        found = _Lines(table, min_chars)
        holder = found.doc_ids[found.owner[found.lines]].view(np.uint64) ^ _SIGN
        order = np.lexsort((holder, found.check, found.keys))
        triples = [x[order] for x in (found.keys, found.check, holder)]
        new = np.ones(len(order), bool)
        new[1:] = np.any([x[1:] != x[:-1] for x in triples], axis=0)
        triples = [x[new] for x in triples]
        columns = triples if by_document else _counted(*triples)
        segment = table["segment"][0].as_py()
        return lists([
            (b, segment, 0, B.dump(*(c[s] for c in columns))) for b, s in B.dealt(columns[0], buckets)
        ])

    return references


def _counted(keys: np.ndarray, check: np.ndarray, holder: np.ndarray) -> list[np.ndarray]:
    """One row per key of sorted (key, check, document): key, check, documents, largest."""
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]) | (check[1:] != check[:-1])
    starts = np.flatnonzero(new)
    sizes = np.diff(np.append(starts, len(keys)))
    return [keys[starts], check[starts], sizes.astype(np.uint64), holder[starts + sizes - 1] if len(starts) else holder]


def _judge(min_docs: int):
    """To each segment, its keys that lose their lines, with the document that keeps its own."""

    def judge(table: pa.Table) -> pa.Table:
        found = [B.load(x) for x in table["keys"].to_pylist()]
        seen = CuckooFilter.of(np.zeros(0, np.uint64), sum(len(x[0]) for x in found))
        again = []
        for keys, _, n, _ in found:
            keys, at = np.unique(keys, return_index=True)
            known = seen.contains(keys)
            if not seen.insert(keys[~known]):
                raise RuntimeError("the filter is sized for all references of its shard")
            again += [keys[known], keys[n[at] > 1]]
        again = np.unique(np.concatenate(again)) if again else np.zeros(0, np.uint64)

        # Exact counts of the keys that the filter, or a segment by itself, met again.
        owner = np.repeat(np.arange(len(found)), [len(x[0]) for x in found])
        keys, check, n, last = (np.concatenate(x) for x in zip(*found, strict=True)) if found else (owner,) * 4
        pick = np.flatnonzero(B.member(keys, again)) if len(again) else np.zeros(0, np.int64)
        order = pick[np.lexsort((owner[pick], check[pick], keys[pick]))]
        keys, check, n, last, owner = (x[order] for x in (keys, check, n, last, owner))
        new = np.ones(len(keys), bool)
        new[1:] = (keys[1:] != keys[:-1]) | (check[1:] != check[:-1])
        starts = np.flatnonzero(new)
        if not len(starts):
            return lists([])
        sizes = np.diff(np.append(starts, len(keys)))
        drop = np.repeat(np.add.reduceat(n, starts) >= min_docs, sizes)
        keeper = np.repeat(np.maximum.reduceat(last, starts), sizes)
        rows = []
        segments, buckets = table["segment"].to_pylist(), table["bucket"].to_pylist()
        for i in np.unique(owner[drop]).tolist():
            own = drop & (owner == i)
            rows.append((buckets[i], segments[i], 0, B.dump(keys[own], check[own], keeper[own])))
        return lists(rows)

    return judge


def _drop(min_chars: int, carries: bool):
    def drop(table: pa.Table, verdicts: pa.Table) -> pa.Table:
        found = _Lines(table, min_chars)
        gone = np.zeros(len(found.owner), bool)
        keys, check, keeper = received(verdicts, 3)
        if len(keys):
            at = np.minimum(np.searchsorted(keys, found.keys), len(keys) - 1)
            hit = (keys[at] == found.keys) & (check[at] == found.check)
            holder = found.doc_ids[found.owner[found.lines]].view(np.uint64) ^ _SIGN
            gone[found.lines[hit & (keeper[at] != holder)]] = True
        docs = len(found.doc_ids)
        columns = {
            "doc_id": B.plain(table["doc_id"]),
            "n_lines": pa.array(found.per_doc, pa.int64()),
            "n_dropped": pa.array(np.bincount(found.owner[gone], minlength=docs), pa.int64()),
            "kept": B.joined(found.data, found.offsets, found.starts, found.ends, found.owner, ~gone),
        }
        if carries:
            columns["rest"] = B.plain(table["rest"])
        return pa.table(columns)

    return drop


class LineStore:
    """References and filters of a growing and shrinking set of documents, in a folder.

    ``references/<n>``: per segment and shard, (key, document) pairs; ``filters/<n>``: one
    cuckoo filter per shard. Each change writes a new version <n> beside the old one, the
    filters last; ``version`` is the newest one whose filters were finished, also for a store
    opened again, and what an interrupted change left behind is written over. The folder must be
    one that all executors share, with one writer at a time.
    """

    def __init__(self, spark: SparkSession, folder: str, segments: int, buckets: int, min_chars: int = 20):
        self.spark, self.folder = spark, folder
        self.segments, self.buckets, self.min_chars = segments, buckets, min_chars
        finished = [
            int(n) for n in children(spark, f"{folder}/filters") if exists(spark, f"{folder}/filters/{n}/_SUCCESS")
        ]
        shape = {"segments": segments, "buckets": buckets, "min_chars": min_chars}
        if finished:
            self.version = max(finished)
            before = json.loads(read_text(spark, f"{folder}/shape.json"))
            if before != shape:
                raise ValueError(f"the store in {folder} was made with {before}")
            return
        self.version = 0
        write_text(spark, f"{folder}/shape.json", json.dumps(shape))
        self._write(spark.createDataFrame([], KEY_LISTS), "references", 0)
        self._write(spark.createDataFrame([], KEY_LISTS), "filters", 0)

    def _write(self, frame: DataFrame, table: str, version: int) -> None:
        frame.write.mode("overwrite").parquet(f"{self.folder}/{table}/{version}")

    def _read(self, table: str, version: int | None = None) -> DataFrame:
        version = self.version if version is None else version
        return self.spark.read.schema(KEY_LISTS).parquet(f"{self.folder}/{table}/{version}")

    def insert(self, docs: DataFrame) -> None:
        """Add documents; those whose ids the store holds references of already are left as they are."""
        dealt = segmented(docs, segments=self.segments)
        added = dealt.groupBy("segment").applyInArrow(
            _references(self.min_chars, self.buckets, by_document=True), KEY_LISTS
        )
        stored = self._read("references")
        new = added.groupBy("segment").cogroup(stored.groupBy("segment")).applyInArrow(_only_new, KEY_LISTS)
        self._replace(stored.unionByName(new))

    def delete(self, doc_ids: DataFrame) -> None:
        """Take documents out; ``doc_ids`` has a column doc_id."""
        gone = segmented(doc_ids.select("doc_id", F.lit("").alias("text")), segments=self.segments)
        left = self._read("references").groupBy("segment").cogroup(gone.groupBy("segment"))
        self._replace(left.applyInArrow(_without, KEY_LISTS))

    def _replace(self, references: DataFrame) -> None:
        new, before = self.version + 1, self._read("filters")
        self._write(references, "references", new)
        now = self._read("references", new).groupBy("bucket")
        self._write(now.cogroup(before.groupBy("bucket")).applyInArrow(_filters, KEY_LISTS), "filters", new)
        self.version = new

    def unseen(self, docs: DataFrame) -> DataFrame:
        """doc_id and how many of its counted lines are certainly in no stored document."""
        asked = segmented(docs, segments=self.segments).groupBy("segment").applyInArrow(
            _references(self.min_chars, self.buckets, by_document=True), KEY_LISTS
        )
        found = asked.groupBy("bucket").cogroup(self._read("filters").groupBy("bucket")).applyInArrow(
            _probe, "doc_id long, n_new long"
        )
        return found.groupBy("doc_id").agg(F.sum("n_new").alias("n_new"))

    def clean(self, docs: DataFrame, min_docs: int = 3, carry: Sequence[str] = ()) -> DataFrame:
        """As clean_lines, for stored documents, counted over all that the store holds."""
        counted = self._read("references").groupBy("bucket", "segment").applyInArrow(_summed, KEY_LISTS)
        verdicts = counted.groupBy("bucket").applyInArrow(_judge(min_docs), KEY_LISTS)
        dealt = segmented(docs, carry, self.segments)
        return _apply(docs, dealt, verdicts, self.min_chars, carry)


def _pairs(table: pa.Table) -> list[np.ndarray]:
    """(key, check, document) of several lists, sorted."""
    found = [B.load(x) for x in table["keys"].to_pylist()]
    keys, check, holder = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.lexsort((holder, check, keys))
    return [keys[order], check[order], holder[order]]


def _summed(table: pa.Table) -> pa.Table:
    bucket, segment = table["bucket"][0].as_py(), table["segment"][0].as_py()
    return lists([(bucket, segment, 0, B.dump(*_counted(*_pairs(table))))])


def _only_new(added: pa.Table, stored: pa.Table) -> pa.Table:
    held = [np.unique(B.load(x)[2]) for x in stored["keys"].to_pylist()]
    return _less(added, np.unique(np.concatenate(held)) if held else np.zeros(0, np.uint64))


def _without(table: pa.Table, gone: pa.Table) -> pa.Table:
    return _less(table, np.sort(B.ids(gone["doc_id"]).view(np.uint64) ^ _SIGN))


def _less(table: pa.Table, leaving: np.ndarray) -> pa.Table:
    """The lists without the references of these documents."""
    rows = []
    for row in table.to_pylist():
        columns = B.load(row["keys"])
        stay = ~B.member(columns[2], leaving)
        if stay.any():
            rows.append((row["bucket"], row["segment"], 0, B.dump(*(c[stay] for c in columns))))
    return lists(rows)


def _filters(references: pa.Table, before: pa.Table) -> pa.Table:
    """A shard's filter brought in line with its exact references: new keys in, lost ones out.

    The filter's own list of keys is stored with it, since a fingerprint alone cannot tell
    which key it stands for."""
    bucket = (references if references.num_rows else before)["bucket"][0].as_py()
    keys = np.unique(_pairs(references)[0]) if references.num_rows else np.zeros(0, np.uint64)
    old = {r["kind"]: r["keys"] for r in before.to_pylist()}
    if not old:
        made = CuckooFilter.of(keys, 2 * len(keys))
    else:
        made, had = CuckooFilter.from_bytes(old[3]), B.load(old[2])[0]
        made.delete(had[~B.member(had, keys)])
        if not made.insert(keys[~B.member(keys, had)]):
            made = CuckooFilter.of(keys, 2 * len(keys))
    return lists([(bucket, -1, 3, made.to_bytes()), (bucket, -1, 2, B.dump(keys))])


def _probe(asked: pa.Table, stored: pa.Table) -> pa.Table:
    if not asked.num_rows:
        return pa.table({"doc_id": pa.array([], pa.int64()), "n_new": pa.array([], pa.int64())})
    keys, _, holder = _pairs(asked)
    blobs = {r["kind"]: r["keys"] for r in stored.to_pylist()}
    known = CuckooFilter.from_bytes(blobs[3]).contains(keys) if blobs else np.zeros(len(keys), bool)
    ids, at = np.unique(holder, return_inverse=True)
    return pa.table({
        "doc_id": pa.array((ids ^ _SIGN).view(np.int64), pa.int64()),
        "n_new": pa.array(np.bincount(at, weights=~known).astype(np.int64), pa.int64()),
    })
