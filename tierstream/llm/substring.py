"""Substring dedup by fixed-block anchors.

Every document is an indexed reference: its words are cut into blocks of ``block`` words
that do not overlap. Every rolling window of ``block`` words of every document probes that
index. A repeat of at least ``2 * block - 1`` words always covers a whole block of its
other copy, so no repeat is missed. Hits are extended to the windows of ``window`` words
around them; a window is confirmed by an 80-bit fingerprint of its whole word sequence
against the earliest holder of the same sequence, and confirmed windows that overlap or
touch are joined to maximal repeats.

Three passes over the segmented documents, each sending only key lists:

1. distinct probe hashes, with a bit for those that start an indexed block. A bucket
   returns to each segment the hashes that another segment shares and some segment indexed;
2. fingerprints of the windows around hits, with the earliest document of the segment;
   the bucket returns those that an earlier document of another segment holds;
3. the words that confirmed windows cover are removed.

A passage in thousands of documents is one entry per segment in either list, never pairs.

Null or empty text: no words, nothing removed. Null doc_id: sorts before all others. Rows
with the same doc_id are one document's copies: a window is no repeat of the same start
in the same doc_id. Other columns are ignored, or carried along if named.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from tierstream.llm import blocks as B
from tierstream.llm.frames import KEY_LISTS, lists, parts, received, rest_type, segmented

_ANCHOR_BITS = 40  # anchors only nominate; windows are confirmed by longer fingerprints


class _Words:
    """A segment's documents in order of doc_id, as word hashes."""

    def __init__(self, table: pa.Table):
        order = pc.sort_indices(table, sort_keys=[("doc_id", "ascending")], null_placement="at_start")
        self.table = table.take(order)
        self.doc_ids = B.ids(self.table["doc_id"])
        self.data, self.offsets = B.utf8(self.table["text"])
        self.starts, self.ends, self.owner = B.words(self.data, self.offsets)
        self.hashes = B.hash_spans(self.data, self.starts, self.ends)
        first = np.searchsorted(self.owner, np.arange(len(self.doc_ids)))
        self.place = np.arange(len(self.starts)) - first[self.owner]  # word number in its document

    def anchors(self, block: int) -> tuple[np.ndarray, np.ndarray]:
        """Word numbers and shortened hashes of all rolling windows of a block's length."""
        at = np.flatnonzero(B.inside(self.owner, block))
        return at, B.rolling(self.hashes, block, 11)[at] >> np.uint64(64 - _ANCHOR_BITS)

    def windows(self, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Word numbers and two hashes (64 and 16 bits) of all windows."""
        at = np.flatnonzero(B.inside(self.owner, window))
        check = B.rolling(self.hashes, window, 13)[at] >> np.uint64(48)
        return at, B.rolling(self.hashes, window, 12)[at], check


def repeated_spans(
    docs: DataFrame, window: int = 20, block: int = 10, carry: Sequence[str] = ()
) -> DataFrame:
    """Each document with its repeats removed.

    doc_id, n_words, n_removed, ``spans`` (word number and length of each maximal repeat),
    ``kept_words`` (the other words joined by one space), and ``rest`` with the carried
    columns. A word goes if a window of ``window`` words that covers it also starts
    earlier: in a smaller doc_id, or earlier in the same document.
    """
    if 2 * block - 1 > window:
        raise ValueError("a window must be sure to cover a whole block")
    buckets = parts(docs.sparkSession)
    dealt = segmented(docs, carry)
    texts = dealt.select("doc_id", "text", "segment") if carry else dealt
    hits = (
        texts.groupBy("segment").applyInArrow(_probe(block, buckets), KEY_LISTS)
        .groupBy("bucket").applyInArrow(_match, KEY_LISTS)
    )
    repeats = (
        texts.groupBy("segment").cogroup(hits.groupBy("segment"))
        .applyInArrow(_extend(window, block, buckets), KEY_LISTS)
        .groupBy("bucket").applyInArrow(_confirm, KEY_LISTS)
    )
    schema = (
        "doc_id long, n_words long, n_removed long, spans array<struct<start:int,length:int>>, "
        "kept_words string" + rest_type(docs, carry)
    )
    return dealt.groupBy("segment").cogroup(repeats.groupBy("segment")).applyInArrow(
        _remove(window, bool(carry)), schema
    )


def _probe(block: int, buckets: int):
    def probe(table: pa.Table) -> pa.Table:
        if not table.num_rows:
            return lists([])
        words = _Words(table)
        at, anchors = words.anchors(block)
        order = np.argsort(anchors, kind="stable")
        keys, indexed = anchors[order], (words.place[at] % block == 0)[order]
        starts, _ = B.groups(keys)
        keys, indexed = keys[starts], np.logical_or.reduceat(indexed, starts) if len(starts) else indexed
        segment = table["segment"][0].as_py()
        return lists([
            (b, segment, 0, B.dump(keys[s], indexed[s])) for b, s in B.dealt(keys, buckets, _ANCHOR_BITS)
        ])

    return probe


def _match(table: pa.Table) -> pa.Table:
    """To each segment, its hashes that another segment has too and some segment indexed."""
    found = [B.load(x) for x in table["keys"].to_pylist()]
    if len(found) < 2:
        return lists([])
    keys, indexed = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.argsort(keys, kind="stable")
    starts, sizes = B.groups(keys[order])
    shared = (sizes > 1) & (np.add.reduceat(indexed[order], starts) > 0)
    hot = np.zeros(len(keys), bool)
    hot[order] = np.repeat(shared, sizes)
    return _replies(table, found, hot)


def _replies(table: pa.Table, found: list[list[np.ndarray]], wanted: np.ndarray) -> pa.Table:
    rows, low = [], 0
    for bucket, segment, own in zip(
        table["bucket"].to_pylist(), table["segment"].to_pylist(), found, strict=True
    ):
        mask = wanted[low : low + len(own[0])]
        low += len(own[0])
        if mask.any():
            rows.append((bucket, segment, 0, B.dump(own[0][mask])))
    return lists(rows)


def _extend(window: int, block: int, buckets: int):
    def extend(table: pa.Table, replies: pa.Table) -> pa.Table:
        if not table.num_rows:
            return lists([])
        words = _Words(table)
        at, anchors = words.anchors(block)
        hits = at[B.member(anchors, received(replies)[0])]
        near = np.zeros(len(words.starts), bool)  # windows that cover an anchor that was hit
        for back in range(window - block + 1):
            near[hits[hits >= back] - back] = True
        where, keys, check = words.windows(window)
        picked = near[where]
        where, keys, check = where[picked], keys[picked], check[picked]
        order = np.argsort(keys, kind="stable")  # the earliest of the segment comes first
        starts, _ = B.groups(keys[order])
        first = order[starts]
        holder = words.doc_ids[words.owner[where[first]]].view(np.uint64) ^ np.uint64(1 << 63)
        base = holder.min() if len(holder) else np.uint64(0)
        segment = table["segment"][0].as_py()
        return lists([
            (b, segment, 0, base.tobytes() + B.dump(keys[first][s], check[first][s], holder[s] - base))
            for b, s in B.dealt(keys[first], buckets)
        ])

    return extend


def _confirm(table: pa.Table) -> pa.Table:
    """To each segment, its windows of which an earlier document elsewhere is the first."""
    found = []
    for blob in table["keys"].to_pylist():
        keys, check, holder = B.load(blob[8:])
        found.append([keys, check, holder + np.frombuffer(blob, np.uint64, 1)[0]])
    if len(found) < 2:
        return lists([])
    keys, check, holder = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.lexsort((holder, check, keys))
    keys, check, holder = keys[order], check[order], holder[order]
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]) | (check[1:] != check[:-1])
    starts = np.flatnonzero(new)
    sizes = np.diff(np.append(starts, len(keys)))
    late = np.zeros(len(keys), bool)
    late[order] = holder > np.repeat(holder[starts], sizes)
    return _replies(table, found, late)


def _remove(window: int, carries: bool):
    def remove(table: pa.Table, replies: pa.Table) -> pa.Table:
        words = _Words(table)
        n = len(words.starts)
        where, keys, check = words.windows(window)
        order = np.argsort(keys, kind="stable")
        starts, sizes = B.groups(keys[order])
        first = np.empty(len(keys), np.int64)
        first[order] = np.repeat(order[starts], sizes)  # the segment's first window of equal words
        doc, place = words.doc_ids[words.owner[where]], words.place[where]
        again = (check == check[first]) & ((doc != doc[first]) | (place != place[first]))
        again |= B.member(keys, received(replies)[0])
        step = np.zeros(n + 1, np.int64)
        step[where[again]] += 1
        step[where[again] + window] -= 1
        gone = np.cumsum(step[:-1]) > 0
        docs = len(words.doc_ids)
        removed = np.bincount(words.owner[gone], minlength=docs)

        # Maximal repeats: runs of removed words within a document.
        same = np.zeros(n, bool)
        same[1:] = gone[1:] & gone[:-1] & (words.owner[1:] == words.owner[:-1])
        begins = np.flatnonzero(gone & ~same)
        lengths = np.diff(np.append(np.flatnonzero((gone & ~same)[gone]), gone.sum())) if len(begins) else begins
        per_doc = np.bincount(words.owner[begins], minlength=docs)
        spans = pa.ListArray.from_arrays(
            pa.array(np.append(0, np.cumsum(per_doc)), pa.int32()),
            pa.StructArray.from_arrays(
                [pa.array(words.place[begins], pa.int32()), pa.array(lengths, pa.int32())], ["start", "length"]
            ),
        )
        text = np.where(B.SPACE[words.data], np.uint8(0x20), words.data)
        kept = B.joined(text, words.offsets, words.starts, words.ends, words.owner, ~gone)
        columns = {
            "doc_id": B.plain(words.table["doc_id"]),
            "n_words": pa.array(np.bincount(words.owner, minlength=docs), pa.int64()),
            "n_removed": pa.array(removed, pa.int64()),
            "spans": spans,
            "kept_words": kept,
        }
        if carries:
            columns["rest"] = B.plain(words.table["rest"])
        return pa.table(columns)

    return remove

