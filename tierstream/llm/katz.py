"""Bigram language model with Katz backoff.

Tokens are words, A-Z lower-cased, and one end per document; the first token's context is a
start mark. With c(.) counted over the training documents:

    P(w | h) = d(c(hw)) c(hw) / (c(h) + 1/2)      if c(hw) > 0
             = a(h) P(w)                           otherwise
    P(w)     = d(c(w)) c(w) / (N + 1/2)            if c(w) > 0; the rest is for unknown words

d is the Good-Turing discount for counts up to 5, from the counts of counts of all bigrams
(or words); where an estimate is not between 0 and 1, half a count is taken off instead.
The half counts below leave something over for unseen words even where all counts are
high. a(h) makes the probabilities after h sum to 1 exactly: (1 - sum of P(w | h)) / (1 -
sum of P(w)), both over the words seen after h; it is 1 if h was never seen.

The tables are partitioned by ranges of 64-bit key hashes (``ngram_tables`` gives them as
rows). Scoring sends keys, not texts, to them: each segment of documents asks every
partition once for the counts of its distinct words and bigrams, gets them back in the same
order, and adds up a document's known bigrams. Sums for a(h) are taken over each distinct
bigram once, by the first segment that has it; only contexts from which some document backs
off are asked for a(h).

Null or empty text: the end alone. Null doc_id: no crc32, so it is trained on and scored.
Without training documents every token is unknown, with probability 1. Other columns are
ignored.
"""

from __future__ import annotations


import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierstream.llm import blocks as B
from tierstream.llm.frames import KEY_LISTS, lists, parts, segmented
from tierstream.llm.toxicity import held_out

_START, _END = B.series(2, 61)
_CUT = 5  # counts above are taken as they are
_WORDS, _PAIRS, _STATS, _SUMS, _ASKED = range(5)


class _Segment:
    """A segment's tokens: distinct words and bigrams, and where each token's are."""

    def __init__(self, table: pa.Table):
        data, offsets = B.utf8(table["text"])
        data = B.LOWER[data]
        starts, ends, owner = B.words(data, offsets)
        docs = len(offsets) - 1
        self.docs = docs
        self.sizes = np.bincount(owner, minlength=docs) + 1
        self.owner = np.repeat(np.arange(docs), self.sizes)
        last = np.cumsum(self.sizes) - 1
        tokens = np.full(len(self.owner), _END)
        word = np.ones(len(tokens), bool)
        word[last] = False
        tokens[word] = B.hash_spans(data, starts, ends, 62)
        before = np.append(_START, tokens[:-1]) if len(tokens) else tokens
        before[last - self.sizes + 1] = _START
        held = table["held"].to_numpy()
        self.held, train = held, ~held[self.owner]
        self.words, self.word = np.unique(tokens, return_inverse=True)
        self.word_counts = np.bincount(self.word, weights=train, minlength=len(self.words)).astype(np.uint64)
        factors = B.series(2, 63) | np.uint64(1)
        self.pairs, first, self.pair = np.unique(
            B.mix(before * factors[0] + tokens * factors[1]), return_index=True, return_inverse=True
        )
        self.pair_counts = np.bincount(self.pair, weights=train, minlength=len(self.pairs)).astype(np.uint64)
        self.pair_word = self.word[first]
        at = np.searchsorted(self.words, before)
        at[before == _START] = len(self.words)  # one more context than words
        self.context, self.pair_context = at, at[first]


def _ask(buckets: int):
    def ask(table: pa.Table) -> pa.Table:
        if not table.num_rows:
            return lists([])
        own, segment = _Segment(table), table["segment"][0].as_py()
        return lists([
            (b, segment, kind, B.dump(keys[s], counts[s]))
            for kind, keys, counts in ((_WORDS, own.words, own.word_counts), (_PAIRS, own.pairs, own.pair_counts))
            for b, s in B.dealt(keys, buckets)
        ])

    return ask


def _totals(table: pa.Table, kind: int):
    """Of the lists of one kind: their segments and lengths; all keys, their total counts,
    and which entry is the first of its key."""
    rows = [r for r in table.to_pylist() if r["kind"] == kind]
    found = [B.load(r["keys"]) for r in rows]
    if not found:
        empty = np.zeros(0, np.uint64)
        return rows, [], empty, empty, np.zeros(0, bool)
    keys, counts = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.argsort(keys, kind="stable")
    starts, sizes = B.groups(keys[order])
    total, first = np.empty(len(keys), np.uint64), np.zeros(len(keys), bool)
    total[order] = np.repeat(np.add.reduceat(counts[order], starts), sizes)
    first[order[starts]] = True
    return rows, [len(x[0]) for x in found], keys, total, first


def _answer(table: pa.Table) -> pa.Table:
    """To each segment the total counts of what it asked for, in its order."""
    out = []
    for kind in (_WORDS, _PAIRS):
        rows, lengths, _, total, first = _totals(table, kind)
        low = 0
        for row, n in zip(rows, lengths, strict=True):
            part = slice(low, low + n)
            out.append((row["bucket"], row["segment"], kind, B.dump(np.arange(n), total[part], first[part])))
            low += n
    return lists(out)


_STATS_SCHEMA = ", ".join(["tokens long", "known long"] + [f"{k}{r} long" for k in ("w", "p") for r in range(1, _CUT + 2)])


def _counts_of_counts(table: pa.Table) -> pa.Table:
    values = []
    for kind in (_WORDS, _PAIRS):
        *_, total, first = _totals(table, kind)
        total = total[first & (total > 0)]
        if kind == _WORDS:
            values += [int(total.sum()), len(total)]
        values += [int((total == r).sum()) for r in range(1, _CUT + 2)]
    names = [x.split()[0] for x in _STATS_SCHEMA.split(", ")]
    return pa.table([pa.array([v], pa.int64()) for v in values], names=names)


def discounts(n: list[int]) -> np.ndarray:
    """Good-Turing discounts of counts 0 to _CUT + 1, from the numbers n of keys with count
    1 to _CUT + 1; the last stands for all higher counts."""
    d = np.ones(_CUT + 2)
    high = (_CUT + 1) * n[_CUT] / n[0] if n[0] else 1.0
    for r in range(1, _CUT + 1):
        ratio = (r + 1) * n[r] / (r * n[r - 1]) if n[r - 1] else 1.0
        d[r] = (ratio - high) / (1 - high) if high < 1 else 1.0
        if not 0 < d[r] < 1:
            d[r] = (r - 0.5) / r
    return d


class _Model:
    """What a segment has been told: counts of its words and bigrams, and the statistics."""

    def __init__(self, own: _Segment, replies: pa.Table, buckets: int):
        self.word_counts = np.zeros(len(own.words))
        self.pair_counts, self.owned = np.zeros(len(own.pairs)), np.zeros(len(own.pairs), bool)
        told = {(r["kind"], r["bucket"]): r["keys"] for r in replies.to_pylist()}
        for b, s in B.dealt(own.words, buckets):
            self.word_counts[s] = B.load(told[_WORDS, b])[1]
        for b, s in B.dealt(own.pairs, buckets):
            _, self.pair_counts[s], self.owned[s] = B.load(told[_PAIRS, b])
        values = [int(x) for x in told[_STATS, -1].split(b",")]
        self.tokens, self.known = values[:2]
        words, pairs = values[2 : _CUT + 3], values[_CUT + 3 :]
        d = discounts(words)
        counts = np.minimum(self.word_counts, _CUT + 1).astype(np.int64)
        seen = d[counts] * self.word_counts / (self.tokens + 0.5)
        low = sum(r * n * (1 - d[r]) for r, n in enumerate(words[:_CUT], 1))
        unknown = (low + 0.5) / (self.tokens + 0.5)
        self.word_p = np.where(self.word_counts > 0, seen, unknown)
        d = discounts(pairs)
        end = np.searchsorted(own.words, _END)
        starts = self.word_counts[end] if len(own.words) else 0.0
        self.context_counts = np.append(self.word_counts, starts)  # as many starts as ends
        below = self.context_counts[own.pair_context] + 0.5
        self.pair_p = d[np.minimum(self.pair_counts, _CUT + 1).astype(np.int64)] * self.pair_counts / below

    def asked(self, own: _Segment) -> tuple[np.ndarray, np.ndarray]:
        """Tokens that back off from a context that has been seen; the distinct contexts."""
        back = np.flatnonzero((self.pair_counts[own.pair] == 0) & (self.context_counts[own.context] > 0))
        return back, np.unique(own.context[back])


def _context_keys(own: _Segment, contexts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The contexts' hashes in rising order, and the order."""
    keys = np.append(own.words, _START)[contexts]
    order = np.argsort(keys)
    return keys[order], order


def _sums(buckets: int):
    def sums(table: pa.Table, replies: pa.Table) -> pa.Table:
        if not table.num_rows:
            return lists([])
        own, segment = _Segment(table), table["segment"][0].as_py()
        model = _Model(own, replies, buckets)
        mine = np.flatnonzero(model.owned & (model.pair_counts > 0))
        size = len(own.words) + 1
        seen = np.bincount(own.pair_context[mine], weights=model.pair_p[mine], minlength=size)
        plain = np.bincount(own.pair_context[mine], weights=model.word_p[own.pair_word[mine]], minlength=size)
        contexts = np.flatnonzero(seen > 0)
        keys, order = _context_keys(own, contexts)
        columns = [x[contexts[order]].view(np.uint64) for x in (seen, plain)]
        rows = [(b, segment, _SUMS, B.dump(keys[s], *(c[s] for c in columns))) for b, s in B.dealt(keys, buckets)]
        keys, _ = _context_keys(own, model.asked(own)[1])
        return lists(rows + [(b, segment, _ASKED, B.dump(keys[s])) for b, s in B.dealt(keys, buckets)])

    return sums


def _weights(table: pa.Table) -> pa.Table:
    """To each segment a(h) of the contexts it asked for, in its order."""
    rows = table.to_pylist()
    sums = [B.load(r["keys"]) for r in rows if r["kind"] == _SUMS]
    out = []
    if sums:
        keys, seen, plain = (np.concatenate(x) for x in zip(*sums, strict=True))
        order = np.argsort(keys, kind="stable")
        starts, _ = B.groups(keys[order])
        names = keys[order][starts]
        seen, plain = (np.add.reduceat(x.view(np.float64)[order], starts) for x in (seen, plain))
        for r in rows:
            if r["kind"] == _ASKED:
                wanted = B.load(r["keys"])[0]
                at = np.searchsorted(names, wanted)
                weight = (1 - seen[at]) / (1 - plain[at])
                out.append((r["bucket"], r["segment"], _ASKED, B.dump(np.arange(len(at)), weight.view(np.uint64))))
    return lists(out)


_PARTIAL = (
    "segment int, doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
    "base_score double, score double, waits binary"
)


def _score(buckets: int):
    def score(table: pa.Table, replies: pa.Table) -> pa.Table:
        own = _Segment(table)
        names = [x.split()[0] for x in _PARTIAL.split(", ")]
        if not table.num_rows:
            return pa.table([[]] * len(names), names=names).cast(_partial_schema())
        model = _Model(own, replies, buckets)
        counts = model.word_counts[own.word]
        base = np.log10((counts + 0.1) / (model.tokens + 0.1 * (model.known + 1)))
        known = model.pair_counts[own.pair] > 0
        value = np.where(known, model.pair_p[own.pair], model.word_p[own.word])
        total = lambda x: np.bincount(own.owner, weights=x, minlength=own.docs)
        # Tokens that wait for a(h): per document, the number of the context among those asked for.
        back, contexts = model.asked(own)
        _, order = _context_keys(own, contexts)
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        asked = rank[np.searchsorted(contexts, own.context[back])]
        cuts = np.searchsorted(own.owner[back], np.arange(own.docs + 1))
        waits = [B.dump(np.sort(asked[a:b])) if a < b else None for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        n = own.docs
        return pa.table([
            B.plain(table["segment"]), B.plain(table["doc_id"]), pa.array(own.held), pa.array(own.sizes, pa.int64()),
            pa.array(total(counts > 0).astype(np.int64)), pa.array(np.full(n, model.tokens), pa.int64()),
            pa.array(total(base)), pa.array(total(np.log10(value))), pa.array(waits, pa.binary()),
        ], names=names)

    return score


def _partial_schema() -> pa.Schema:
    kinds = {"int": pa.int32(), "long": pa.int64(), "boolean": pa.bool_(), "double": pa.float64(), "binary": pa.binary()}
    return pa.schema([(n, kinds[k]) for n, k in (x.split() for x in _PARTIAL.split(", "))])


def _finish(rows: pa.Table, replies: pa.Table) -> pa.Table:
    told = sorted(replies.select(["bucket", "keys"]).to_pylist(), key=lambda r: r["bucket"])
    weights = np.concatenate([B.load(r["keys"])[1] for r in told]).view(np.float64) if told else np.zeros(0)
    logs = np.log10(weights)
    score = rows["score"].to_numpy().copy()
    for i, blob in enumerate(rows["waits"].to_pylist()):
        if blob is not None:
            score[i] += logs[B.load(blob)[0].astype(np.int64)].sum()
    keep = rows.drop_columns(["segment", "waits", "score"])
    return keep.append_column("score", pa.array(score))


def _dealt(docs: DataFrame, fold: int) -> DataFrame:
    return segmented(docs).withColumn("held", held_out(fold))


def scored(docs: DataFrame, fold: int = 10) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score (smoothed words) and
    score (Katz), both log10 of the text's probability. Trained on the rows not held out."""
    spark = docs.sparkSession
    buckets = parts(spark)
    dealt = _dealt(docs, fold)
    asked = dealt.groupBy("segment").applyInArrow(_ask(buckets), KEY_LISTS)
    stats = asked.groupBy("bucket").applyInArrow(_counts_of_counts, _STATS_SCHEMA)
    names = [x.split()[0] for x in _STATS_SCHEMA.split(", ")]
    line = F.concat_ws(",", *(F.sum(n).cast("string") for n in names)).cast("binary")
    for_all = stats.agg(line.alias("keys")).select(
        F.lit(-1).alias("bucket"), F.explode(F.sequence(F.lit(0), F.lit(2 * parts(spark) - 1))).alias("segment"),
        F.lit(_STATS).alias("kind"), "keys",
    )
    answers = asked.groupBy("bucket").applyInArrow(_answer, KEY_LISTS).unionByName(for_all)
    told = answers.groupBy("segment")
    weights = (
        dealt.groupBy("segment").cogroup(told).applyInArrow(_sums(buckets), KEY_LISTS)
        .groupBy("bucket").applyInArrow(_weights, KEY_LISTS)
    )
    partial = dealt.groupBy("segment").cogroup(told).applyInArrow(_score(buckets), _PARTIAL)
    return partial.groupBy("segment").cogroup(weights.groupBy("segment")).applyInArrow(
        _finish, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    )


def ngram_tables(docs: DataFrame, fold: int = 10) -> DataFrame:
    """n (1 or 2), bucket, key, count of every word and bigram of the training documents; to
    be written partitioned by n and bucket."""

    def rows(table: pa.Table) -> pa.Table:
        found = []
        for n, kind in ((1, _WORDS), (2, _PAIRS)):
            _, _, keys, total, first = _totals(table, kind)
            pick = first & (total > 0)
            found.append((np.full(pick.sum(), n), keys[pick], total[pick]))
        n, keys, total = (np.concatenate(x) for x in zip(*found, strict=True))
        return pa.table({
            "n": pa.array(n, pa.int32()), "bucket": pa.array(np.full(len(n), table["bucket"][0].as_py()), pa.int32()),
            "key": pa.array(keys.view(np.int64)), "count": pa.array(total.astype(np.int64)),
        })

    asked = _dealt(docs, fold).groupBy("segment").applyInArrow(_ask(parts(docs.sparkSession)), KEY_LISTS)
    return asked.groupBy("bucket").applyInArrow(rows, "n int, bucket int, key long, count long")


