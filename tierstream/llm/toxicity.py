"""Toxicity by maximum-scoring segments.

Model. Each token's weight is its log-odds between toxic and clean labelled documents (each
counts a token once) under a Dirichlet prior: half a count for each token, and ``prior``
counts spread like the pooled ones. Only tokens whose log-odds are high and whose toxic
count stands out (z score) get a weight. Beginnings of tokens are counted the same way; a
token has the highest weight of itself and its beginnings, so that inflected forms never
met in training are scored too. Every other token costs ``drift``.

Scan. One pass over a document's tokens finds all maximal scoring segments, that is every
passage that toxic words lift above its surroundings. With scores of negative mean, the
best segment of a clean text of n words follows an extreme-value law, P(S > x) = 1 -
exp(-K n exp(-lambda x)); lambda solves E[exp(lambda s)] = 1 over the clean token
counts and K comes from the clean documents' best segments. A segment counts with
lambda S - ln(K n), significant ones of a document add up, and a logistic curve fitted on
the training sample turns the sum into the score.

The model is fitted on at most ``per_class`` toxic and as many clean training rows, chosen
by a hash of doc_id. Where that thins one class more than the other, its rows weigh more in
the z scores and in the curve, so that both see the mix of all training labels. The driver
holds the sample's labels and the weights of tokens that stand out in it. Scoring is one
pass over all texts without a shuffle.

Null or empty text: no tokens; the score is that of a text without toxic words. Null
doc_id: scored, held out like any other (the crc32 of null is null: not held out). Labels
that are null, or of documents that do not exist, are ignored; without any labelled toxic
row every score is 0.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierstream.llm import blocks as B
from tierstream.llm.frames import rest_type
from tierstream.llm.superminhash import slices

_LETTERS = np.zeros(256, bool)
_LETTERS[[*range(ord("a"), ord("z") + 1), *range(ord("0"), ord("9") + 1), *range(0x80, 0x100)]] = True
_STEMS = (4, 5, 6, 7)  # bytes of a token's beginning
_EULER = 0.5772156649015329  # mean of the standard extreme-value law


@dataclass(frozen=True)
class ToxicityModel:
    keys: np.ndarray  # sorted hashes of tokens and of first letters
    weights: np.ndarray
    drift: float
    scale: float  # lambda
    size: float  # K
    slope: float
    intercept: float

    def evidence(self, best: float, scores: list[float], n: int) -> float:
        """Sum over significant segments, or what the best one has, in units of the law."""
        norm = np.log(max(self.size * max(n, 1), 1.0))
        beyond = [self.scale * s - norm for s in scores]
        return float(sum(x for x in beyond if x > 0) or self.scale * best - norm)

    def probability(self, evidence: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * evidence + self.intercept, -500, 500)))


def held_out(parts: int):
    """Whether a row is kept from training: crc32 of doc_id as text divisible by parts."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % parts == 0, F.lit(False))


def maximal_segments(at: list[int], scores: list[float], drift: float) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (first, last, score) where position at[i] has scores[i]
    and every other position has -drift.

    Candidates are kept as (first, last, sum before it, sum up to its end, number of the
    nearest earlier candidate that starts lower). A new one joins with the nearest earlier
    candidate that starts lower, unless that one ends as high; the numbers lead there without
    a walk over all candidates, so the work is linear.
    """
    found: list[tuple[int, int, float, float, int]] = []
    total, last = 0.0, -1
    for position, score in zip(at, scores, strict=True):
        low = total - drift * (position - last - 1)
        total, last, first = low + score, position, position
        j = len(found) - 1
        while True:
            while j >= 0 and found[j][2] >= low:
                j = found[j][4]
            if j < 0 or found[j][3] >= total:
                found.append((first, position, low, total, j))
                break
            first, _, low, _, lower = found[j]
            del found[j:]
            j = lower
    return [(a, b, high - low) for a, b, low, high, _ in found]


def _tokens(texts: pa.Array) -> tuple[list[np.ndarray], list[np.ndarray], np.ndarray, int]:
    """Hashes of tokens and of each length of beginning, each with the tokens they are of;
    the tokens' texts; the number of texts."""
    data, offsets = B.utf8(texts)
    data = B.LOWER[data]
    starts, ends, owner = B.runs(_LETTERS[data], offsets)
    hashes, tokens = [B.hash_spans(data, starts, ends, 41)], [np.arange(len(starts))]
    for size in _STEMS:
        longer = np.flatnonzero(ends - starts > size)
        hashes.append(B.hash_spans(data, starts[longer], starts[longer] + size, 41 + size))
        tokens.append(longer)
    return hashes, tokens, owner, len(offsets) - 1


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        toxic = batch.column("toxic").to_numpy(zero_copy_only=False)
        for low, high in slices(batch.column("text")):
            hashes, tokens, owner, _ = _tokens(batch.column("text").slice(low, high - low))
            # A token counts once per document: bursts of a word in one text prove little.
            keys, of = np.concatenate(hashes), owner[np.concatenate(tokens)]
            names, at = np.unique(keys, return_inverse=True)
            once = np.unique(at * np.int64(high - low) + of)
            at, label = once // (high - low), toxic[low:high][once % (high - low)]
            counts = [np.bincount(at, weights=label == wanted, minlength=len(names)) for wanted in (1, 0)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(names.view(np.int64)), *(pa.array(c.astype(np.int64)) for c in counts)],
                names=["feature", "n_toxic", "n_clean"],
            )


def _scan(model: ToxicityModel, carry: list[str]):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high in slices(batch.column("text")):
                hashes, tokens, owner, docs = _tokens(batch.column("text").slice(low, high - low))
                weight = np.zeros(len(owner))
                for keys, of in zip(hashes, tokens, strict=True) if len(model.keys) else ():
                    at = np.minimum(np.searchsorted(model.keys, keys), len(model.keys) - 1)
                    own = np.where(model.keys[at] == keys, model.weights[at], 0.0)
                    weight[of] = np.maximum(weight[of], own)
                counts = np.bincount(owner, minlength=docs)
                first = np.cumsum(counts) - counts
                hits = np.flatnonzero(weight > 0)
                cuts = np.searchsorted(owner[hits], np.arange(docs + 1))
                evidence = np.empty(docs)
                best_of, passages = np.zeros(docs), []
                for d in range(docs):
                    own = hits[cuts[d] : cuts[d + 1]]
                    found = maximal_segments((own - first[d]).tolist(), weight[own].tolist(), model.drift)
                    best_of[d] = max((s for *_, s in found), default=0.0)
                    evidence[d] = model.evidence(best_of[d], [s for *_, s in found], int(counts[d]))
                    norm = np.log(max(model.size * max(counts[d], 1), 1.0))
                    passages.append([
                        {"start": a, "length": b - a + 1, "score": s} for a, b, s in found if model.scale * s > norm
                    ])
                rows = high - low
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(c).slice(low, rows) for c in carry),
                        pa.array(counts, pa.int64()), pa.array(best_of), pa.array(evidence),
                        pa.array(model.probability(evidence)),
                        pa.array(passages, pa.list_(pa.struct([
                            ("start", pa.int32()), ("length", pa.int32()), ("score", pa.float64())
                        ]))),
                    ],
                    names=[*carry, "n_tokens", "best", "evidence", "score", "passages"],
                )

    return scan


_SCAN_SCHEMA = (
    "n_tokens long, best double, evidence double, score double, "
    "passages array<struct<start:int,length:int,score:double>>"
)


def fit(
    docs: DataFrame, labels: DataFrame, per_class: int = 20_000,
    prior: float = 10.0, least_z: float = 5.0, least_weight: float = 3.0, drift: float = 0.05, fold: int = 5,
) -> ToxicityModel:
    """A model from the labelled rows that are not held out."""
    train = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    train = train.where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out(fold))
    # What a row of the sample stands for, in units of the less thinned class.
    totals = {r["toxic"]: r["count"] for r in train.groupBy("toxic").count().collect()}  # two rows
    thinned = [max(1.0, totals.get(c, 0) / per_class) for c in (0, 1)]
    stands = [x / min(thinned) for x in thinned]
    by_class = [
        train.where(F.col("toxic") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class) for c in (0, 1)
    ]
    sample = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(
        F.broadcast(by_class[0].unionByName(by_class[1])), "doc_id"  # 2 * per_class rows
    )
    # Weights come from one part and the curve from the other, or it would trust them too much.
    for_curve = F.pmod(F.xxhash64("text"), F.lit(10)) < 3
    counted = (
        sample.where(~for_curve).select("text", "toxic").mapInArrow(_count, "feature long, n_toxic long, n_clean long")
        .groupBy("feature").agg(F.sum("n_toxic").alias("n_toxic"), F.sum("n_clean").alias("n_clean"))
    )
    sums = counted.agg(F.sum("n_toxic"), F.sum("n_clean")).first()
    toxic, clean = (float(x or 0) for x in sums)
    nothing = ToxicityModel(np.zeros(0, np.uint64), np.zeros(0), drift, 1.0, 1.0, 0.0, -500.0)
    if not toxic:
        return nothing
    both = F.col("n_toxic") + F.col("n_clean")
    pseudo = 0.5 + prior / (toxic + clean) * both

    def log_odds(n: str, total: float):
        mass = F.col(n) + pseudo
        return F.log(mass / (total + prior - F.col(n)))

    all_toxic, all_clean = stands[1] * toxic, stands[0] * clean
    met_toxic = stands[1] * F.col("n_toxic")
    expected = (met_toxic + stands[0] * F.col("n_clean")) * all_toxic / (all_toxic + all_clean)
    weights = (
        counted.select(
            "feature", "n_clean", (log_odds("n_toxic", toxic) - log_odds("n_clean", clean)).alias("weight"),
            ((met_toxic - expected) / F.sqrt(expected)).alias("z"),
        )
        .where((F.col("z") >= least_z) & (F.col("weight") >= least_weight))
        .orderBy("feature").collect()
    )
    order = np.argsort(np.array([r["feature"] for r in weights], np.int64).view(np.uint64))
    keys = np.array([r["feature"] for r in weights], np.int64).view(np.uint64)[order]
    weight = np.array([r["weight"] for r in weights])[order]
    chance = np.array([r["n_clean"] for r in weights])[order] / max(clean, 1.0)
    scale = _law(weight, chance, drift)
    draft = ToxicityModel(keys, weight, drift, scale, 1.0, 1.0, 0.0)
    seen = (
        sample.where(F.coalesce(for_curve, F.lit(True))).select("toxic", "text").mapInArrow(_scan(draft, ["toxic"]), f"toxic int, {_SCAN_SCHEMA}")
        .select("toxic", "n_tokens", "best").toPandas()  # at most 2 * per_class rows of three numbers
    )
    calm = seen[(seen.toxic == 0) & (seen.n_tokens > 0)]
    size = float(np.exp(np.mean(scale * calm.best - np.log(calm.n_tokens)) - _EULER)) if len(calm) else 1.0
    draft = ToxicityModel(keys, weight, drift, scale, size, 1.0, 0.0)
    if not len(seen):
        return nothing
    x = np.array([draft.evidence(b, [b], int(n)) for b, n in zip(seen.best, seen.n_tokens, strict=True)])
    x = np.minimum(x, 20.0)  # far beyond any doubt; more would only flatten the curve
    y = seen.toxic.to_numpy().astype(float)
    slope, intercept = _logistic(x, y, np.where(y == 1, stands[1], stands[0]))
    return ToxicityModel(keys, weight, drift, scale, size, slope, intercept)


def _law(weight: np.ndarray, chance: np.ndarray, drift: float) -> float:
    """The positive root of E[exp(x s)] = 1; 1 where clean texts have no weighted token."""

    def excess(x: float) -> float:
        return float((chance * np.exp(x * weight)).sum() + max(0.0, 1 - chance.sum()) * np.exp(-x * drift) - 1)

    low, high = 0.0, 4.0
    if excess(1e-6) >= 0 or excess(high) <= 0:
        return 1.0
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if excess(middle) < 0 else (low, middle)
    return max(low, 0.05)


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and intercept for weighted rows by Newton steps, with a weak pull to zero against a perfect split."""
    design, beta = np.stack([x, np.ones_like(x)], 1), np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        gradient = design.T @ (weight * (y - p)) - 1e-3 * beta
        curve = (design * (weight * p * (1 - p))[:, None]).T @ design + 1e-3 * np.eye(2)
        step = np.linalg.solve(curve, gradient)
        beta += step * min(1.0, 2 / max(np.abs(step).max(), 1e-12))
        if np.abs(step).max() < 1e-9:
            break
    return float(max(beta[0], 1e-6)), float(beta[1])


def scored(
    docs: DataFrame, model: ToxicityModel, fold: int = 5, carry: Sequence[str] = (), with_text: bool = False
) -> DataFrame:
    """doc_id, held_out, score, predicted, evidence, the significant passages (token number,
    length, score), ``rest`` with the carried columns, and the text if asked for."""
    rest = [F.struct(*(F.col(f"`{c}`") for c in carry)).alias("rest")] if carry else []
    names = ["doc_id", *["rest"] * bool(carry), *["text"] * with_text]
    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *rest).mapInArrow(
        _scan(model, names), f"doc_id long{rest_type(docs, carry)}{', text string' * with_text}, {_SCAN_SCHEMA}"
    )
    return found.select(
        "doc_id", held_out(fold).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"), "evidence", "passages", *names[1:],
    )
