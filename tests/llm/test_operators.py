"""Operators against brute force, on a table of awkward rows and on the small documents."""

import collections
import hashlib
import math
import random
import re
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tierstream.llm import (
    imatch, katz, lines, packing, pieces, sharding, substring, superminhash, toxicity, vectors,
)
from tierstream.llm.cuckoo import CuckooFilter
from tierstream.llm.oracles import ORACLES
from tierstream.llm.queries import BYTE_BPE, PIECE_BPE, QUERIES

FOLDER = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, segment string, rest string, kept boolean, size int"


def rows_of_text():
    random.seed(3)
    word = lambda: random.choice(["ab", "cd", "Ef", "é", "x|y", "zz."]) + str(random.randrange(40))
    passage = " ".join(word() for _ in range(30))
    line = "Copyright by the makers of this table"
    texts = [None, "", " \t\n ", "one", "A b C", passage, passage, passage + " tail", "head " + passage,
             "x " * 3000, "w" * 30_000, f"{line}\nfirst", f"  {line.upper()}\nsecond", f"third\n{line}\n"]
    texts += [" ".join(word() for _ in range(random.randrange(60))) for _ in range(12)]
    return list(enumerate(texts))


@pytest.fixture(scope="module")
def docs(raw_spark):
    """Nulls, empty, very long and equal texts, and columns named like inner ones."""
    rows = [(i, t, "s", None, None, 1) for i, t in rows_of_text()]
    return raw_spark.createDataFrame(rows, SCHEMA).persist()


def by_id(frame):
    return {r["doc_id"]: r for r in frame.collect()}


def lower(text):
    return (text or "").translate({c: c + 32 for c in range(65, 91)})


def test_substring_dedup(docs):
    seen, got = set(), by_id(substring.repeated_spans(docs, carry=docs.columns))
    for i, text in rows_of_text():
        words = WORD.findall(text or "")
        gone = [False] * len(words)
        for k in range(len(words) - 19):
            window = tuple(words[k : k + 20])
            gone[k : k + 20] = [True] * 20 if window in seen else gone[k : k + 20]
            seen.add(window)
        assert (got[i]["n_words"], got[i]["n_removed"]) == (len(words), sum(gone))
        assert got[i]["kept_words"] == " ".join(w for w, g in zip(words, gone, strict=True) if not g)
        assert sum(s["length"] for s in got[i]["spans"]) == sum(gone)
        assert got[i]["rest"]["text"] == text and got[i]["rest"]["segment"] == "s"


def kept_lines(rows):
    key = lambda line: lower(line.strip(" \t\n\v\f\r"))
    holders = collections.defaultdict(set)
    for i, text in rows:
        for line in (text or "").split("\n"):
            holders[key(line)].add(i)
    drop = {k: max(v) for k, v in holders.items() if len(k) >= 20 and len(v) >= 3}
    return {
        i: "\n".join(x for x in (t or "").split("\n") if drop.get(key(x), i) == i) for i, t in rows
    }


def test_line_dedup(docs):
    got = by_id(lines.clean_lines(docs, carry=docs.columns))
    assert {i: r["kept"] for i, r in got.items()} == kept_lines(rows_of_text())
    assert all(r["n_lines"] == (r["rest"]["text"] or "").count("\n") + 1 for r in got.values())


def test_line_store_is_reversible(spark, docs, tmp_path):
    store = lines.LineStore(spark, str(tmp_path / "store"), 3, 3)
    store.insert(docs.where("doc_id < 13"))
    store.insert(docs.where("doc_id >= 13"))
    assert {i: r["kept"] for i, r in by_id(store.clean(docs)).items()} == kept_lines(rows_of_text())
    assert all(r["n_new"] == 0 for r in store.unseen(docs).collect())
    store.delete(docs.where("doc_id = 12").select("doc_id"))
    left = [r for r in rows_of_text() if r[0] != 12]
    assert {i: r["kept"] for i, r in by_id(store.clean(docs.where("doc_id <> 12"))).items()} == kept_lines(left)


def test_line_store_is_opened_again(raw_spark, docs, tmp_path):
    folder, rows = str(tmp_path / "store"), rows_of_text()
    store = lines.LineStore(raw_spark, folder, 3, 3)
    store.insert(docs.where("doc_id < 13"))
    # A change that ended between its two tables leaves the version before in force.
    raw_spark.createDataFrame([(0, 0, 0, bytearray(b"half"))], lines.KEY_LISTS).write.parquet(f"{folder}/references/2")
    store = lines.LineStore(raw_spark, folder, 3, 3)
    assert store.version == 1
    store.insert(docs.where("doc_id < 13"))  # held already: nothing counts twice
    two = raw_spark.createDataFrame([r for r in rows if r[0] in (11, 12)], "doc_id long, text string")
    assert [r["n_dropped"] for r in store.clean(two).collect()] == [0, 0]
    store.insert(docs)
    again = lines.LineStore(raw_spark, folder, 3, 3)
    assert again.version == 3
    assert {i: r["kept"] for i, r in by_id(again.clean(docs)).items()} == kept_lines(rows)
    with pytest.raises(ValueError):
        lines.LineStore(raw_spark, folder, 4, 3)


def test_cuckoo_filter():
    keys = np.random.default_rng(1).integers(0, 2**63, 20_000).astype(np.uint64)
    made = CuckooFilter.from_bytes(CuckooFilter.of(keys[:10_000]).to_bytes())
    assert made.contains(keys[:10_000]).all() and made.contains(keys[10_000:]).mean() < 0.01
    made.delete(keys[:5_000])
    assert made.contains(keys[5_000:10_000]).all() and made.contains(keys[:5_000]).mean() < 0.01


def test_cuckoo_filter_of_one_shard():
    keys = np.random.default_rng(1).integers(0, 2**64 // 20_000, 20_000).astype(np.uint64)
    assert CuckooFilter.of(keys[:10_000]).contains(keys[10_000:]).mean() < 0.01


def shingle_set(text):
    words = WORD.findall(lower(text))
    return frozenset(tuple(words[k : k + 5]) for k in range(max(len(words) - 4, 1))) if words else frozenset()


def brute_segments(scores):
    """Maximal scoring segments by their definition: the best segment, then each side."""
    if not scores:
        return set()
    best = max(((sum(scores[a : b + 1]), a - b, -a, b) for a in range(len(scores)) for b in range(a, len(scores))))
    if best[0] <= 0:
        return set()
    first, last = -best[2], best[3]
    right = {(a + last + 1, b + last + 1) for a, b in brute_segments(scores[last + 1 :])}
    return {(first, last)} | brute_segments(scores[:first]) | right


def test_all_maximal_segments():
    rnd = random.Random(8)
    for _ in range(200):
        n = rnd.randrange(1, 22)
        at = sorted(rnd.sample(range(n), rnd.randrange(0, n + 1)))
        hits = [rnd.randrange(1, 2**20) / 2**19 for _ in at]
        drift = rnd.choice([0.25, 0.5, 1.0]) + rnd.randrange(2**10) / 2**20
        scores = [-drift] * n
        for k, x in zip(at, hits, strict=True):
            scores[k] = x
        assert {(a, b) for a, b, _ in toxicity.maximal_segments(at, hits, drift)} == brute_segments(scores)


def test_segment_scan_is_linear():
    import time

    n = 20_000
    started = time.perf_counter()
    found = toxicity.maximal_segments([100 * k for k in range(n)], [3.0] * n, 0.05)
    falling = toxicity.maximal_segments(list(range(0, 2 * n, 2)), [1.0] * n, 2.0)
    assert len(found) == n and len(falling) == n and time.perf_counter() - started < 2


def test_near_duplicates_of_repeated_ids(raw_spark):
    """A doc_id with several texts links what any of them links."""
    a, b, c = (" ".join(f"{x}{i}" for i in range(60)) for x in "abc")
    rows = [(1, a), (1, b), (2, a + " tail"), (3, b + " tail"), (4, c), (5, c), (None, a), (6, None), (7, b), (7, "few words")]
    got = superminhash.near_duplicates(raw_spark.createDataFrame(rows, "doc_id long, text string"))
    found = {(r["doc_id"], r["component_id"], r["kept"]) for r in got.collect()}
    assert found == {
        (1, 1, True), (2, 1, False), (3, 1, False), (4, 4, True), (5, 4, False), (None, None, True), (6, 6, True), (7, 1, False),
    }


def test_near_duplicates(docs):
    sets = {i: shingle_set(t) for i, t in rows_of_text()}
    root = {i: i for i in sets}
    for _ in sets:
        for a in sets:
            for b in sets:
                if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                    root[a] = root[b] = min(root[a], root[b])
    got = by_id(superminhash.near_duplicates(docs))
    assert {i: r["component_id"] for i, r in got.items()} == root
    assert all(r["n_shingles"] == len(sets[i]) and r["kept"] == (root[i] == i) for i, r in got.items())


def test_near_duplicates_of_a_crowd(raw_spark, monkeypatch):
    """Many texts alike, few of them enough: blocks and pairs give the same groups."""
    random.seed(1)
    base = [f"w{k}" for k in range(120)]
    texts = []
    for _ in range(60):
        own = list(base)
        for _ in range(random.choice([2, 6, 7, 8])):
            own[random.randrange(120)] = f"n{random.random()}"
        texts.append(" ".join(own))
    frame = raw_spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    by_pairs = {i: r["component_id"] for i, r in by_id(superminhash.near_duplicates(frame)).items()}
    monkeypatch.setattr(superminhash, "_CROWDED", 0)
    monkeypatch.setattr(superminhash, "_BLOCK", 8)
    assert {i: r["component_id"] for i, r in by_id(superminhash.near_duplicates(frame)).items()} == by_pairs
    sets, root = [shingle_set(t) for t in texts], list(range(60))
    for _ in range(60):
        for a in range(60):
            for b in range(60):
                if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                    root[a] = root[b] = min(root[a], root[b])
    assert by_pairs == dict(enumerate(root))


def test_super_minhash_estimates_similarity():
    random_ = np.random.default_rng(0)
    common, a, b = (random_.integers(0, 2**63, n).astype(np.uint64) for n in (300, 50, 50))
    elements = np.concatenate([common, a, common, b])
    slots = superminhash.signatures(elements, np.repeat([0, 1], 350), 3, 256)
    assert abs((slots[0] == slots[1]).mean() - 0.75) < 0.1
    assert (slots[2] == np.uint64(2**64 - 1)).all()
    few = superminhash.signatures(common[:3], np.zeros(3, int), 1, 256)
    assert (few < np.uint64(2**64 - 1)).all()


def test_sharding(docs):
    rows = rows_of_text()
    atoms = {}
    for _, t in rows:
        atoms[t or ""] = atoms.get(t or "", 0) + len((t or "").encode()) + 1
    got = sharding.sharded(docs.where("doc_id NOT IN (9, 10)"), 4).collect()
    for text in {t or "" for _, t in rows}:
        assert len({r["shard"] for r in got if (rows[r["doc_id"]][1] or "") == text}) <= 1
    for shard in {r["shard"] for r in got}:
        own = [r for r in got if r["shard"] == shard]
        assert sorted(r["slot"] for r in own) == list(range(len(own)))
    sizes = [v for k, v in atoms.items() if k not in (rows[9][1], rows[10][1])]

    def needed(capacity):
        n, filled = 1, 0
        for s in sizes:
            n, filled = (n + 1, s) if filled + s > capacity else (n, filled + s)
        return n

    best = next(c for c in range(max(sizes), sum(sizes) + 1) if needed(c) <= 4)
    assert max(sum(r["size"] for r in got if r["shard"] == s) for s in range(4)) == best
    assert all(r["text_crc32"] == zlib.crc32((rows[r["doc_id"]][1] or "").encode()) for r in got)


@pytest.mark.parametrize("sizes, shards", [
    ([50, 45, 45, 5, 100, 5], 3), ([10, 20, 20, 20, 20, 20], 4), ([3, 400, 2, 2, 2, 2, 2, 2], 6), ([7, 300], 2),
    ([*range(2, 40), 900, *range(2, 30)], 8), ([5, 60, 5, 60, 60, 4], 5), ([9, 9], 4),
])
def test_sharding_with_large_atoms(raw_spark, sizes, shards):
    """Against all ways to cut; an atom above the even share leaves no shard empty."""
    rows = [(1000 * i + 7, chr(33 + i) * (s - 1)) for i, s in enumerate(sizes)]
    got = sharding.sharded(raw_spark.createDataFrame(rows, "doc_id long, text string"), shards).collect()
    least = [math.inf] * len(sizes) + [0]  # of the atoms from i on, with the shards of the round
    for _ in range(shards):
        least = [
            min(max(sum(sizes[i:j]), least[j]) for j in range(i + 1, len(sizes) + 1)) for i in range(len(sizes))
        ] + [0]
    filled = collections.Counter()
    for r in got:
        filled[r["shard"]] += r["size"]
    assert max(filled.values()) == least[0] and len(filled) == min(shards, len(sizes))
    order = [r["shard"] for r in sorted(got, key=lambda r: r["doc_id"])]
    assert order == sorted(order)


def test_sharding_without_ids(raw_spark):
    """Texts without a doc_id are atoms of their own."""
    rows = [(None, f"{i:03}" * 40) for i in range(60)] * 2 + [(5, "a")]
    got = sharding.sharded(raw_spark.createDataFrame(rows, "doc_id long, text string"), 4).collect()
    filled, of = collections.Counter(), collections.defaultdict(set)
    for r in got:
        filled[r["shard"]] += r["size"]
        of[r["text_crc32"]].add(r["shard"])
    assert len(got) == 121 and max(filled.values()) <= 15 * 242 + 2 and all(len(s) == 1 for s in of.values())


def test_likeness_is_that_of_the_fingerprints(raw_spark):
    documents = raw_spark.read.parquet(f"{FOLDER}/documents.parquet")
    got = sorted(imatch.edited_fingerprints(documents).collect(), key=lambda r: -r["doc_id"])

    def likeness(one, other):
        pairs = [(a, b) for a, b in zip(one.split(), other.split(), strict=True) if (a, b) != ("-1", "-1")]
        return sum(a == b for a, b in pairs) / len(pairs) if pairs else 1.0

    for r, following in zip(got, got[1:] + got[:1], strict=True):
        assert math.isclose(r["near_edited"], likeness(r["fingerprint"], r["edited_fingerprint"]))
        assert math.isclose(r["near_next"], likeness(r["fingerprint"], following["fingerprint"]))


def test_edited_fingerprints(docs):
    rows = [(i, t or "") for i, t in rows_of_text()][::-1]
    got = by_id(imatch.edited_fingerprints(docs))
    for (i, text), (_, following) in zip(rows, rows[1:] + rows[:1], strict=True):
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        assert got[i]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= got[i]["near_next"] <= 1 and got[i]["n_chars"] == len(text)
    assert got[5]["fingerprint"] == got[6]["fingerprint"] and got[0]["fingerprint"] == got[1]["fingerprint"]


def test_fingerprints_of_a_third_alike(raw_spark):
    """Near copies in a third of the rows are beyond the lexicon's band, and still alike."""
    random.seed(11)
    base = [f"t{k}" for k in range(60)]
    rows = []
    for i in range(450):
        own = list(base) if i % 9 < 3 else [f"v{random.randrange(2000)}" for _ in range(60)]
        for _ in range(3 if i % 9 < 3 else 0):
            own[random.randrange(60)] = f"n{random.random()}"
        rows.append((i, " ".join(own)))
    rows += [(450 + i, f"{text} tail") for i, text in enumerate(["rare1 rare2 rare3 rare4 rare5 rare6 rare7"] * 2)]
    got = by_id(imatch.edited_fingerprints(raw_spark.createDataFrame(rows, "doc_id long, text string")))
    ratio = lambda a, b: len(set(a.split()) & set(b.split())) / len(set(a.split()) | set(b.split()))
    near, real = collections.defaultdict(list), collections.defaultdict(list)
    for i, text in rows[1:450]:
        following = rows[i - 1][1]
        half = len(text) // 2
        # Copies before another copy or before another text; other texts, which have lexicon terms.
        kind = ["mixed", "copies", "copies", "turn"][min(i % 9, 3)] if i % 9 < 4 else "others"
        near[kind].append((got[i]["near_edited"], got[i]["near_next"]))
        real[kind].append((ratio(text, text[: len(text) - half] + following[:half]), ratio(text, following)))
    near, real = ({k: np.mean(v, 0) for k, v in x.items()} for x in (near, real))
    assert 0.6 * real["copies"][1] <= near["copies"][1] <= real["copies"][1] + 0.05
    assert near["mixed"][0] >= 0.7 * near["others"][0]  # as for texts in the lexicon with the same overlap
    assert near["copies"][0] >= near["others"][0]
    assert near["mixed"][1] < 0.05 and near["turn"][1] < 0.05
    assert got[451]["near_next"] == 1 and len(set(got[451]["fingerprint"].split())) > 5


@pytest.mark.parametrize("weights", [[3.0, 2.0], [1.0, 4.0, 0.5, 2.0, 2.5]])
def test_maximal_segments(weights):
    at = [3 * k for k in range(len(weights))]
    found = toxicity.maximal_segments(at, weights, 0.6)
    scores = [-0.6] * (at[-1] + 1)
    for k, w in zip(at, weights, strict=True):
        scores[k] = w
    best = max(sum(scores[a : b + 1]) for a in range(len(scores)) for b in range(a, len(scores)))
    assert math.isclose(max(s for *_, s in found), best)
    assert all(math.isclose(sum(scores[a : b + 1]), s) for a, b, s in found)


def test_toxicity(raw_spark, docs):
    random.seed(5)
    calm = [f"calm{k}" for k in range(300)]
    rows = [(i, " ".join(random.choices(calm, k=60) + (["vile", "nasty"] if i % 4 == 0 else []))) for i in range(400)]
    table = raw_spark.createDataFrame(rows, "doc_id long, text string")
    labels = raw_spark.createDataFrame([(i, int(i % 4 == 0)) for i, _ in rows], "doc_id long, toxic int")
    got = by_id(toxicity.scored(table, toxicity.fit(table, labels)))
    held = [i for i, _ in rows if zlib.crc32(str(i).encode()) % 5 == 0]
    assert {i for i, r in got.items() if r["held_out"]} == set(held)
    assert np.mean([got[i]["predicted"] == (i % 4 == 0) for i in held]) > 0.97
    empty = toxicity.fit(docs, labels.where("false"))
    assert all(0 <= r["score"] < 0.5 for r in toxicity.scored(docs, empty).collect())


def test_toxicity_threshold_does_not_follow_the_sample(raw_spark):
    """A bound that thins only the clean class leaves the threshold where all labels put it."""
    random.seed(6)
    calm = [f"calm{k}" for k in range(300)]
    rows = []
    for i in range(8000):
        words = random.choices(calm, k=60)
        if i % 20 == 0 or random.random() < 0.2:  # four times as many clean texts with the word as toxic ones
            words[random.randrange(60)] = "vile"
        rows.append((i, " ".join(words), int(i % 20 == 0)))
    table = raw_spark.createDataFrame(rows, "doc_id long, text string, toxic int").persist()
    for bound in (20_000, 800):
        got = toxicity.scored(table, toxicity.fit(table, table, per_class=bound, least_weight=1.0))
        score = got.join(table.where("text LIKE '%vile%'"), "doc_id").agg(F.min("score"), F.max("score")).first()
        assert 0.1 < score[0] <= score[1] < 0.35, (bound, score)


def test_katz(docs):
    texts = {i: [*WORD.findall(lower(t)), None] for i, t in rows_of_text()}
    held = {i: zlib.crc32(str(i).encode()) % 10 == 0 for i in texts}
    train = [w for i, w in texts.items() if not held[i]]
    uni = collections.Counter(w for x in train for w in x)
    bi = collections.Counter(p for x in train for p in zip([0, *x], x, strict=False))
    total = sum(uni.values())
    d1, d2 = (katz.discounts([sum(v == r for v in c.values()) for r in range(1, 7)]) for c in (uni, bi))
    rest = 1 - sum(d1[min(c, 6)] * c / (total + 0.5) for c in uni.values())
    word = lambda w: d1[min(uni[w], 6)] * uni[w] / (total + 0.5) if uni[w] else rest
    count = lambda h: uni[None] if h == 0 else uni[h]
    pair = lambda h, w: d2[min(bi[h, w], 6)] * bi[h, w] / (count(h) + 0.5)

    def weight(h):
        after = [w for g, w in bi if g == h]
        return (1 - sum(pair(h, w) for w in after)) / (1 - sum(map(word, after)))

    for h in list(uni)[:20]:  # probabilities after a word, unknown words included, sum to 1
        if h is not None:
            seen = {w for g, w in bi if g == h}
            others = sum(word(w) for w in uni if w not in seen) + rest
            assert math.isclose(sum(pair(h, w) for w in seen) + weight(h) * others, 1)
    got = by_id(katz.scored(docs))
    for i, words in texts.items():
        score = sum(
            math.log10(pair(h, w) if bi[h, w] else word(w) * (weight(h) if count(h) else 1))
            for h, w in zip([0, *words], words, strict=False)
        )
        base = sum(math.log10((uni[w] + 0.1) / (total + 0.1 * (len(uni) + 1))) for w in words)
        assert math.isclose(got[i]["score"], score, rel_tol=1e-9) and math.isclose(got[i]["base_score"], base, rel_tol=1e-9)
        assert (got[i]["n_tokens"], got[i]["train_tokens"]) == (len(words), total)


def test_packing(docs):
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(BYTE_BPE)
    got = packing.packed(docs, BYTE_BPE, 64, with_ids=True).collect()
    for i, text in rows_of_text():
        ids = [*model.encode(text or "", add_special_tokens=False).ids, 0]
        own = sorted((r for r in got if r["doc_id"] == i), key=lambda r: r["piece"])
        assert [x for r in own for x in r["ids"]] == ids and all(r["length"] == 64 for r in own[1:])
        assert all(r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4")) for r in own)
    by_sequence = collections.defaultdict(list)
    for r in got:
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
    for own in by_sequence.values():
        ends = np.cumsum([n for _, n in sorted(own)])
        assert [a for a, _ in sorted(own)] == [0, *ends[:-1]] and ends[-1] <= 64


def test_best_fit_plan_places_every_piece_once():
    random.seed(2)
    lengths = [random.randrange(1, 101) for _ in range(3000)]
    counts = collections.Counter(lengths)
    filled, ranks = collections.Counter(), collections.defaultdict(list)
    for length, first, n, sequence, offset in packing.best_fit_plan(counts, 100):
        ranks[length] += range(first, first + n)
        for s in range(sequence, sequence + n):
            assert filled[s] == offset
            filled[s] += length
    assert all(sorted(ranks[k]) == list(range(n)) for k, n in counts.items()) and max(filled.values()) <= 100
    assert len(filled) <= 1.02 * sum(lengths) / 100 + 1


def test_sentence_pieces(docs):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=PIECE_BPE)
    found = pieces.encoded(docs, PIECE_BPE, with_ids=True)
    got = by_id(found)
    for i, text in rows_of_text():
        row = got[i]
        assert row["ids"] == model.encode(text or "") and row["parity"] and row["round_trip"]
    back = by_id(pieces.decoded(found, PIECE_BPE))
    assert all(back[i]["text"] == (t or "") for i, t in rows_of_text())


def test_unigram_pieces():
    made = pieces.build(pieces.PieceModel(
        [("<unk>", 0.0, 2), ("▁", -3.0, 1), ("▁ab", -1.0, 1), ("a", -4.0, 1), ("b", -4.0, 1), ("c", -4.0, 1)], collapse=False
    ))
    assert made.encode("ab cab").tokens == ["▁ab", "▁", "c", "a", "b"]


def test_nearest(raw_spark):
    random_ = np.random.default_rng(0)
    x = random_.normal(size=(600, 8)).astype(np.float32)
    x[300:400] = x[7]
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    bad = [(900, None), (950, [0.0] * 8), (1000, [math.nan] * 8), (1050, [1.0, None] * 4), (1100, [1.0]), (None, [1.0] * 8)]
    frame = raw_spark.createDataFrame(rows + bad, "vec_id long, embedding array<float>")
    got = collections.defaultdict(list)
    for r in vectors.nearest(frame, per_list=16).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["vec_id"], r["score"]))
    unit = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    hits = 0
    for q in range(0, 600, 50):
        score = unit @ unit[q]
        score[q] = -2
        best = np.lexsort((np.arange(600), -score.round(12)))[:5]
        hits += len({int(b) for b in best} & {v for v, _ in got[q]})
        assert len(got[q]) == 5 and all(abs(score[v] - s) < 1e-12 for v, s in got[q])
    assert got.keys() == set(range(0, 600, 50)) and hits >= 0.9 * 60
    assert [v for v, _ in got[350]] == [7, 300, 301, 302, 303]


@pytest.mark.parametrize("ratio", [1.0, math.inf])
def test_nearest_of_few_and_exactly(raw_spark, ratio):
    """An infinite ratio is brute force on doubles, and lists too short for k read on."""
    random_ = np.random.default_rng(1)
    x = random_.normal(size=(120, 4)) * (1 + 1e-12)
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(3, x[3].tolist())]
    frame = raw_spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("score", F.lit("clash"))
    got = collections.defaultdict(list)
    for r in vectors.nearest(frame, per_list=2, ratio=ratio).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["vec_id"], r["score"]))
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    for q in (0, 50, 100):
        score = unit @ unit[q]
        assert len(got[q]) == 5 and all(abs(score[v] - s) < 1e-14 for v, s in got[q])
        if ratio == math.inf:
            score[q] = -2
            assert [v for v, _ in got[q]] == np.argsort(-score)[:5].tolist()
    assert vectors.nearest(frame.where("vec_id < 3")).count() == 2


def test_centroids_within_a_ratio():
    random_ = np.random.default_rng(2)
    unit = vectors._unit(random_.normal(size=(2000, 8)))
    graph, asked = vectors.fit(unit, 8), unit[:100]
    far = np.maximum(2 - 2 * asked @ graph.centroids.T, 0)
    true = far <= 1.6**2 * far.min(1, keepdims=True)
    got = graph.within(asked, 1.6)
    assert (got & true).sum() >= 0.99 * true.sum()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(name, raw_spark):
    database = duckdb.connect()
    database.execute(f"CREATE VIEW documents AS SELECT * FROM '{FOLDER}/documents.parquet'")
    frame = QUERIES[name](raw_spark, FOLDER)
    relation = database.sql(ORACLES[name]).select(*frame.columns)
    assert sorted(map(tuple, frame.collect())) == sorted(relation.fetchall())


def test_empty_tables(raw_spark, docs):
    none = docs.where("false")
    labels = raw_spark.createDataFrame([], "doc_id long, toxic int")
    for frame in (
        substring.repeated_spans(none), lines.clean_lines(none), superminhash.near_duplicates(none),
        sharding.sharded(none), imatch.edited_fingerprints(none), katz.scored(none), packing.packed(none, BYTE_BPE),
        pieces.encoded(none, PIECE_BPE), toxicity.scored(none, toxicity.fit(none, labels)),
        vectors.nearest(raw_spark.createDataFrame([], "vec_id long, embedding array<float>")),
    ):
        assert frame.count() == 0


def test_null_ids_and_repeated_rows(raw_spark, docs):
    odd = docs.unionByName(docs.where("doc_id < 8")).unionByName(docs.where("doc_id < 8").withColumn("doc_id", F.lit(None).cast("long")))
    n = odd.count()
    for frame in (
        substring.repeated_spans(odd), lines.clean_lines(odd), superminhash.near_duplicates(odd), sharding.sharded(odd),
        imatch.edited_fingerprints(odd), katz.scored(odd), pieces.encoded(odd, PIECE_BPE),
        packing.packed(odd, BYTE_BPE, 1 << 20),
    ):
        assert frame.count() == n


def test_pipeline(raw_spark):
    kept = raw_spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns = kept.columns
    for _, stage in corpus_pipeline.STAGES[:-1]:
        before, kept = kept, stage(raw_spark, kept, FOLDER).cache()
        assert kept.columns == columns and kept.count() <= before.count()
    assert kept.select("doc_id").distinct().count() == kept.count()
    packed_ids = {r[0] for r in corpus_pipeline.STAGES[-1][1](raw_spark, kept, FOLDER).select("doc_id").collect()}
    assert packed_ids == {r[0] for r in kept.select("doc_id").collect()}

