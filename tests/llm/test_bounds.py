"""Work and memory that must not grow faster than the input."""

import itertools
import random
import tracemalloc

import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer

from tierstream.llm import packing, phrases, superminhash, vectors
from tierstream.llm.chunks import ChunkEncoder, id_bytes
from tierstream.llm.queries import BYTE_BPE


def test_new_chunks_are_encoded_together():
    """The ids of whole texts, from far fewer texts than there are chunks."""
    model, asked = Tokenizer.from_file(BYTE_BPE), []
    pick = random.Random(5)
    words = ["né", "word", "It's", "été,", "日本", "áb", "x\x7f", "\x80", "10.000", "<|endoftext|>", "😀", "É", "don't", " ", "ç"]
    gaps = [" ", "  ", "\n", "\r\n", " \r", "\t\n ", "\r", " \x0b", ""]
    texts = ["".join(pick.choice(gaps) + pick.choice(words) + str(pick.randrange(400)) * pick.randrange(2) for _ in range(40)) for _ in range(300)]
    texts += ["", " ", "\r", "no space", "ends  \n", "\n\n", *(a + b for a, b in itertools.product(words, gaps))]

    def encode(strings):
        asked.extend(strings)
        return [e.ids for e in model.encode_batch_fast(strings, add_special_tokens=False)]

    encoder = ChunkEncoder(encode, id_bytes=id_bytes(model))
    ids, cuts = encoder(pa.array(texts))
    for text, a, b in zip(texts, cuts[:-1], cuts[1:], strict=True):
        assert ids[a:b].tolist() == model.encode(text, add_special_tokens=False).ids, repr(text)
    assert len(asked) < len(encoder.keys) / 2


def test_packing_uses_it():
    assert packing._encoder(BYTE_BPE)._id_bytes is not None


def test_word_sequence_memory():
    """At most 18 bytes for each byte of a shard's text; arrays of eight per letter add up to more."""
    text = " ".join(f"word{i % 5000} other" for i in range(150_000))
    part = pa.array([text[i : i + 4000] for i in range(0, len(text), 4000)], pa.large_string())
    tracemalloc.start()
    sequence, words = phrases.word_sequence(part)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(words) > 5000 and len(sequence) > 300_000
    assert peak < 18 * len(text)


def test_only_the_best_nodes_meet_their_members(spark):
    """Ids are looked up for k + 1 nodes of a query, however many lists it reads; ties as by brute force."""
    random_ = np.random.default_rng(3)
    x = random_.integers(-2, 3, (400, 4)).astype(np.float32)
    x[(x == 0).all(1)] = 1
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    found = vectors.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), per_list=16, ratio=float("inf"))
    got = {}
    for r in found.collect():
        got.setdefault(r["query_id"], {})[r["rank"]] = (r["vec_id"], r["score"])
    y = x.astype(np.float64)
    norms = np.linalg.norm(y, axis=1)
    for q in range(0, 400, 50):
        score = y @ y[q] / (norms * norms[q])
        wanted = sorted((round(-s, 9), i) for i, s in enumerate(score) if i != q)[:5]
        assert [(round(-got[q][n][1], 9), got[q][n][0]) for n in range(1, 6)] == wanted


def test_ids_are_looked_up_after_ranking(spark):
    found = spark.range(1000).selectExpr("id % 2 AS query", "id AS node", "CAST(id % 10 AS DOUBLE) AS score")
    members = spark.range(1000).selectExpr("id AS node", "id AS vec_id").unionByName(
        spark.createDataFrame([(9, 2000), (19, 2001)], "node long, vec_id long")
    )
    best = vectors._best_ids(found, members, 2)
    assert "Window" in best._jdf.queryExecution().executedPlan().toString().split("Join", 1)[1]
    assert sorted(map(tuple, best.where("query = 1").select("n", "vec_id").collect())) == [(1, 9), (2, 19), (3, 29)]


def test_crowd_without_links_stays_out_of_blocks(spark, monkeypatch):
    """Of many texts alike, those whose common elements are too few for a link meet no block; groups as by brute force."""
    random_ = random.Random(11)
    texts = []
    for n in range(240):
        own = [f"w{k}" for k in range(120)]
        for _ in range(random_.choice([1, 2] if n % 4 == 0 else [4, 5, 6, 9])):
            own[random_.randrange(120)] = f"n{random_.randrange(40)}"
        texts.append(" ".join(own))
    blockwise, met = superminhash._blockwise, []

    def spy(members, *rest):
        met.append(members.select("node").distinct().count())
        return blockwise(members, *rest)

    monkeypatch.setattr(superminhash, "_blockwise", spy)
    monkeypatch.setattr(superminhash, "_CROWDED", 2)
    monkeypatch.setattr(superminhash, "_ELEMENTS", 5_000, raising=False)
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in superminhash.near_duplicates(frame).collect()}
    words = [t.split() for t in texts]
    sets = [{tuple(w[k : k + 5]) for k in range(len(w) - 4)} for w in words]
    links = [(a, b) for a, b in itertools.combinations(range(240), 2) if 7 * len(sets[a] & sets[b]) >= 3 * (len(sets[a]) + len(sets[b]))]
    root = list(range(240))
    for _ in range(240):
        before = list(root)
        for a, b in links:
            root[a] = root[b] = min(root[a], root[b])
        if root == before:
            break
    assert got == dict(enumerate(root))
    alone = sum(root.count(r) == 1 for r in root)
    assert alone > 100 and met[0] < 240 - alone / 2


def test_search_rows_do_not_grow_with_lists(spark, monkeypatch):
    """Twelve times the lists, all read: no more rows of a query from the search; blocks give the same neighbours."""
    random_ = np.random.default_rng(4)
    rows = [(i, v.tolist()) for i, v in enumerate(random_.normal(size=(1500, 6)))]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    blocks, made = vectors._blocks, []

    def spy(*given):
        found = blocks(*given)
        made.append(found.count())
        return found

    monkeypatch.setattr(vectors, "_blocks", spy)
    monkeypatch.setattr(vectors, "_SHELVES", 4, raising=False)
    results = [
        {(r["query_id"], r["rank"]): (r["vec_id"], round(r["score"], 12)) for r in vectors.nearest(frame, ratio=float("inf"), **given).collect()}
        for given in ({"per_list": 120}, {"per_list": 10}, {"per_list": 10, "block": 100})
    ]
    assert made[1] <= 30 * 4 * 6 and len(results[0]) == 150
    assert results[0] == results[1] == results[2]
