"""Transducer, fill-in-middle and phrases against the library and brute force."""

import collections
import hashlib
import random
import re
import sys
from array import array

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tierstream.llm import infill, phrases, transducer
from tierstream.llm.queries import BYTE_BPE, QUERIES

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, n long, ids string, shard string, word string, output string"


def texts():
    rnd = random.Random(11)
    bits = ["a", "the", "'s", "'l", "'re", " ", "  ", "\n", "\t", "12", "!", "...", "é", "中", "ß", "<|endoftext|>",
            "<|endo", "AB", "՘", "࢏", "\U00010940", " ", "\U0001f600", "\x1c", "\x85", "'", "<", "P>"]
    found = [None, "", " ", "one", "a <P> b", "<S><M>", "Hi, there", "x" * 9000 + "'s", " " * 9000 + "y", "é" * 5000,
             "same words here", "same words here", "$1 \\1 (.*) {2}+", "<" * 40, "\n".join("ab" * 3 for _ in range(400))]
    return found + ["".join(rnd.choice(bits) for _ in range(rnd.randrange(80))) for _ in range(60)]


def rows():
    found = [(i, t, None if i % 4 == 0 else "en", 7, "x", "y", "z", "o") for i, t in enumerate(texts())]
    return found + [(None, "no id", "en", 1, None, None, None, None), (3, "one", "en", 1, None, None, None, None)]


@pytest.fixture(scope="module")
def docs(raw_spark):
    """Nulls, empty, long and equal texts, a repeated row, and columns named like inner ones."""
    return raw_spark.createDataFrame(rows(), SCHEMA).persist()


@pytest.fixture(scope="module")
def nothing(raw_spark):
    return raw_spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def bpe():
    return transducer.ByteBpe(BYTE_BPE), Tokenizer.from_file(BYTE_BPE)


def streamed(model, text, step):
    encoder, out = transducer.StreamEncoder(model), []
    at = 0
    while at < len(text):
        size = step()
        out += encoder.feed(text[at : at + size])
        at += size
    return out + encoder.finish()


def test_stream_gives_the_ids_of_the_whole_text(bpe):
    model, library = bpe
    rnd = random.Random(2)
    for text in texts():
        ids = library.encode(text or "", add_special_tokens=False).ids
        for step in (lambda: 1, lambda: rnd.randrange(1, 9), lambda: 1 << 30):
            assert streamed(model, text or "", step) == ids
        decoder = transducer.StreamDecoder(model)
        assert "".join(decoder.feed([i]) for i in ids) + decoder.finish() == (text or "")


def test_lookahead_suffices_and_memory_is_bounded(bpe):
    model, library = bpe
    rnd = random.Random(4)
    for letters in ("abcdefghijklmnopqrstuvwxyz", "etaoin", "0123456789", "ab", "=-*"):
        run = "".join(rnd.choice(letters) for _ in range(60_000))
        encoder, out, held = transducer.StreamEncoder(model), [], 0
        for at in range(0, len(run), 700):
            out += encoder.feed(run[at : at + 700])
            held = max(held, len(encoder._held) + len(encoder._tail) + len(encoder._window))
        assert out + encoder.finish() == library.encode(run, add_special_tokens=False).ids
        assert held < 20_000
    # Tokens that end the lookahead or more before the end stay, whatever follows.
    for _ in range(200):
        text = "".join(rnd.choice("etaoinshr") for _ in range(600))
        cut = rnd.randrange(400, 600)
        short, long = model.ids(text[:cut].encode()), model.ids(text.encode())
        done = 0
        for a, b in zip(short, long):
            done += len(model.bytes_of[a])
            if done > cut - model.lookahead:
                break
            assert a == b


def test_any_ids_decode_like_the_library(bpe):
    model, library = bpe
    rnd = random.Random(3)
    for _ in range(300):
        ids = [rnd.randrange(50_400) for _ in range(rnd.randrange(8))]
        decoder = transducer.StreamDecoder(model)
        assert "".join(decoder.feed([i]) for i in ids) + decoder.finish() == library.decode(ids, skip_special_tokens=False)


def test_pre_tokens_of_every_code_point(bpe):
    model, library = bpe
    chars = [chr(c) for c in range(1, 0x110000) if not 0xD800 <= c < 0xE000]
    for low in range(0, len(chars), 20_000):
        text = "".join(f"a{c}1{c}!{c}  {c}{c} x" for c in chars[low : low + 20_000])
        assert model.strict_cut.findall(text) == [text[a:b] for _, (a, b) in library.pre_tokenizer.pre_tokenize_str(text)]


def test_merges_out_of_order_are_refused():
    with pytest.raises(ValueError):
        transducer.ByteBpe._check([("ab", "c"), ("a", "b")], {"a": 0, "b": 1, "c": 2})


def test_coded(docs, nothing, bpe):
    found = transducer.coded(docs, BYTE_BPE)
    got = sorted(map(tuple, found.collect()), key=str)
    want = []
    for i, text, *_ in rows():
        ids = array("I", bpe[1].encode(text or "", add_special_tokens=False).ids)
        want.append((i, bytearray(ids.tobytes()), text or ""))
    assert sys.byteorder == "little" and got == sorted(want, key=str)
    assert sorted(r["text"] for r in transducer.decoded(found, BYTE_BPE).collect()) == sorted(t or "" for _, t, *_ in rows())
    assert transducer.coded(nothing, BYTE_BPE).count() == 0


def test_transducer_query(raw_spark, bpe):
    got = {r["doc_id"]: r for r in QUERIES["op11_bpe_transducer"](raw_spark, FOLDER).collect()}
    docs = raw_spark.read.parquet(f"{FOLDER}/documents.parquet").collect()
    assert len(got) == len(docs)
    for doc in docs:
        ids = bpe[1].encode(doc["text"] or "", add_special_tokens=False).ids
        text = bpe[1].decode(ids, skip_special_tokens=False)
        assert tuple(got[doc["doc_id"]])[1:] == (
            len(ids), hashlib.sha256(array("I", ids).tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest(),
        )


def test_infill(docs, nothing):
    unit = re.compile("[A-Za-z]+|[^A-Za-z]")
    found = infill.transformed(docs).withColumn("restored", infill.restored(F.col("output"), F.col("form")))
    got = sorted((tuple(r) for r in found.collect()), key=str)
    want = []
    for i, text, *_ in rows():
        text = text or ""
        units = unit.findall(text)
        digits = hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest()
        h1, h2, h3, h4 = (int(digits[8 * k : 8 * k + 8], 16) for k in range(4))
        a, b = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
        pre, mid, suf = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
        if not text or re.search("<[PSM]>", text) or h3 % 100 >= 90:
            want.append((i, len(units), "plain", None, None, text, text))
        elif h4 % 100 < 20:
            want.append((i, len(units), "spm", len(pre), len(mid), f"<S>{suf}<P>{pre}<M>{mid}", text))
        else:
            want.append((i, len(units), "psm", len(pre), len(mid), f"<P>{pre}<S>{suf}<M>{mid}", text))
    assert got == sorted(want, key=str)
    assert {w[2] for w in want} == {"plain", "psm", "spm"}
    assert infill.transformed(nothing).count() == 0


def test_infill_of_a_very_long_text(raw_spark):
    long = raw_spark.range(40).selectExpr("id AS doc_id", "repeat('ab 1. \U0001f600', 100000) AS text")
    found = infill.transformed(long).withColumn("same", infill.restored(F.col("output"), F.col("form")) == F.repeat(F.lit("ab 1. \U0001f600"), 100000))
    got = found.groupBy("form").agg(F.min("n").alias("n"), F.bool_and("same").alias("same")).collect()
    assert {r["form"] for r in got} == {"plain", "psm", "spm"}
    assert all(r["n"] == 600_000 and r["same"] for r in got)


def brute_phrases(rows, least=10, contained=50, limit=2000):
    counts = collections.defaultdict(collections.Counter)
    for lang, text in rows:
        low = (text or "").translate({c: c + 32 for c in range(65, 91)})
        for piece in re.split(r"[.,;:!?\n-\r]", low):
            words = re.findall(r"[^ \t]+", piece)
            for size in (1, 2, 3):
                counts[lang or "und"].update(tuple(words[i : i + size]) for i in range(len(words) - size + 1))
    out = []
    for lang, f in counts.items():
        n = sum(c for p, c in f.items() if len(p) == 1)
        found = []
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        covered = set()
        for p, a in candidates.items():
            if len(p) == 3:
                covered |= {q for q in (p[:2], p[1:]) if 100 * a >= contained * f[q]}
        for p, a in candidates.items():
            if p in covered:
                continue
            cuts = [(1_000_000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            found.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(found)[:limit], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, n, -score))
    return sorted(out)


def test_phrases(raw_spark, nothing):
    rnd = random.Random(9)
    words = [f"w{i}" for i in range(12)] + ["É", "é", "zz", "中", "a-b", "<x>"]
    made = []
    for i in range(500):
        text = "".join(rnd.choice(words) + rnd.choice([" ", " ", " ", "\t ", ". ", "!\n", ",\x0b"]) for _ in range(rnd.randrange(40)))
        text = text.replace("w1 ", "New York City ") if i % 3 else text
        made.append((i, text if i % 17 else None, [None, "en", "en", "und"][i % 4]))
    made += [(900, "Only. single! words, here?", "one"), (901, "", "empty"), (None, "a a a a a a a a a a a a a", "en")]
    made += [(902, "the same sentence again " * 30, "fr")] * 3
    docs = raw_spark.createDataFrame([(*row, 1, "x", "y", "z", "o") for row in made], "doc_id long, text string, lang string, shard int, word string, a string, score string, phrase string")
    want = brute_phrases([(lang, text) for _, text, lang in made])
    assert len(want) > 100 and {w[0] for w in want} == {"en", "fr", "und"}
    for size in (16_000_000, 300):  # one shard, and very many
        got = phrases.collocations(docs.repartition(3), shard_bytes=size)
        assert sorted(map(tuple, got.collect())) == want
    few = phrases.collocations(docs, least=3, contained_percent=80, limit=7)
    assert sorted(map(tuple, few.collect())) == brute_phrases([(x, t) for _, t, x in made], 3, 80, 7)
    assert phrases.collocations(nothing).count() == 0


def test_extensions_on_both_sides():
    rnd = random.Random(1)
    texts = ["".join(rnd.choice(["a ", "b ", "c ", "d. "]) for _ in range(60)) for _ in range(30)]
    sequence, words = phrases.word_sequence(pa.array(texts))
    counts = np.bincount(sequence, minlength=len(words) + 1)[1:]
    index = phrases.Index(counts, phrases.transform(sequence, 3), phrases.transform(sequence[::-1], 3))
    single = index.single_words()
    pairs = index.extended_left(single)
    want = collections.Counter((a, b, c) for a, b, c in zip(sequence, sequence[1:], sequence[2:]) if a and b and c)
    for found in (index.extended_left(pairs), index.extended_right(pairs), index.extended_right(index.extended_right(single))):
        assert dict(zip(map(tuple, found.words.T.tolist()), found.size.tolist(), strict=True)) == dict(want)
    left, right = index.extended_left(pairs), index.extended_right(pairs)
    by_place = dict(zip(left.low.tolist(), map(tuple, left.words.T.tolist()), strict=True))
    assert by_place == dict(zip(right.low.tolist(), map(tuple, right.words.T.tolist()), strict=True))
