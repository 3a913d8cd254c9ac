"""Byte-pair encoding as a stream: text goes in piece by piece, ids come out once they are
final, and memory does not grow with the text.

Merges are applied by rank, so more text to the right can change tokens to the left. How far
follows from the merge list. Compare a text with the same text continued: both have the same
tokens up to some front. The front moves left only when a merge (u, v) takes place in one of
them with u the last common token; then u's place is where they differ, and the next such
merge (u', v') has a higher rank and a v' that begins with the token u, that is, u is on the
left edge of v's merge tree. The longest chain of this kind, in bytes, is the *lookahead*
that suffices: a token that ends so far before the end of what was read is final. For the
50,000 merges of a common byte-level vocabulary it is 320 bytes.

A pre-token that has ended needs no lookahead, for merges do not cross its end. Pre-tokens
of usual length are remembered with their ids, up to a fixed number of them. Decoding turns
each id into its bytes and feeds them to an incremental UTF-8 decoder, which holds back an
unfinished character only.

Null text is empty: no ids. Null doc_id and repeated rows are encoded like others; further
columns, whatever their names, are ignored.
"""

from __future__ import annotations

import codecs
import functools
import heapq
import itertools
import json
import unicodedata
from array import array
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierstream.llm.superminhash import slices

_REMEMBERED = 200_000  # pre-tokens
_SHORT = 64  # bytes of a pre-token that is remembered
_LONG = 4_096  # characters from which a pre-token is encoded before it ends
_STEP = 8_192  # bytes of it that are encoded at once, besides the lookahead
_BLOCK = 65_536  # characters of a text read at once
_NONE = (2**62, 0)  # rank of a pair that is not merged
_NEWER_FROM = "԰"  # no letter, digit or space below this was added to Unicode of late

# Fixed value: how byte-level tokenizers cut text; letters and digits are put in below.
_PRE_TOKENS = r"'s|'t|'re|'ve|'m|'ll|'d| ?[{L}]+| ?[{N}]+| ?[^\s{L}{N}]+|\s+(?!\S)|\s+"


def _byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in a byte-level vocabulary: a printable byte for
    itself, the others for the code points from 256 on, in order."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class ByteBpe:
    """A byte-level BPE tokenizer read from a file of the tokenizers library."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, cutter = spec["model"], spec["pre_tokenizer"] or {}
        if model["type"] != "BPE" or cutter.get("type") != "ByteLevel" or not cutter.get("use_regex", True):
            raise ValueError("only byte-level BPE tokenizers with their usual pre-tokens are supported")
        if cutter.get("add_prefix_space") or spec["normalizer"] or model.get("ignore_merges"):
            raise ValueError("prefix spaces, normalizers and whole-word tokens are not supported")
        letters = _byte_letters()
        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in spec["added_tokens"]):
            raise ValueError("added tokens that depend on their surroundings are not supported")
        vocabulary = model["vocab"]
        self.bytes_of = {i: bytes(letters[c] for c in token) for token, i in vocabulary.items()}
        self.bytes_of |= {i: content.encode() for content, i in self.specials.items()}
        self.byte_ids = [vocabulary[c] for c, _ in sorted(letters.items(), key=lambda x: x[1])]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self._check(merges, letters)
        self.lookahead = lookahead(merges)
        self.merges = {
            (vocabulary[a], vocabulary[b]): (rank, vocabulary[a + b]) for rank, (a, b) in enumerate(merges)
        }
        self.cut = regex.compile(_PRE_TOKENS.format(L=r"\p{L}", N=r"\p{N}"))
        self.runs = [regex.compile(f"[{c}]+") for c in (r"\p{L}", r"\p{N}", r"\s", r"^\s\p{L}\p{N}")]
        later = _later_characters(path)
        others = f"--[{later}]" if later else ""
        self.strict_cut = regex.compile(
            "(?V1)" + r"'s|'t|'re|'ve|'m|'ll|'d"
            + rf"| ?[\p{{L}}{others}]+| ?[\p{{N}}{others}]+| ?[^\s[\p{{L}}\p{{N}}{others}]]+|\s+(?!\S)|\s+"
        )
        self.strict_runs = [
            regex.compile(f"(?V1)[{c}]+")
            for c in (rf"\p{{L}}{others}", rf"\p{{N}}{others}", r"\s", rf"^\s[\p{{L}}\p{{N}}{others}]")
        ]
        self.newer = regex.compile(f"[{_NEWER_FROM}-\U0010ffff]")
        self.special = regex.compile(
            "|".join(regex.escape(s) for s in sorted(self.specials, key=len, reverse=True)) or r"(?!)"
        )
        self.longest_special = max(map(len, self.specials), default=1)
        self.known = _Known(self)

    @staticmethod
    def _check(merges: list[tuple[str, str]], letters: dict[str, int]) -> None:
        """Streaming relies on parts that are made before they are used, in one way each."""
        made = set(letters)
        for a, b in merges:
            if a not in made or b not in made or a + b in made:
                raise ValueError(f"the merge of {a!r} and {b!r} is out of order")
            made.add(a + b)

    def ids(self, data: bytes) -> list[int]:
        """The ids of a piece of text taken as one pre-token."""
        ids = [self.byte_ids[b] for b in data]
        return _merge_short(ids, self.merges) if len(ids) <= _SHORT else _merge_long(ids, self.merges)


class _Known(dict):
    """Ids of the pre-tokens met so far."""

    def __init__(self, model: ByteBpe):
        super().__init__()
        self._model = model

    def __missing__(self, piece: str) -> tuple[int, ...]:
        data = piece.encode()
        ids = tuple(self._model.ids(data))
        if len(data) <= _SHORT:
            if len(self) >= _REMEMBERED:
                self.clear()
            self[piece] = ids
        return ids


def lookahead(merges: list[tuple[str, str]]) -> int:
    """Bytes (letters of the merges) that must follow a token before it is final."""
    left = {a + b: a for a, b in merges}
    beyond: dict[str, int] = {}  # token u: the longest chain of later merges with u at the left edge of v
    longest = 0
    for a, b in reversed(merges):
        reach = len(a) + beyond.get(a, 0)
        longest = max(longest, reach)
        edge: str | None = b
        while edge is not None:
            beyond[edge] = max(beyond.get(edge, 0), reach)
            edge = left.get(edge)
    return longest


def _merge_short(ids: list[int], merges: dict) -> list[int]:
    """Merge by rank, of equal ranks the leftmost first."""
    get = merges.get
    found = [get(pair, _NONE) for pair in zip(ids, ids[1:])]
    while found and (best := min(found)) is not _NONE:
        i = found.index(best)
        ids[i : i + 2] = [best[1]]
        del found[i]
        if i:
            found[i - 1] = get((ids[i - 1], ids[i]), _NONE)
        if i < len(found):
            found[i] = get((ids[i], ids[i + 1]), _NONE)
    return ids


def _merge_long(ids: list[int], merges: dict) -> list[int]:
    """The same with a heap of (rank, place), for which n tokens cost n log n."""
    n = len(ids)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(*merges[pair], i) for i, pair in enumerate(zip(ids, ids[1:])) if pair in merges]
    heap = [(rank, i, made) for rank, made, i in heap]
    heapq.heapify(heap)
    while heap:
        rank, i, made = heapq.heappop(heap)
        j = after[i]
        if ids[i] < 0 or j >= n or merges.get((ids[i], ids[j])) != (rank, made):
            continue
        ids[i], ids[j] = made, -1
        after[i] = after[j]
        if after[j] < n:
            before[after[j]] = i
        for x, y in ((before[i], i), (i, after[i])):
            if x >= 0 and y < n and (found := merges.get((ids[x], ids[y]))):
                heapq.heappush(heap, (found[0], x, found[1]))
    return [i for i in ids if i >= 0]


def _later_characters(path: str) -> str:
    """Characters that are letters, digits or spaces to our patterns, but not to the
    tokenizer, which may know an older Unicode: asked about those that Python's own tables do
    not have yet. As ranges of a character set."""
    from tokenizers import Tokenizer

    cutter = Tokenizer.from_file(path).pre_tokenizer
    kinds = regex.compile(r"[\p{L}\p{N}\s]")
    new = [
        chr(c) for c in range(0x110000)
        if not 0xD800 <= c < 0xE000 and unicodedata.category(chr(c)) == "Cn" and kinds.match(chr(c))
    ]
    # Between two signs, what the tokenizer takes for a sign as well does not end the run.
    apart = [c for c in new if len(cutter.pre_tokenize_str(f"!{c}!")) == 1]
    ranges: list[list[int]] = []
    for c in map(ord, apart):
        if ranges and ranges[-1][1] == c - 1:
            ranges[-1][1] = c
        else:
            ranges.append([c, c])
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in ranges)


class StreamEncoder:
    """Text in pieces to ids. What is held back is bounded: a possible special token, the
    last pre-token, and of a very long one the bytes of its tokens that are not final."""

    def __init__(self, model: ByteBpe):
        self._model = model
        self._held = ""  # may hold the beginning of a special token
        self._tail = ""  # not yet cut into pre-tokens
        self._run: int | None = None  # the kind of a pre-token that is being encoded
        self._window = b""  # its bytes from the first token on that is not final

    def feed(self, text: str) -> list[int]:
        return self._read(text, False)

    def finish(self) -> list[int]:
        """The last ids; afterwards the encoder is as new."""
        return self._read("", True)

    def _read(self, text: str, last: bool) -> list[int]:
        model, out = self._model, []
        text = self._held + text
        at = 0
        while (found := model.special.search(text, at)) and (last or found.start() + model.longest_special <= len(text)):
            self._segment(text[at : found.start()], True, out)
            out.append(model.specials[found.group()])
            at = found.end()
        safe = len(text) if last else max(at, len(text) - model.longest_special + 1)
        self._segment(text[at:safe], last, out)
        self._held = text[safe:]
        return out

    def _segment(self, text: str, last: bool, out: list[int]) -> None:
        """More text without special tokens; ``last`` if none follows before one."""
        model = self._model
        text = self._tail + text
        self._tail = ""
        strict = model.newer.search(text) is not None
        cut, runs = (model.strict_cut, model.strict_runs) if strict else (model.cut, model.runs)
        if self._run is not None:
            text = self._go_on(text, runs, last, out)
        if not text:
            return
        pieces = cut.findall(text)
        held = ""
        if not last:
            # A pre-token is certain if two more characters are known behind it.
            while pieces and len(held) < 2:
                held = pieces.pop() + held
        out.extend(itertools.chain.from_iterable(map(model.known.__getitem__, pieces)))
        if len(held) > _LONG:
            *pieces, held = cut.findall(held)
            out.extend(itertools.chain.from_iterable(map(model.known.__getitem__, pieces)))
            self._run = next(k for k, run in enumerate(runs) if run.match(held[-1]))
            # Of white space, the last character may belong to what follows.
            sure = len(held) - (self._run == 2)
            self._extend(held[:sure], out)
            held = held[sure:]
        self._tail = held

    def _go_on(self, text: str, runs: list, last: bool, out: list[int]) -> str:
        """The rest of a long pre-token; returns the text behind it."""
        more = runs[self._run].match(text)
        end = more.end() if more else 0
        ends = last or end < len(text)
        if self._run == 2 and end and not (last and end == len(text)):
            end -= 1
        self._extend(text[:end], out)
        if ends:
            out.extend(self._model.ids(self._window))
            self._run, self._window = None, b""
            return text[end:]
        self._tail = text[end:]
        return ""

    def _extend(self, text: str, out: list[int]) -> None:
        """Bytes of the running pre-token; emits the tokens that have become final."""
        model = self._model
        data = self._window + text.encode()
        step = model.lookahead + _STEP
        while len(data) > step:
            done = 0
            for i in model.ids(data[:step]):
                size = len(model.bytes_of[i])
                if done + size > _STEP:
                    break
                out.append(i)
                done += size
            data = data[done:]
        self._window = data


class StreamDecoder:
    """Ids in pieces to text. Unknown ids are skipped; bytes that are no UTF-8 become
    replacement characters."""

    def __init__(self, model: ByteBpe):
        self._bytes_of = model.bytes_of
        self._text = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids: list[int]) -> str:
        return self._text.decode(b"".join(map(self._bytes_of.get, ids, itertools.repeat(b""))))

    def finish(self) -> str:
        """The last characters; afterwards the decoder is as new."""
        text = self._text.decode(b"", True)
        self._text.reset()
        return text


@functools.lru_cache(maxsize=1)  # what it remembers serves all tasks of a worker
def _model(path: str) -> ByteBpe:
    return ByteBpe(path)


def _coded(tokenizer: str, decode: bool):
    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, decoder = StreamEncoder(_model(tokenizer)), StreamDecoder(_model(tokenizer))
        for batch in batches:
            for low, high in slices(batch.column("text")):
                all_ids, texts = [], []
                for value in batch.column("text").slice(low, high - low):
                    text, ids, back = value.as_py() or "", array("I"), []
                    for at in range(0, len(text) + 1, _BLOCK):
                        more = encoder.feed(text[at : at + _BLOCK])
                        if at + _BLOCK > len(text):
                            more += encoder.finish()
                        ids.extend(more)
                        if decode:
                            back.append(decoder.feed(more))
                    all_ids.append(_little(ids))
                    if decode:
                        texts.append("".join(back) + decoder.finish())
                columns = [batch.column("doc_id").slice(low, high - low), pa.array(all_ids, pa.binary())]
                yield pa.RecordBatch.from_arrays(
                    columns + ([pa.array(texts, pa.string())] if decode else []),
                    names=["doc_id", "ids", *["decoded"] * decode],
                )

    return coded


def _little(ids: array) -> bytes:
    if array("I", [1]).tobytes()[0] == 0:
        ids.byteswap()
    return ids.tobytes()


def coded(docs: DataFrame, tokenizer: str, decode: bool = True) -> DataFrame:
    """doc_id, ids (little-endian unsigned 32-bit integers in a row) and, with ``decode``,
    the text that these ids stand for.

    ``tokenizer`` is a file of the tokenizers library that every executor can open. The texts
    are read where they lie; nothing is shuffled.
    """
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        _coded(tokenizer, decode), "doc_id long, ids binary" + ", decoded string" * decode
    )


def decoded(coded: DataFrame, tokenizer: str) -> DataFrame:
    """doc_id and text of rows of doc_id and ids."""

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = StreamDecoder(_model(tokenizer))
        for batch in batches:
            out = []
            for blob in batch.column("ids"):
                ids = array("I", blob.as_py() or b"")
                if array("I", [1]).tobytes()[0] == 0:
                    ids.byteswap()
                out.append(decoder.feed(ids.tolist()) + decoder.finish())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out, pa.string())], names=["doc_id", "text"])

    return coded.select(F.col("doc_id").cast("long").alias("doc_id"), "ids").mapInArrow(texts, "doc_id long, text string")
