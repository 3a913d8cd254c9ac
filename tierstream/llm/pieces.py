"""SentencePiece models run by the tokenizers library.

The model file is read as what it is, a protobuf message: pieces with scores and kinds, the
model type, byte fallback, and the normaliser's settings. From these a tokenizer of the
tokenizers library is built: character map and white-space rules, the marker for white
space, unigram scores or byte-pair merges in the order of their scores, byte fallback, and
the decoder. Texts are encoded in multithreaded batches.

If no piece has white space (carriage returns apart) after another character, texts are
encoded as words with the white space before them, each distinct one once. Each
distinct word is also encoded by the sentencepiece library and decoded again: ``parity``
says that all words of a text got the same ids from both, ``round_trip`` that the decoded
ids give the text back. Models whose normaliser changes characters or drops white space
are encoded text by text.

Null or empty text: no ids, parity and round trip hold. Null doc_id is kept. Other columns
are ignored.
"""

from __future__ import annotations

import functools
import os
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierstream.llm import blocks as B
from tierstream.llm.chunks import ChunkEncoder
from tierstream.llm.superminhash import slices

MARK = "▁"
# Fixed values of the model format: kinds of pieces, and model types.
_UNKNOWN, _CONTROL, _USER_DEFINED, _UNUSED, _BYTE = 2, 3, 4, 5, 6
_UNIGRAM, _BPE = 1, 2
_PARITY, _ROUND_TRIP = 1, 2


@dataclass
class PieceModel:
    pieces: list[tuple[str, float, int]] = field(default_factory=list)  # text, score, kind
    model_type: int = _UNIGRAM
    byte_fallback: bool = False
    char_map: bytes = b""
    add_prefix: bool = True
    collapse: bool = True

    @property
    def unknown(self) -> int:
        return next(i for i, p in enumerate(self.pieces) if p[2] == _UNKNOWN)

    def by_words(self) -> bool:
        """Whether texts may be encoded word by word."""
        crossing = any(
            a != MARK and not a.isspace() and (b == MARK or b in " \t\n\v\f")
            for text, _, kind in self.pieces if kind != _BYTE for a, b in zip(text, text[1:], strict=False)
        )
        return not (crossing or self.char_map or self.collapse or not self.add_prefix)


def _fields(message: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(field number, value) of a protobuf message, in order."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = message[at]
            at += 1
            value |= (byte & 0x7F) << shift
            shift += 7
            if byte < 0x80:
                return value

    while at < len(message):
        number, kind = divmod(varint(), 8)
        if kind == 0:
            yield number, varint()
            continue
        size = varint() if kind == 2 else {1: 8, 5: 4}[kind]
        yield number, message[at : at + size]
        at += size


def read_model(path: str) -> PieceModel:
    """The parts of a SentencePiece model file that encoding and decoding need."""
    model = PieceModel()
    with open(path, "rb") as file:
        content = file.read()
    for number, value in _fields(content):
        if number == 1:
            piece = dict(_fields(value))
            score = struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0
            model.pieces.append((piece.get(1, b"").decode(), score, piece.get(3, 1)))
        elif number == 2:
            trainer = dict(_fields(value))
            model.model_type = trainer.get(3, _UNIGRAM)
            model.byte_fallback = bool(trainer.get(35, 0))
        elif number == 3:
            normalizer = dict(_fields(value))
            model.char_map = normalizer.get(2, b"")
            model.add_prefix = bool(normalizer.get(3, 1))
            model.collapse = bool(normalizer.get(4, 1))
    return model


def build(model: PieceModel, prefix: bool | None = None):
    """A tokenizer of the tokenizers library; ``prefix`` overrides the model's own setting."""
    from tokenizers import Regex, Tokenizer, decoders, models, normalizers

    if model.model_type == _UNIGRAM:
        scored = [(t, s) for t, s, _ in model.pieces]
        made = Tokenizer(models.Unigram(scored, model.unknown, model.byte_fallback))
    elif model.model_type == _BPE:
        vocabulary = {text: i for i, (text, _, _) in enumerate(model.pieces)}
        usable = {t for t, _, kind in model.pieces if kind not in (_UNKNOWN, _CONTROL, _UNUSED, _BYTE)}
        merges = []
        for i, (text, score, _) in enumerate(model.pieces):
            if text in usable:
                for k in range(1, len(text)):
                    if text[:k] in usable and text[k:] in usable:
                        merges.append((-score, i, k, (text[:k], text[k:])))
        made = Tokenizer(models.BPE(
            vocabulary, [m[-1] for m in sorted(merges)], unk_token=model.pieces[model.unknown][0],
            fuse_unk=True, byte_fallback=model.byte_fallback,
        ))
    else:
        raise ValueError(f"model type {model.model_type} is neither unigram nor byte-pair")
    steps = [normalizers.Precompiled(model.char_map)] if model.char_map else []
    if model.collapse:
        steps += [normalizers.Strip(), normalizers.Replace(Regex(" {2,}"), " ")]
    if model.add_prefix if prefix is None else prefix:
        steps.append(normalizers.Prepend(MARK))
    made.normalizer = normalizers.Sequence([*steps, normalizers.Replace(" ", MARK)])
    undo = [decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse()]
    if model.add_prefix if prefix is None else prefix:
        undo.append(decoders.Strip(" ", 1, 0))
    made.decoder = decoders.Sequence(undo)
    return made


class _WholeTexts(ChunkEncoder):
    """As ChunkEncoder, for models that need to see whole texts."""

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        return self._whole(texts)


@functools.lru_cache(maxsize=1)  # what it has learned serves all tasks of a worker
def _encoder(path: str, threads: int) -> tuple[ChunkEncoder, bool]:
    """An encoder of texts, and whether they need a space in front."""
    os.environ.setdefault("RAYON_NUM_THREADS", str(threads))
    os.environ["TOKENIZERS_PARALLELISM"] = "true" if threads > 1 else "false"
    import sentencepiece

    model = read_model(path)
    other = sentencepiece.SentencePieceProcessor(model_file=path)
    words = model.by_words()
    made = build(model, prefix=False if words else None)

    def encode(strings: list[str]) -> list[list[int]]:
        return [e.ids for e in made.encode_batch_fast(strings, add_special_tokens=False)]

    def check(strings: list[str], ids: list[list[int]]) -> list[int]:
        back = made.decode_batch(ids, skip_special_tokens=False)
        same = [_ROUND_TRIP if a == b else 0 for a, b in zip(strings, back, strict=True)]
        if words:
            # The other library puts the marker in front of what it is given.
            odd = [i for i, s in enumerate(strings) if s[:1] != " " or s == " "]
            bare = [s[1:] if s[:1] == " " and s != " " else s for s in strings]
            ids = list(ids)
            for i, x in zip(odd, encode([" " + strings[i] for i in odd]), strict=True):
                ids[i] = x
            strings = bare
        theirs = other.encode(strings, num_threads=threads)
        return [s | (_PARITY if a == b else 0) for s, a, b in zip(same, ids, theirs, strict=True)]

    return (ChunkEncoder if words else _WholeTexts)(encode, check), words


def _encode(path: str, threads: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, spaced = _encoder(path, threads)
        for batch in batches:
            for low, high in slices(batch.column("text")):
                texts = batch.column("text").slice(low, high - low)
                ids, cuts = encoder(_with_space(texts) if spaced else texts)
                arrays = [
                    batch.column("doc_id").slice(low, high - low),
                    pa.array(np.diff(cuts), pa.int64()),
                    pa.array(
                        [zlib.crc32(ids[a:b].astype("<u4")) for a, b in zip(cuts[:-1], cuts[1:], strict=True)], pa.int64()
                    ),
                    pa.array((encoder.passed & _PARITY) > 0), pa.array((encoder.passed & _ROUND_TRIP) > 0),
                ]
                names = ["doc_id", "n_tokens", "ids_crc32", "parity", "round_trip"]
                if with_ids:
                    arrays.append(pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(ids.astype(np.int32))))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    return run


def _with_space(texts: pa.Array) -> pa.Array:
    """Each text that is not empty with a space in front."""
    data, offsets = B.utf8(texts)
    filled = np.diff(offsets) > 0
    shift = np.append(0, np.cumsum(filled))
    out = np.full(len(data) + int(shift[-1]), 0x20, np.uint8)
    out[np.arange(len(data)) + np.repeat(shift[1:], np.diff(offsets))] = data
    return pa.Array.from_buffers(
        pa.large_string(), len(texts), [None, pa.py_buffer((offsets + shift).tobytes()), pa.py_buffer(out.tobytes())]
    )


def encoded(docs: DataFrame, model: str, threads: int = 2, with_ids: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_crc32 (32-bit little-endian ids), parity, round_trip, and ``ids``
    if asked for. ``model`` is a file that every executor can open."""
    schema = "doc_id long, n_tokens long, ids_crc32 long, parity boolean, round_trip boolean"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        _encode(model, threads, with_ids), schema + (", ids array<int>" if with_ids else "")
    )


def decoded(encoded_docs: DataFrame, model: str) -> DataFrame:
    """doc_id and text of rows with doc_id and ids; null ids give a null text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = build(read_model(model))
        for batch in batches:
            ids = batch.column("ids").to_pylist()
            texts = made.decode_batch([x or [] for x in ids], skip_special_tokens=False)
            texts = [None if x is None else t for x, t in zip(ids, texts, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"]
            )

    return encoded_docs.select(F.col("doc_id").cast("long").alias("doc_id"), "ids").mapInArrow(run, "doc_id long, text string")
