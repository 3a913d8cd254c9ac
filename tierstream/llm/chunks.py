"""Token ids of whole texts from the ids of their distinct chunks.

A text is cut where white space (but a carriage return) follows a letter or sign, so a
chunk is a word with the white space before it. No pre-token and no merge of the tokenizers used here crosses such
a cut, so a text's ids are its chunks' ids in a row. Each distinct chunk is encoded once.
"""

from __future__ import annotations

import itertools
import json
from collections.abc import Callable

import numpy as np
import pyarrow as pa

from tierstream.llm import blocks as B

_KNOWN_AT_MOST = 400_000  # chunks; about 50 bytes each
_ENCODED_AT_ONCE = 4_096  # chunks; the library's results weigh a kilobyte or more each
_JOINED = 64  # chunks


def id_bytes(model) -> np.ndarray | None:
    """How many bytes of text each id of a tokenizer stands for; None if it does not take texts
    byte by byte as they are."""
    parts = json.loads(model.to_str())
    bytewise = parts["pre_tokenizer"] or {}
    if parts["normalizer"] or bytewise.get("type") != "ByteLevel" or bytewise.get("add_prefix_space"):
        return None
    added = {i: len(t.content.encode()) for i, t in model.get_added_tokens_decoder().items()}
    vocabulary = model.get_vocab(with_added_tokens=True)
    out = np.zeros(max(vocabulary.values()) + 1, np.int64)
    for token, i in vocabulary.items():
        out[i] = added.get(i, len(token))  # a letter for each byte
    return out


class ChunkEncoder:
    """encode: a list of strings to a list of id lists. Keeps the ids of chunks it has seen.

    ``check``, if given, says for each chunk and its ids which of its tests they pass, as
    bits; ``passed`` then has, after each call, the tests that all chunks of a text pass.
    ``id_bytes``, if given (and no ``check``), lets many new chunks be encoded as one text:
    it says how many bytes an id stands for, which tells whose ids they are.
    """

    def __init__(
        self, encode: Callable[[list[str]], list[list[int]]],
        check: Callable[[list[str], list[list[int]]], list[int]] | None = None,
        id_bytes: np.ndarray | None = None,
    ):
        self._encode, self._check = encode, check
        self._id_bytes = None if check else id_bytes
        self.passed = np.zeros(0, np.uint8)
        self._forget()

    def _forget(self) -> None:
        self.keys = self.checks = np.zeros(0, np.uint64)
        self.at = self.sizes = np.zeros(0, np.int64)
        self.flat, self.good = np.zeros(0, np.uint32), np.zeros(0, np.uint8)

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row, and where each text's begin (and the end)."""
        data, offsets = B.utf8(texts)
        starts, ends, owner = _chunks(data, offsets)
        keys, checks = B.hash_spans(data, starts, ends, 51), B.hash_spans(data, starts, ends, 52)
        names, first, of = np.unique(keys, return_index=True, return_inverse=True)
        same = bool((checks == checks[first][of]).all())
        known = B.member(names, self.keys)
        if same and known.any():
            at = np.searchsorted(self.keys, names[known])
            same = bool((self.checks[at] == checks[first][known]).all())
        if not same:  # two chunks share a 64-bit hash: take the texts whole
            return self._whole(texts)
        if len(self.keys) > _KNOWN_AT_MOST:
            self._forget()
            known[:] = False
        self._learn(data, starts[first[~known]], ends[first[~known]], names[~known], checks[first[~known]])
        row = np.searchsorted(self.keys, names)[of]
        sizes = self.sizes[row]
        ids = self.flat[B.expand(self.at[row], sizes)]
        before = np.append(0, np.cumsum(sizes))
        cuts = np.searchsorted(owner, np.arange(len(offsets)))
        if self._check:
            self.passed = np.full(len(offsets) - 1, 255, np.uint8)
            filled = cuts[:-1] < cuts[1:]
            if filled.any():
                self.passed[filled] = np.bitwise_and.reduceat(self.good[row], cuts[:-1][filled])
        return ids, before[cuts]

    def _whole(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        strings = ["" if t is None else t for t in texts.to_pylist()]
        lists = self._encode(strings)
        if self._check:
            self.passed = np.array(self._check(strings, lists), np.uint8)
        sizes = np.array([len(x) for x in lists], np.int64)
        ids = np.fromiter((i for x in lists for i in x), np.uint32, int(sizes.sum()))
        return ids, np.append(0, np.cumsum(sizes)).astype(np.int64)

    def _learn(self, data, starts, ends, names, checks) -> None:
        if not len(names):
            return
        parts, all_sizes, all_good = [self.flat], [], []
        for low in range(0, len(names), _ENCODED_AT_ONCE):
            part = slice(low, low + _ENCODED_AT_ONCE)
            together = self._together(data, starts[part], ends[part])
            if together:
                parts.append(together[0])
                all_sizes.append(together[1])
                all_good.append(np.full(len(together[1]), 255, np.uint8))
                continue
            strings = [
                data[a:b].tobytes().decode() for a, b in zip(starts[part].tolist(), ends[part].tolist(), strict=True)
            ]
            lists = self._encode(strings)
            all_good.append(np.array(self._check(strings, lists) if self._check else [255] * len(lists), np.uint8))
            all_sizes.append(np.array([len(x) for x in lists], np.int64))
            parts.append(np.fromiter((i for x in lists for i in x), np.uint32, int(all_sizes[-1].sum())))
        sizes = np.concatenate(all_sizes)
        at = len(self.flat) + np.cumsum(sizes) - sizes
        self.flat = np.concatenate(parts)
        order = np.argsort(keys := np.append(self.keys, names), kind="stable")
        self.keys, self.checks = keys[order], np.append(self.checks, checks)[order]
        self.good = np.concatenate([self.good, *all_good])[order]
        self.at, self.sizes = np.append(self.at, at)[order], np.append(self.sizes, sizes)[order]


    def _together(self, data, starts, ends) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids in a row and their numbers, from texts of many chunks each. Texts are cut
        between two chunks if the first ends, and the second begins, as at any cut; other
        chunks are texts of their own."""
        if self._id_bytes is None:
            return None
        lengths = ends - starts
        letters = data[B.expand(starts, lengths)]
        upto = np.cumsum(lengths)
        first, last = letters[upto - lengths], upto - 1
        open_end = _safe(letters)[last]
        # The last byte of a two-byte letter may only be judged with the byte before it.
        open_end &= (lengths > 1) | (letters[last] < 0x7F)
        begins = np.ones(len(starts), bool)
        begins[1:] = ~(open_end[:-1] & B.SPACE[first[1:]] & (first[1:] != 0x0D))
        begins[::_JOINED] = True
        cuts = np.append((upto - lengths)[begins], len(letters)).tolist()
        raw = letters.tobytes()
        lists = self._encode([raw[a:b].decode() for a, b in itertools.pairwise(cuts)])
        ids = np.fromiter(itertools.chain.from_iterable(lists), np.uint32)
        if not len(ids) or ids.max() >= len(self._id_bytes):
            return None
        told = np.cumsum(self._id_bytes[ids])
        at = np.searchsorted(told, upto)
        if told[-1] != upto[-1] or (told[at] != upto).any():
            return None
        return ids, np.diff(at + 1, prepend=0)


def _safe(data: np.ndarray) -> np.ndarray:
    """What may stand before a cut: printable ASCII, or a letter of two bytes whose first is C3."""
    safe = (data > 0x20) & (data < 0x7F)
    safe[1:] |= (data[:-1] == 0xC3) & (data[1:] >= 0x80)
    return safe


def _chunks(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    if not len(data):
        return (np.zeros(0, np.int64),) * 3
    safe = _safe(data)
    cut = np.zeros(len(data), bool)
    cut[1:] = B.SPACE[data[1:]] & safe[:-1] & (data[1:] != 0x0D)
    cut[offsets[:-1][offsets[:-1] < len(data)]] = True
    starts = np.flatnonzero(cut)
    return starts, np.append(starts[1:], len(data)), np.searchsorted(offsets, starts, "right") - 1
