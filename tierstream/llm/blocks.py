"""Whole columns of texts as byte arrays: words, spans, hashes, compact key lists.

Everything works on the UTF-8 bytes of many documents at once, so that a task spends its
time in array operations. White space is ``[\\x20\\x09-\\x0D]`` throughout; no such byte
occurs inside a multi-byte character.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32

# Increment and multipliers of the SplitMix64 generator.
_STEP = np.uint64(0x9E3779B97F4A7C15)
_MULTIPLIERS = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))

_BYTES_AT_ONCE = 2_000_000
NO_ID = -(2**63)


def mix(x: np.ndarray) -> np.ndarray:
    """64 bits to 64 bits, one to one, every input bit reaching every output bit."""
    x = (x ^ (x >> np.uint64(30))) * _MULTIPLIERS[0]
    x = (x ^ (x >> np.uint64(27))) * _MULTIPLIERS[1]
    return x ^ (x >> np.uint64(31))


def series(n: int, seed: int) -> np.ndarray:
    """n fixed pseudo-random 64-bit numbers."""
    start = mix(np.array([seed + 1], np.uint64))[0]
    with np.errstate(over="ignore"):
        return mix(np.arange(1, n + 1, dtype=np.uint64) * _STEP + start)


def plain(column: pa.Array | pa.ChunkedArray) -> pa.Array:
    return column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column


def ids(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Whole numbers; null as the smallest number there is, so that it sorts first."""
    return pc.fill_null(plain(column).cast(pa.int64()), NO_ID).to_numpy(zero_copy_only=False)


def utf8(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column, null as empty, and where each text starts (and the end)."""
    texts = pc.fill_null(plain(column).cast(pa.large_string()), "")
    if len(texts) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, starts, data = texts.buffers()
    offsets = np.frombuffer(starts, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if data is None:
        return np.zeros(0, np.uint8), offsets - offsets[0]
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def runs(solid: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and text numbers of the runs of marked bytes within each text."""
    if not len(solid):
        return (np.zeros(0, np.int64),) * 3
    edge = np.zeros(len(solid) + 1, bool)
    edge[offsets] = True
    begin, finish = solid.copy(), solid.copy()
    begin[1:] &= edge[1:-1] | ~solid[:-1]
    finish[:-1] &= edge[1:-1] | ~solid[1:]
    starts = np.flatnonzero(begin)
    return starts, np.flatnonzero(finish) + 1, np.searchsorted(offsets, starts, "right") - 1


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return runs(~SPACE[data], offsets)


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit hash of the bytes of each span; spans are not empty."""
    out = np.empty(len(starts), np.uint64)
    if not len(starts):
        return out
    lengths = ends - starts
    letters = series(256, seed) | np.uint64(1)
    places = series(int(lengths.max()), seed + 1) | np.uint64(1)
    upto = np.cumsum(lengths)
    low = 0
    while low < len(starts):
        done = upto[low] - lengths[low]
        high = max(low + 1, int(np.searchsorted(upto, done + _BYTES_AT_ONCE, "right")))
        n = lengths[low:high]
        first = upto[low:high] - n - done
        place = np.arange(int(n.sum())) - np.repeat(first, n)
        values = letters[data[place + np.repeat(starts[low:high], n)]]
        values *= places[place]
        out[low:high] = np.add.reduceat(values, first)
        low = high
    return mix(out + lengths.astype(np.uint64))


def rolling(hashes: np.ndarray, n: int, seed: int) -> np.ndarray:
    """A hash of each n consecutive hashes; callers mask windows that cross texts."""
    if len(hashes) < n:
        return np.zeros(0, np.uint64)
    factors = series(n, seed) | np.uint64(1)
    total = hashes[: len(hashes) - n + 1] * factors[0]
    for k in range(1, n):
        total += hashes[k : len(hashes) - n + 1 + k] * factors[k]
    return mix(total)


def inside(owner: np.ndarray, n: int) -> np.ndarray:
    """Which windows of n words lie within one text."""
    if len(owner) < n:
        return np.zeros(0, bool)
    return owner[: len(owner) - n + 1] == owner[n - 1 :]


def member(values: np.ndarray, among: np.ndarray) -> np.ndarray:
    """Which values occur in a sorted array."""
    if not len(among):
        return np.zeros(len(values), bool)
    at = np.searchsorted(among, values)
    at[at == len(among)] = 0
    return among[at] == values


def expand(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers start, start + 1, ... of each range, one range after the other."""
    total = int(lengths.sum())
    before = np.cumsum(lengths) - lengths
    return np.arange(total) + np.repeat(starts - before, lengths)


def groups(sorted_keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and sizes of the runs of equal keys."""
    if not len(sorted_keys):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    new = np.ones(len(sorted_keys), bool)
    new[1:] = sorted_keys[1:] != sorted_keys[:-1]
    starts = np.flatnonzero(new)
    return starts, np.diff(np.append(starts, len(sorted_keys)))


def dump(keys: np.ndarray, *columns: np.ndarray) -> bytes:
    """Rising 64-bit keys as differences, and further columns, in as few bytes as the
    largest value needs; byte by byte, so that the shuffle's compression finds the zeros.
    """
    keys = keys.astype(np.uint64)
    first = keys[:1].tobytes() if len(keys) else bytes(8)
    steps = np.diff(keys, prepend=keys[:1])
    return b"".join([np.int64(len(keys)).tobytes(), first, *map(_planes, (steps, *columns))])


def load(blob: bytes) -> list[np.ndarray]:
    """What dump() was given, all columns as unsigned 64-bit numbers."""
    n, at, out = int(np.frombuffer(blob, np.int64, 1)[0]), 16, []
    while at < len(blob):
        width = blob[at]
        raw = np.zeros((n, 8), np.uint8)
        raw[:, :width] = np.frombuffer(blob, np.uint8, n * width, at + 1).reshape(width, n).T
        out.append(raw.view("<u8").reshape(n))
        at += 1 + n * width
    out[0] = np.cumsum(out[0], dtype=np.uint64) + np.frombuffer(blob, np.uint64, 1, 8)[0]
    return out


def _planes(values: np.ndarray) -> bytes:
    values = np.ascontiguousarray(values.astype("<u8", copy=False))
    width = (int(values.max()).bit_length() + 7) // 8 if len(values) else 0
    return bytes([width]) + values.view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()


def dealt(sorted_keys: np.ndarray, buckets: int, bits: int = 64) -> Iterator[tuple[int, slice]]:
    """The range of each bucket that has keys; bucket b has the b-th part of all key values."""
    edges = np.array([(b << bits) // buckets for b in range(buckets)], np.uint64)
    cuts = np.append(np.searchsorted(sorted_keys, edges), len(sorted_keys))
    for b in range(buckets):
        if cuts[b] < cuts[b + 1]:
            yield b, slice(int(cuts[b]), int(cuts[b + 1]))


def per_text(fn: Callable[[bytes], object], data: np.ndarray, cuts: np.ndarray) -> list:
    view = memoryview(np.ascontiguousarray(data))
    return [fn(bytes(view[a:b])) for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]


def joined(
    data: np.ndarray, offsets: np.ndarray, starts: np.ndarray, ends: np.ndarray, owner: np.ndarray, stay: np.ndarray
) -> pa.Array:
    """Each text reduced to the spans that stay, with the byte after each but the last."""
    mark = np.zeros(len(data) + 1, np.int8)
    filled = stay & (ends > starts)
    mark[starts[filled]] += 1
    mark[ends[filled]] -= 1  # a span that starts where another ends keeps the sum right
    keep = np.cumsum(mark[:-1], dtype=np.int8).astype(bool)
    spans = np.flatnonzero(stay)
    more = spans[:-1][owner[spans[:-1]] == owner[spans[1:]]]
    keep[ends[more]] = True
    cuts = np.append(0, np.cumsum(keep))[offsets].astype(np.int64)
    return pa.Array.from_buffers(
        pa.large_string(), len(offsets) - 1,
        [None, pa.py_buffer(cuts.tobytes()), pa.py_buffer(data[keep].tobytes())],
    ).cast(pa.string())
