"""A cuckoo filter over arrays of 64-bit hashes, with deletion."""

from __future__ import annotations

import numpy as np

from tierstream.llm.blocks import mix

_SLOTS = 4
_ROUNDS = 400


class CuckooFilter:
    """Buckets of four 16-bit fingerprints; each hash has two possible buckets.

    ``insert`` expects hashes that are not in the filter yet, as the exact table beside it
    decides that; ``delete`` expects hashes that were inserted.
    """

    def __init__(self, capacity: int):
        buckets = 1 << max(4, int(np.ceil(np.log2(max(1, capacity) / (_SLOTS * 0.8)))))
        self.table = np.zeros((buckets, _SLOTS), np.uint16)
        self._random = np.random.default_rng(0)

    @classmethod
    def of(cls, hashes: np.ndarray, capacity: int = 0) -> CuckooFilter:
        """A filter of distinct hashes, made larger until all have a place."""
        capacity = max(capacity, len(hashes))
        while True:
            made = cls(capacity)
            if made.insert(hashes):
                return made
            capacity *= 2

    @classmethod
    def from_bytes(cls, blob: bytes) -> CuckooFilter:
        made = cls(0)
        made.table = np.frombuffer(blob, np.uint16).reshape(-1, _SLOTS).copy()
        return made

    def to_bytes(self) -> bytes:
        return self.table.tobytes()

    def _places(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        hashes = mix(hashes)  # the keys of a shard have their upper bits in common
        prints = ((hashes >> np.uint64(48)) | np.uint64(1)).astype(np.uint16)
        first = (hashes & np.uint64(len(self.table) - 1)).astype(np.int64)
        return prints, first, self._other(first, prints)

    def _other(self, bucket: np.ndarray, prints: np.ndarray) -> np.ndarray:
        shift = mix(prints.astype(np.uint64)) & np.uint64(len(self.table) - 1)
        return bucket ^ shift.astype(np.int64)

    def contains(self, hashes: np.ndarray) -> np.ndarray:
        prints, a, b = self._places(hashes)
        wanted = prints[:, None]
        return (self.table[a] == wanted).any(1) | (self.table[b] == wanted).any(1)

    def insert(self, hashes: np.ndarray) -> bool:
        """Whether all found a place; if not, the filter must be built anew, larger."""
        prints, bucket, _ = self._places(hashes)
        fresh = True  # first the second bucket is tried, from then on others are moved
        for _ in range(_ROUNDS):
            order = np.argsort(bucket, kind="stable")
            prints, bucket = prints[order], bucket[order]
            new = np.ones(len(bucket), bool)
            new[1:] = bucket[1:] != bucket[:-1]
            rank = np.arange(len(bucket)) - np.maximum.accumulate(np.where(new, np.arange(len(bucket)), 0))
            free = self.table[bucket] == 0
            room = free.sum(1)
            fits = rank < room
            slot = (np.cumsum(free, 1) == (rank + 1)[:, None]).argmax(1)
            self.table[bucket[fits], slot[fits]] = prints[fits]
            prints, bucket, moves = prints[~fits], bucket[~fits], (rank == room)[~fits]
            if not len(prints):
                return True
            if not fresh:  # one of each crowded bucket takes the place of a random other
                at = self._random.integers(0, _SLOTS, int(moves.sum()))
                out = self.table[bucket[moves], at]
                self.table[bucket[moves], at] = prints[moves]
                prints[moves] = out
            bucket = self._other(bucket, prints)
            fresh = False
        return False

    def delete(self, hashes: np.ndarray) -> None:
        prints, a, b = self._places(hashes)
        while len(prints):
            both = np.stack([a, b], 1)
            same = self.table[both] == prints[:, None, None]
            same = same.reshape(len(prints), -1)
            held = same.any(1)
            at = same.argmax(1)
            cell = both[np.arange(len(at)), at // _SLOTS] * _SLOTS + at % _SLOTS
            _, first = np.unique(cell[held], return_index=True)
            self.table.reshape(-1)[cell[held][first]] = 0
            rest = np.delete(np.flatnonzero(held), first)
            prints, a, b = prints[rest], a[rest], b[rest]
