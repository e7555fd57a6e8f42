"""Cuckoo filters: sets of hashes as 16-bit fingerprints that can be inserted and deleted.

A key has two buckets of four slots, the second found from the first and the
fingerprint alone, so a full bucket can move an entry to its other bucket. Keys
that were inserted are always found; another key is found by chance, with
probability 8 / 65535 at most. Only keys known to be inside may be deleted (an
exact table decides that), as equal fingerprints of different keys are stored once each.
"""

from __future__ import annotations

import numpy as np

from .textkernel import U64, splitmix

SLOTS = 4
MOST_KICKS = 500
# Share of slots taken when a table is sized.
LOAD = 0.5


def places(hashes: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Fingerprint (1 to 65535) and the two buckets of each hash; ``mask``: number of buckets less 1 (a power of two)."""
    mark = (hashes >> U64(48)) % U64(65535) + U64(1)
    first = hashes & mask
    return mark.astype(np.uint16), first.astype(np.int64), (first ^ (splitmix(mark) & mask)).astype(np.int64)


def buckets_for(n: int) -> int:
    """Buckets (a power of two) of a table for ``n`` keys."""
    return 1 << max(0, (int(n / (SLOTS * LOAD))).bit_length())


class CuckooFilter:
    def __init__(self, table: np.ndarray):
        self.table = table  # buckets x SLOTS fingerprints, 0 is free

    @classmethod
    def sized(cls, n: int) -> CuckooFilter:
        return cls(np.zeros((buckets_for(n), SLOTS), np.uint16))

    @classmethod
    def of(cls, hashes: np.ndarray) -> CuckooFilter:
        """A filter with all ``hashes`` (in a table doubled until they fit)."""
        n = len(hashes)
        while True:
            made = cls.sized(n)
            if made.insert(hashes):
                return made
            n = 2 * max(1, n)

    @classmethod
    def load(cls, raw: bytes) -> CuckooFilter:
        return cls(np.frombuffer(raw, "<u2").reshape(-1, SLOTS).copy())

    def dump(self) -> bytes:
        return self.table.astype("<u2").tobytes()

    def _places(self, hashes: np.ndarray):
        return places(hashes, U64(len(self.table) - 1))

    def insert(self, hashes: np.ndarray) -> bool:
        """Whether all found room; if not, the table is spoilt and must be made anew from the keys."""
        table = self.table.tolist()
        mask = len(table) - 1
        for mark, first, second in zip(*(x.tolist() for x in self._places(hashes)), strict=True):
            at = first if 0 in table[first] else second
            for kick in range(MOST_KICKS):
                bucket = table[at]
                if 0 in bucket:
                    bucket[bucket.index(0)] = mark
                    break
                slot = kick % SLOTS
                mark, bucket[slot] = bucket[slot], mark
                at ^= int(splitmix(np.array([mark], U64))[0]) & mask
            else:
                return False
        self.table = np.array(table, np.uint16).reshape(-1, SLOTS)
        return True

    def delete(self, hashes: np.ndarray) -> None:
        """Takes out ``hashes``, which must be inside."""
        for mark, first, second in zip(*(x.tolist() for x in self._places(hashes)), strict=True):
            at = first if mark in self.table[first] else second
            found = np.flatnonzero(self.table[at] == mark)
            if not len(found):
                raise KeyError("a key to delete is not in the filter")
            self.table[at, found[0]] = 0

    def contains(self, hashes: np.ndarray) -> np.ndarray:
        return ShardedFilter({0: self.table}).contains(np.zeros(len(hashes), np.int64), hashes)

    def __len__(self) -> int:
        return int(np.count_nonzero(self.table))


class ShardedFilter:
    """Filters of several shards, asked together."""

    def __init__(self, tables: dict[int, np.ndarray]):
        most = max(tables, default=0) + 1
        self.base = np.full(most, -1, np.int64)
        self.mask = np.zeros(most, np.uint64)
        at = 0
        for shard, table in tables.items():
            self.base[shard], self.mask[shard] = at, len(table) - 1
            at += len(table)
        self.table = np.concatenate([*tables.values(), np.zeros((0, SLOTS), np.uint16)])

    def contains(self, shards: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        """Which of ``hashes`` may be in their shard's filter (a shard without one has no keys)."""
        out = np.zeros(len(hashes), bool)
        known = np.flatnonzero(shards < len(self.base))
        known = known[self.base[shards[known]] >= 0]
        shard = shards[known]
        mark, first, second = places(hashes[known], self.mask[shard])
        base = self.base[shard]
        mark = mark[:, None]
        out[known] = (self.table[base + first] == mark).any(axis=1) | (self.table[base + second] == mark).any(axis=1)
        return out
