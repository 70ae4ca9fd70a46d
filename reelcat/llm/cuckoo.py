"""A cuckoo filter of 16-bit fingerprints, four to a bucket, worked on in numpy batches.

Keys are 16 bytes, already hashed. Insertions, deletions (of keys that were inserted) and
probes take arrays of keys. What finds no place is kept in a stash, so a key that was
inserted is always found; others are with a chance of about 8 in 65,535.
"""

from __future__ import annotations

import numpy as np

U = np.uint64
SLOTS = 4
#: Share of slots that a filter is made for, and rounds of evictions before the stash takes what is left.
LOAD, ROUNDS = 0.8, 400


class CuckooFilter:
    def __init__(self, capacity: int = 1, table: np.ndarray | None = None, stash: np.ndarray | None = None):
        buckets = 1 << max(0, int(np.ceil(np.log2(max(capacity, 1) / (SLOTS * LOAD)))))
        self.table = np.zeros((buckets, SLOTS), np.uint16) if table is None else table
        self.stash = np.zeros((0, 2), np.int64) if stash is None else stash  # (the lower bucket, fingerprint)

    @property
    def capacity(self) -> int:
        return int(len(self.table) * SLOTS * LOAD)

    def to_bytes(self) -> bytes:
        return np.array([len(self.table)], np.int64).tobytes() + self.table.tobytes() + self.stash.tobytes()

    @classmethod
    def from_bytes(cls, blob: bytes) -> CuckooFilter:
        n = int(np.frombuffer(blob[:8], np.int64)[0])
        end = 8 + n * SLOTS * 2
        return cls(1, np.frombuffer(blob[8:end], np.uint16).reshape(n, SLOTS).copy(), np.frombuffer(blob[end:], np.int64).reshape(-1, 2).copy())

    def _places(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(first bucket, fingerprint) of keys, given as rows of two unsigned longs."""
        h = keys[:, 1]
        return (h & U(len(self.table) - 1)).astype(np.int64), ((h >> U(40)) % U(65535)).astype(np.int64) + 1

    def _other(self, bucket: np.ndarray, print_: np.ndarray) -> np.ndarray:
        mixed = (print_.astype(U) * U(0x9E3779B97F4A7C15)) >> U(20)
        return bucket ^ (mixed & U(len(self.table) - 1)).astype(np.int64)

    def contains(self, keys: np.ndarray) -> np.ndarray:
        a, p = self._places(keys)
        b = self._other(a, p)
        found = (self.table[a] == p[:, None]).any(1) | (self.table[b] == p[:, None]).any(1)
        if len(self.stash):
            found |= np.isin(np.minimum(a, b) << 16 | p, self.stash[:, 0] << 16 | self.stash[:, 1])
        return found

    def _put(self, bucket: np.ndarray, print_: np.ndarray) -> np.ndarray:
        """Puts fingerprints into free slots of their buckets; returns which found one."""
        order = np.argsort(bucket, kind="stable")
        b = bucket[order]
        first = np.concatenate(([True], b[1:] != b[:-1]))
        rank = np.arange(len(b)) - np.maximum.accumulate(np.where(first, np.arange(len(b)), 0))
        free = np.cumsum(self.table[b] == 0, axis=1)
        fits = free[:, -1] > rank
        slot = (free == rank[:, None] + 1).argmax(1)
        self.table[b[fits], slot[fits]] = print_[order][fits]
        done = np.zeros(len(b), bool)
        done[order] = fits
        return done

    def insert(self, keys: np.ndarray) -> None:
        bucket, p = self._places(keys)
        rng = np.random.RandomState(len(keys))
        for _ in range(ROUNDS):
            for _ in range(2):  # its bucket, then the other one
                if not len(p):
                    return
                left = ~self._put(bucket, p)
                p = p[left]
                bucket = self._other(bucket[left], p)
            if not len(p):
                return
            # one eviction a bucket; the others wait
            _, k = np.unique(bucket, return_index=True)
            slot = rng.randint(0, SLOTS, len(k))
            out = self.table[bucket[k], slot].astype(np.int64)
            self.table[bucket[k], slot] = p[k]
            p[k] = out
            bucket[k] = self._other(bucket[k], out)
        low = np.minimum(bucket, self._other(bucket, p))
        self.stash = np.concatenate((self.stash, np.stack((low, p), 1)))

    def delete(self, keys: np.ndarray) -> None:
        """Removes one entry for each key; all must have been inserted."""
        bucket, p = self._places(keys)
        bucket = np.minimum(bucket, self._other(bucket, p))
        while len(p):
            _, some = np.unique(bucket << 16 | p, return_index=True)  # equal entries one after the other
            left = some
            for at in (bucket, self._other(bucket, p)):
                hit = self.table[at[left]] == p[left, None]
                found = hit.any(1)
                self.table[at[left[found]], hit[found].argmax(1)] = 0
                left = left[~found]
            for x in left.tolist():
                same = np.flatnonzero((self.stash == (bucket[x], p[x])).all(1))
                self.stash = np.delete(self.stash, same[:1], axis=0)
            bucket, p = np.delete(bucket, some), np.delete(p, some)
