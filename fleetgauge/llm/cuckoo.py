"""A cuckoo filter over 16-byte keys, as two numpy arrays that fit into a table row."""

from __future__ import annotations

import numpy as np

SLOTS = 4
KICKS = 200


class CuckooFilter:
    """Set of keys with insertion and deletion. Never misses a key it holds; may report one it doesn't.

    A key has a 16-bit fingerprint and two buckets, each found from the other and the fingerprint. Fingerprints
    that find no place after ``KICKS`` moves go to a list beside the buckets, so that no insertion fails.
    """

    def __init__(self, buckets: np.ndarray, spare: list[tuple[int, int]]):
        self.buckets, self.spare = buckets, spare
        self.mask = len(buckets) - 1

    @classmethod
    def empty(cls, keys: int) -> CuckooFilter:
        """For about ``keys`` keys: as many buckets as leave four fifths of the slots full at most."""
        n = 1 << max(1, int(np.ceil(np.log2(max(1, keys) / (SLOTS * 0.8)))))
        return cls(np.zeros((n, SLOTS), dtype=np.uint16), [])

    @classmethod
    def load(cls, buckets: bytes, spare: list[int]) -> CuckooFilter:
        return cls(np.frombuffer(buckets, dtype=np.uint16).reshape(-1, SLOTS).copy(),
                   [(x >> 16, x & 0xFFFF) for x in spare])

    def dump(self) -> tuple[bytes, list[int]]:
        return self.buckets.tobytes(), [i << 16 | f for i, f in self.spare]

    def places(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Fingerprints and both buckets of keys, given as rows of two 64-bit numbers."""
        prints = (keys[:, 0] >> np.uint64(48)).astype(np.int64)
        prints[prints == 0] = 1
        first = (keys[:, 1] & np.uint64(self.mask)).astype(np.int64)
        return prints, first, self.other(first, prints)

    def other(self, bucket, prints):
        return bucket ^ ((prints * 0x5BD1E995) & self.mask)

    def insert(self, keys: np.ndarray) -> None:
        rng = np.random.default_rng(1)
        for mark, a, b in zip(*map(np.ndarray.tolist, self.places(keys)), strict=True):
            at = a
            for _ in range(KICKS):
                free = next((x for x in (at, b) if not self.buckets[x].all()), None)
                if free is not None:
                    self.buckets[free, int(np.argmin(self.buckets[free] != 0))] = mark
                    break
                slot = int(rng.integers(SLOTS))
                mark, self.buckets[at, slot] = int(self.buckets[at, slot]), mark
                at = b = self.other(at, mark)
            else:
                self.spare.append((at, mark))

    def delete(self, keys: np.ndarray) -> None:
        """Take out keys that were inserted."""
        for mark, a, b in zip(*map(np.ndarray.tolist, self.places(keys)), strict=True):
            for x in (a, b):
                slot = np.flatnonzero(self.buckets[x] == mark)
                if len(slot):
                    self.buckets[x, slot[0]] = 0
                    break
            else:
                self.spare.remove(next(s for s in self.spare if s[1] == mark and s[0] in (a, b)))

    def holds(self, keys: np.ndarray) -> np.ndarray:
        prints, first, second = self.places(keys)
        found = (self.buckets[first] == prints[:, None]).any(1) | (self.buckets[second] == prints[:, None]).any(1)
        for at, mark in self.spare:
            found |= (prints == mark) & ((first == at) | (second == at))
        return found


def key_array(keys: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(keys), dtype=np.uint64).reshape(-1, 2)
