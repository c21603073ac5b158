"""A cuckoo filter in numpy: a set of 64-bit hashes that answers maybe or no, and takes deletions."""

from __future__ import annotations

import numpy as np

SLOTS = 4
#: Fuller than this, a filter is made anew with twice the buckets.
FULL = 0.9
#: Rounds in which what found no room pushes something out, before the filter counts as too small.
KICKS = 500
_ODD = np.uint64(0xC6A4A7935BD1E995)


class CuckooFilter:
    """16-bit fingerprints in buckets of four; a hash lies in one of two buckets, each told from the other by the fingerprint.

    ``add`` and ``remove`` take arrays of distinct hashes; only what was added may be removed. Two hashes of
    one fingerprint and bucket hold two slots, so removing one leaves the other. No hash that is held is ever
    denied; about 8 in 65,536 that are not held are taken for held.
    """

    def __init__(self, buckets: int, table: np.ndarray | None = None):
        self.buckets = buckets
        self.table = np.zeros((buckets, SLOTS), np.uint16) if table is None else table

    @classmethod
    def sized(cls, n: int) -> CuckooFilter:
        """An empty filter with room for ``n`` hashes."""
        return cls(1 << max(0, int(np.ceil(np.log2(max(n, 1) / (SLOTS * FULL) + 1)))))

    @classmethod
    def of(cls, hashes: np.ndarray) -> CuckooFilter:
        out = cls.sized(len(hashes))
        while not out.add(hashes):
            out = cls(out.buckets * 2)
        return out

    @classmethod
    def from_bytes(cls, data: bytes) -> CuckooFilter:
        table = np.frombuffer(data, np.uint16).reshape(-1, SLOTS)
        return cls(len(table), table)

    def to_bytes(self) -> bytes:
        return self.table.astype("<u2").tobytes()

    def __len__(self) -> int:
        return int(np.count_nonzero(self.table))

    def _places(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Fingerprints (never 0, which marks a free slot) and first buckets."""
        h = np.asarray(hashes).astype(np.int64).view(np.uint64) * _ODD
        h ^= h >> np.uint64(29)
        return np.maximum((h >> np.uint64(48)).astype(np.uint16), 1), (h & np.uint64(self.buckets - 1)).astype(np.int64)

    def _other(self, bucket: np.ndarray, print_: np.ndarray) -> np.ndarray:
        mixed = (print_.astype(np.uint64) * _ODD) >> np.uint64(20)
        return bucket ^ (mixed & np.uint64(self.buckets - 1)).astype(np.int64)

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        """For each hash: False if it is not held, True if it may be."""
        print_, one = self._places(hashes)
        two = self._other(one, print_)
        return (self.table[one] == print_[:, None]).any(axis=1) | (self.table[two] == print_[:, None]).any(axis=1)

    def _settle(self, print_: np.ndarray, bucket: np.ndarray) -> np.ndarray:
        """Put what finds a free slot in its bucket there; gives which did not."""
        order = np.argsort(bucket, kind="stable")
        sorted_ = bucket[order]
        nth = np.arange(len(order)) - np.searchsorted(sorted_, sorted_)
        free = np.argsort(self.table[sorted_] != 0, axis=1, kind="stable")  # free slots first
        room = SLOTS - np.count_nonzero(self.table[sorted_], axis=1)
        fits = nth < room
        self.table[sorted_[fits], free[fits, nth[fits]]] = print_[order[fits]]
        return order[~fits]

    def add(self, hashes: np.ndarray) -> bool:
        """Whether all found room; if not, some hashes are lost and the filter must be made anew."""
        print_, bucket = self._places(hashes)
        rest = self._settle(print_, bucket)
        print_, bucket = print_[rest], self._other(bucket[rest], print_[rest])
        rng = np.random.default_rng(13)
        for _ in range(KICKS):
            rest = self._settle(print_, bucket)
            if not len(rest):
                return True
            print_, bucket = print_[rest], bucket[rest]
            # one of each full bucket pushes something out; the others wait, and go to their other bucket
            _, first = np.unique(bucket, return_index=True)
            slot = rng.integers(0, SLOTS, len(first))
            out = self.table[bucket[first], slot].copy()
            self.table[bucket[first], slot] = print_[first]
            print_ = print_.copy()
            print_[first] = out
            bucket = self._other(bucket, print_)
        return False

    def remove(self, hashes: np.ndarray) -> None:
        """Free one slot for each hash."""
        print_, one = self._places(hashes)
        for p, a, b in zip(print_.tolist(), one.tolist(), self._other(one, print_).tolist(), strict=True):
            for bucket in (a, b):
                at = np.flatnonzero(self.table[bucket] == p)
                if len(at):
                    self.table[bucket, at[0]] = 0
                    break
            else:
                raise KeyError("a hash that is not held")
