"""A cuckoo filter over 64-bit keys, in numpy."""

from __future__ import annotations

import numpy as np

from sensorloom.llm.common import mixed

SLOTS = 4
KICKS = 500


class Full(Exception):
    """A key found no place; the filter holds what it held before."""


class CuckooFilter:
    """Buckets of four 16-bit fingerprints; a key may stand in two buckets.

    Holds each inserted key once for each insertion, so keys can be deleted again. ``contains``
    has no false negatives; about one in 8,000 other keys is a false positive.
    """

    def __init__(self, buckets: int, table: bytes | None = None) -> None:
        self.mask = np.uint64(buckets - 1)
        self.table = np.zeros((buckets, SLOTS), np.uint16)
        if table is not None:
            self.table[:] = np.frombuffer(table, np.uint16).reshape(-1, SLOTS)

    @staticmethod
    def buckets_for(keys: int) -> int:
        """The power of two of buckets that ``keys`` keys fill to at most 85 %."""
        return 1 << max(4, int(np.ceil(np.log2(max(1, keys) / (SLOTS * 0.85)))))

    def places(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Fingerprint and both buckets of every key."""
        print_ = (keys >> np.uint64(48)).astype(np.uint16)
        print_[print_ == 0] = 1
        one = keys & self.mask
        return print_, one, one ^ (mixed(print_.astype(np.uint64)) & self.mask)

    def contains(self, keys: np.ndarray) -> np.ndarray:
        print_, one, two = self.places(keys)
        found = (self.table[one] == print_[:, None]).any(axis=1)
        return found | (self.table[two] == print_[:, None]).any(axis=1)

    def insert(self, keys: np.ndarray) -> None:
        """Insert every key once more. On ``Full`` nothing is lost: call again on a larger filter."""
        print_, one, two = self.places(keys)
        left = np.arange(len(keys))
        for bucket in (one, two) * SLOTS:  # at most one key for each bucket and round
            _, first = np.unique(bucket[left], return_index=True)
            mine = left[first]
            free = self.table[bucket[mine]] == 0
            slot = free.argmax(axis=1)
            fits = free.any(axis=1)
            self.table[bucket[mine[fits]], slot[fits]] = print_[mine[fits]]
            left = np.setdiff1d(left, mine[fits], assume_unique=True)
            if not len(left):
                return
        turn = 0
        for at in left:
            print_at, bucket = int(print_[at]), int(two[at])
            for _ in range(KICKS):
                row = self.table[bucket]
                free = np.flatnonzero(row == 0)
                if len(free):
                    row[free[0]] = print_at
                    break
                turn = (turn * 5 + 3) % 251
                slot = turn % SLOTS
                print_at, row[slot] = int(row[slot]), print_at
                bucket ^= int(mixed(np.array([print_at], np.uint64))[0] & self.mask)
            else:
                raise Full

    def delete(self, keys: np.ndarray) -> None:
        """Delete one entry of every key; only keys that were inserted may be given.

        Equal fingerprints in a bucket are of keys with the same two buckets, so any of them will do.
        """
        print_, one, two = self.places(keys)
        left = np.arange(len(keys))
        for bucket in (one, two):
            while len(left):
                held = self.table[bucket[left]] == print_[left, None]
                there = np.flatnonzero(held.any(axis=1))
                _, first = np.unique(bucket[left[there]], return_index=True)  # one key for each bucket
                if not len(first):
                    break
                mine = there[first]
                self.table[bucket[left[mine]], held[mine].argmax(axis=1)] = 0
                left = np.delete(left, mine)
