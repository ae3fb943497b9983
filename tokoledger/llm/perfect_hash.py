"""Minimal perfect hashes over byte keys, with the keys stored for verification.

Level by level, a key whose 64-bit hash falls on a bit that no other remaining key
falls on takes that bit; the others go on to the next, smaller level. A key's slot
is the number of bits set before its own, over all levels. The few keys that are
left after the last level (equal hashes) take the last slots in order. A key that
was not built in may fall on a set bit, so each slot's stored key is compared.
"""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

LONGEST = 64               # longer keys are stored as a mark and their SHA-256
LEVELS = 40
ROOM = 2                   # bits of a level for each key that reaches it
SEED = 42                  # as Spark's xxhash64


def stored_form(key: bytes) -> bytes:
    """What stands for a key: itself, or 0xFF (which begins no UTF-8 text) and its SHA-256."""
    return key if len(key) <= LONGEST else b"\xff" + hashlib.sha256(key).digest()


def hashes(keys: Iterable[bytes]) -> np.ndarray:
    return np.fromiter((xxhash.xxh64_intdigest(k, SEED) for k in keys), np.uint64)


def _positions(h: np.ndarray, level: int, size: int) -> np.ndarray:
    """Where the hashes fall in a level of ``size`` bits: the hash is mixed with the level's number."""
    x = h + np.uint64((level + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (x ^ (x >> np.uint64(31))) % np.uint64(size)


class PerfectHash:
    """``slots`` gives the slots 0 to n - 1 of the n distinct keys, and -1 for any other."""

    def __init__(self, levels: list[np.ndarray], last: dict[int, list[int]], keys: pa.Array):
        self.levels, self.last, self.keys = levels, last, keys
        self.before, total = [], 0
        for words in levels:
            counts = np.cumsum(np.bitwise_count(words), dtype=np.int64)
            self.before.append(np.concatenate(([0], counts[:-1])) + total)
            total += int(counts[-1])

    def __len__(self) -> int:
        return len(self.keys)

    @classmethod
    def build(cls, keys: list[bytes]) -> PerfectHash:
        h = hashes(keys)
        rest, levels = np.arange(len(keys)), []
        while len(rest) and len(levels) < LEVELS:
            size = 64 * -(-ROOM * len(rest) // 64)
            at = _positions(h[rest], len(levels), size).astype(np.int64)
            alone = np.bincount(at, minlength=size) == 1
            words = np.packbits(alone, bitorder="little").view(np.uint64)
            levels.append(words)
            rest = rest[~alone[at]]
        placed = sum(int(np.bitwise_count(w).sum()) for w in levels)
        last: dict[int, list[int]] = {}
        for k, i in enumerate(rest):
            last.setdefault(int(h[i]), []).append(placed + k)
        made = cls(levels, last, pa.array([b""] * len(keys), pa.binary()))
        slot = made._unverified(h)
        slot[rest] = placed + np.arange(len(rest))
        order = np.empty(len(keys), np.int64)
        order[slot] = np.arange(len(keys))
        made.keys = pa.array([stored_form(keys[i]) for i in order], pa.binary())
        return made

    def _unverified(self, h: np.ndarray) -> np.ndarray:
        slot, rest = np.full(len(h), -1, np.int64), np.arange(len(h))
        for level, words in enumerate(self.levels):
            if not len(rest):
                break
            at = _positions(h[rest], level, 64 * len(words))
            word, bit = (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
            hit = (words[word] >> bit & np.uint64(1)).astype(bool)
            below = words[word] & ((np.uint64(1) << bit) - np.uint64(1))
            slot[rest[hit]] = (self.before[level][word] + np.bitwise_count(below))[hit]
            rest = rest[~hit]
        return slot

    def slots(self, keys: list[bytes], h: np.ndarray | None = None) -> np.ndarray:
        """Slots of ``keys`` (``h``: their hashes), each verified against the stored key."""
        h = hashes(keys) if h is None else h
        if not len(self) or not len(keys):
            return np.full(len(keys), -1, np.int64)
        slot = self._unverified(h)
        forms = pa.array([stored_form(k) for k in keys], pa.binary())
        stored = self.keys.take(pa.array(np.maximum(slot, 0)))
        good = pc.equal(stored, forms).to_numpy(zero_copy_only=False) & (slot >= 0)
        slot[~good] = -1
        if self.last:
            for i in np.flatnonzero(~good):
                for k in self.last.get(int(h[i]), ()):
                    if self.keys[k].as_py() == forms[int(i)].as_py():
                        slot[i] = k
        return slot

    def dumps(self) -> bytes:
        return pickle.dumps((self.levels, self.last, self.keys.to_pylist()), protocol=5)

    @classmethod
    def loads(cls, blob: bytes) -> PerfectHash:
        levels, last, keys = pickle.loads(blob)
        return cls(levels, last, pa.array(keys, pa.binary()))
