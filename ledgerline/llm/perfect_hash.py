"""Minimal perfect hashes of a shard of keys, which are stored with them."""

from __future__ import annotations

import pickle

import numpy as np

#: Levels after which keys that still collide are listed one by one.
LEVELS = 40


def _mixed(hashes: np.ndarray, level: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        out = (hashes ^ np.uint64(0x9E3779B97F4A7C15 * (2 * level + 1) & 0xFFFFFFFFFFFFFFFF)) * np.uint64(0xBF58476D1CE4E5B9)
        out ^= out >> np.uint64(31)
        out *= np.uint64(0x94D049BB133111EB)
    return out ^ (out >> np.uint64(29))


class PerfectHash:
    """Gives each of n known keys its own slot below n, and every other key none.

    At each level a bit map of two bits a key marks the places that one key alone hashes to; the
    others go on to the next level.  A slot is the number of marks before a key's own.  The bytes of
    the keys stand in slot order, and a look-up compares them.
    """

    def __init__(self, keys: list[bytes], hashes: np.ndarray):
        """`hashes` are 64-bit hashes of the distinct keys; two that agree only cost the two keys a list entry."""
        slots, left, base = np.full(len(keys), -1, np.int64), np.arange(len(keys)), 0
        self.levels: list[tuple[np.ndarray, np.ndarray, int]] = []
        while len(left) and len(self.levels) < LEVELS:
            size = -(-2 * len(left) // 64) * 64
            place = (_mixed(hashes[left], len(self.levels)) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(place, minlength=size) == 1
            words = np.packbits(alone, bitorder="little").view(np.uint64)
            before = np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int64)[:-1]])
            self.levels.append((words, before.astype(np.uint32), base))
            mine = alone[place]
            slots[left[mine]] = base + (np.cumsum(alone) - 1)[place[mine]]
            base += int(alone.sum())
            left = left[~mine]
        slots[left] = base + np.arange(len(left))
        self.listed = {keys[at]: int(slots[at]) for at in left}
        order = np.argsort(slots)
        ends = np.cumsum([len(keys[at]) for at in order], dtype=np.int64)
        self.offsets = np.concatenate([[0], ends]).astype(np.int64)
        self.keys = b"".join(keys[at] for at in order)
        self.slots_of_input = slots

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def key(self, slot: int) -> bytes:
        return self.keys[self.offsets[slot] : self.offsets[slot + 1]]

    def slots(self, keys: list[bytes], hashes: np.ndarray) -> np.ndarray:
        """The slot of each key, -1 for keys that are none of the known."""
        out, left = np.full(len(keys), -1, np.int64), np.arange(len(keys))
        for level, (words, before, base) in enumerate(self.levels):
            if not len(left):
                break
            place = _mixed(hashes[left], level) % np.uint64(64 * len(words))
            at, bit = (place >> np.uint64(6)).astype(np.int64), place & np.uint64(63)
            word = words[at]
            hit = (word >> bit) & np.uint64(1) != 0
            lower = np.bitwise_count(word & ((np.uint64(1) << bit) - np.uint64(1)))
            out[left[hit]] = (base + before[at].astype(np.int64) + lower)[hit]
            left = left[~hit]
        stored, offsets, listed = self.keys, self.offsets.tolist(), self.listed
        for at, slot in enumerate(out.tolist()):
            # Stored-key verification: an unknown key may have hashed to any slot.
            if slot >= 0 and stored[offsets[slot] : offsets[slot + 1]] != keys[at]:
                slot = out[at] = -1
            if slot < 0 and listed:
                out[at] = listed.get(keys[at], -1)
        return out

    def packed(self) -> bytes:
        return pickle.dumps((self.levels, self.listed, self.offsets.astype(np.uint32 if self.offsets[-1] < 1 << 32 else np.int64), self.keys))

    @classmethod
    def unpacked(cls, data: bytes) -> "PerfectHash":
        new = cls.__new__(cls)
        new.levels, new.listed, new.offsets, new.keys = pickle.loads(data)
        return new
