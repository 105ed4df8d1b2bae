"""Minimal perfect hashing of 64-bit keys: as many slots as keys, and a slot for each key."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

from tradelake.llm.textbytes import mix

# Keys per group that shares a displacement, and seeds that are tried at once.
GROUP = 2
SEEDS = 64


class PerfectHash(NamedTuple):
    """`displace` of each group: a seed, or -1 - slot for a group of one key; a print per slot."""

    displace: np.ndarray
    prints: np.ndarray

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """Each key's slot, or -1 where the stored fingerprint shows that it was not indexed."""
        if not len(self.prints):
            return np.full(len(keys), -1)
        own = self.displace[_group(keys, len(self.displace))]
        slot = np.where(own < 0, -1 - own, _slot(keys, own, len(self.prints)))
        return np.where(self.prints[slot] == _print(keys), slot, -1)


def _group(keys: np.ndarray, groups: int) -> np.ndarray:
    return (mix(keys + np.uint64(0x51ED270B)) % np.uint64(groups)).astype(np.int64)


def _slot(keys: np.ndarray, seeds: np.ndarray, size: int) -> np.ndarray:
    seeded = mix(keys ^ mix(seeds.astype(np.uint64) + np.uint64(1)))
    return (seeded % np.uint64(size)).astype(np.int64)


def _print(keys: np.ndarray) -> np.ndarray:
    return (mix(keys ^ np.uint64(0xC2B2AE3D27D4EB4F)) >> np.uint64(32)).astype(np.uint32)


def _free_seed(keys: np.ndarray, taken: np.ndarray) -> tuple[int, np.ndarray]:
    """The first seed that puts the keys on slots of their own, and those slots."""
    first = 0
    while True:
        seeds = np.arange(first, first + SEEDS)
        slots = _slot(keys[None, :], seeds[:, None], len(taken))
        ordered = np.sort(slots, axis=1)
        fits = ~taken[slots].any(axis=1) & (ordered[:, 1:] != ordered[:, :-1]).all(axis=1)
        if fits.any():
            at = int(fits.argmax())
            return int(seeds[at]), slots[at]
        first += SEEDS


def build(keys: np.ndarray) -> PerfectHash:
    """Hash and displace: large groups first look for a seed that puts all their keys on free slots;
    groups of one key then take any slot. `keys` are distinct 64-bit unsigned integers."""
    size = len(keys)
    group = _group(keys, max(1, size // GROUP))
    displace = np.zeros(max(1, size // GROUP), np.int64)
    order = np.argsort(group, kind="stable")
    number, begin, count = np.unique(group[order], return_index=True, return_counts=True)
    taken = np.zeros(size, bool)
    for at in np.argsort(-count, kind="stable"):
        if count[at] == 1:
            break
        own = keys[order[begin[at] : begin[at] + count[at]]]
        seed, slots = _free_seed(own, taken)
        taken[slots] = True
        displace[number[at]] = seed
    single = number[count == 1]
    displace[single] = -1 - np.flatnonzero(~taken)
    made = PerfectHash(displace, np.zeros(size, np.uint32))
    if size:
        own = displace[group]
        slot = np.where(own < 0, -1 - own, _slot(keys, own, size))
        made.prints[slot] = _print(keys)
    return made
