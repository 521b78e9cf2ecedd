"""Static binary-fuse filters: one byte a slot, about nine bits a key, false positives near 1 in 256."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np

from tripforge.llm.flat import U64, mixed

_TRIES = 100


@dataclass
class Filter:
    seed: int
    segment: int
    span: int
    table: np.ndarray

    def holds(self, keys: np.ndarray) -> np.ndarray:
        """Whether each key may be in the set; never false for a key that is."""
        if not len(self.table):
            return np.zeros(len(keys), bool)
        slots, prints = _places(keys, self.seed, self.segment, self.span)
        return (self.table[slots[0]] ^ self.table[slots[1]] ^ self.table[slots[2]]) == prints


def _places(keys: np.ndarray, seed: int, segment: int, span: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Three slots in neighbouring segments, and the fingerprint, of each key."""
    h = mixed(keys ^ mixed(np.array([seed], U64)))
    # The upper half picks the first segment by multiplication, lower bits the slots.
    first = ((h >> U64(32)) * U64(span)) >> U64(32)
    second = mixed(h)
    mask = U64(segment - 1)
    slots = [
        (first * U64(segment) + (second & mask)).astype(np.int64),
        ((first + U64(1)) * U64(segment) + ((second >> U64(20)) & mask)).astype(np.int64),
        ((first + U64(2)) * U64(segment) + ((second >> U64(40)) & mask)).astype(np.int64),
    ]
    return slots, (mixed(second) & U64(0xFF)).astype(np.uint8)


def build(keys: np.ndarray) -> Filter:
    """A filter over distinct 64-bit keys: slots that one key alone uses are peeled, then filled in reverse."""
    keys = np.unique(keys)
    if not len(keys):
        return Filter(0, 1, 1, np.zeros(0, np.uint8))
    size = len(keys)
    # Segment length and load as the published design sets them for three slots.
    segment = 1 << min(18, max(2, int(math.log(size) / math.log(3.33) + 2.25)))
    factor = max(1.125, 0.875 + 0.25 * math.log(1_000_000) / math.log(max(size, 2)))
    span = max(1, -(-int(size * factor) // segment) - 2)
    for seed in range(1, _TRIES):
        table = _filled(keys, seed, segment, span)
        if table is not None:
            return Filter(seed, segment, span, table)
        span += 1 + span // 20
    raise ValueError("no seed peels these keys")


def _filled(keys: np.ndarray, seed: int, segment: int, span: int) -> np.ndarray | None:
    slots, prints = _places(keys, seed, segment, span)
    table = np.zeros((span + 2) * segment, np.uint8)
    degree = np.zeros(len(table), np.int64)
    # The exclusive-or of the keys' numbers in a slot is the number itself once one is left.
    inside = np.zeros(len(table), np.int64)
    numbers = np.arange(len(keys))
    for at in slots:
        np.add.at(degree, at, 1)
        np.bitwise_xor.at(inside, at, numbers)
    rounds, left, alone = [], len(keys), np.flatnonzero(degree == 1)
    while len(alone):
        key, where = np.unique(inside[alone], return_index=True)
        rounds.append((key, alone[where]))
        left -= len(key)
        touched = np.concatenate([at[key] for at in slots])
        np.subtract.at(degree, touched, 1)
        np.bitwise_xor.at(inside, touched, np.tile(key, 3))
        touched = np.unique(touched)
        alone = touched[degree[touched] == 1]
    if left:
        return None
    for key, own in reversed(rounds):
        # The key's own slot is still 0 here, so all three can be combined.
        table[own] = prints[key] ^ table[slots[0][key]] ^ table[slots[1][key]] ^ table[slots[2][key]]
    return table
