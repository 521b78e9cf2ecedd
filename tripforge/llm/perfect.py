"""A minimal perfect hash over a fixed set of byte strings, by levels of bit tables."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from tripforge.llm.flat import U64, mixed, prefix_sums, span_hashes

#: Bits per key of a level: wider levels are fewer but larger.
WIDTH = 2


def hashes(strings: pa.Array) -> np.ndarray:
    """64-bit hashes of the items of a binary or string array without nulls."""
    strings = strings.cast(pa.large_binary())
    body = strings.buffers()[2]
    data = np.frombuffer(body, np.uint8) if body is not None else np.zeros(0, np.uint8)
    ends = np.frombuffer(strings.buffers()[1], np.int64)[strings.offset : strings.offset + len(strings) + 1]
    return span_hashes(prefix_sums(data[: ends[-1] if len(ends) else 0]), ends[:-1], ends[1:])


@dataclass
class PerfectHash:
    """Each level keeps the keys that fall alone on a bit; a key's number is the rank of its bit over all levels."""

    levels: list[np.ndarray]
    ranks: list[np.ndarray]

    def numbers(self, keys: np.ndarray) -> np.ndarray:
        """Number of each key; a key that isn't in the set gets any number or -1, so compare what is stored there."""
        found = np.full(len(keys), -1, np.int64)
        open_ = np.arange(len(keys))
        for level, (bits, rank) in enumerate(zip(self.levels, self.ranks, strict=True)):
            at = _spot(keys[open_], level, len(bits))
            hit = bits[at]
            found[open_[hit]] = rank[at[hit]]
            open_ = open_[~hit]
        return found


def _spot(keys: np.ndarray, level: int, size: int) -> np.ndarray:
    return (mixed(keys + mixed(np.array([level], U64))) % U64(size)).astype(np.int64)


def build(keys: np.ndarray) -> PerfectHash:
    if len(np.unique(keys)) != len(keys):
        raise ValueError("two strings of the set share a 64-bit hash")
    levels, ranks, placed, left = [], [], 0, keys
    while len(left):
        at = _spot(left, len(levels), WIDTH * len(left))
        alone = np.bincount(at, minlength=WIDTH * len(left)) == 1
        levels.append(alone)
        ranks.append(placed + np.cumsum(alone) - 1)
        placed += int(alone.sum())
        left = left[~alone[at]]
    return PerfectHash(levels, ranks)
