"""SuperMinHash signatures of many sets at once."""

from __future__ import annotations

import numpy as np

from tripforge.llm.flat import U64, mixed

_EMPTY = U64(0xFFFFFFFFFFFFFFFF)
_LEVEL_BITS = U64(56)


def signatures(values: np.ndarray, bounds: np.ndarray, size: int) -> np.ndarray:
    """A row of ``size`` registers (at most 256) per set; set ``i`` owns ``values[bounds[i]:bounds[i + 1]]``.

    Each element permutes the registers step by step (a Fisher-Yates shuffle
    seeded by its value) and offers the register of step ``j`` a number in
    [j, j + 1); registers keep the least offer. The offers of an element are so
    spread over all registers, which is what lowers the variance. Steps run for
    all elements together, and a set stops at the first step that leaves none of
    its registers empty: later offers are larger than all it holds.

    Empty sets keep empty registers. Registers are integers with the step in
    the top byte, so they compare as the numbers do.
    """
    sets = len(bounds) - 1
    registers = np.full(sets * size, _EMPTY, U64)
    owner = np.repeat(np.arange(sets), np.diff(bounds))
    seeds, order = mixed(values), None
    for step in range(size):
        draws = mixed(seeds + U64(2 * step + 1))
        # Which of the registers left over comes next, by multiplication of the draw's lower half.
        pick = step + (((draws & U64(0xFFFFFFFF)) * U64(size - step)) >> U64(32)).astype(np.int64)
        if step == 0:
            chosen = pick
        else:
            rows = np.arange(len(order))
            chosen = order[rows, pick].astype(np.int64)
            order[rows, pick] = order[rows, step]
        offers = (U64(step) << _LEVEL_BITS) | (mixed(draws) >> U64(8))
        np.minimum.at(registers, owner * size + chosen, offers)
        full = (registers.reshape(sets, size) != _EMPTY).all(axis=1)
        going = ~full[owner]
        if not going.any():
            break
        if step == 0:
            order = np.tile(np.arange(size, dtype=np.uint8), (int(going.sum()), 1))
            rows = np.arange(len(order))
            order[rows, pick[going]] = 0
        else:
            order = order[going]
        seeds, owner = seeds[going], owner[going]
    return registers.reshape(sets, size)


def estimate(one: np.ndarray, other: np.ndarray) -> float:
    """Estimated Jaccard similarity: the share of equal registers."""
    return float((one == other).mean())
