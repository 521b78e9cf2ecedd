"""Arrow text columns as flat byte arrays: slices of bounded size, words, shingles and hashes.

Everything here works on whole texts inside a task. A slice holds whole rows of
about ``SLICE_BYTES`` together, or one longer row alone; it bounds memory and
changes no result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20
WORDS_IN_SHINGLE = 5

U64 = np.uint64
_GOLDEN = U64(0x9E3779B97F4A7C15)
_BASE = U64(0x5851F42D4C957F2D)
_BASE_INVERSE = U64(pow(0x5851F42D4C957F2D, -1, 1 << 64))

_WHITE = np.zeros(256, bool)
_WHITE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    x = values + _GOLDEN
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


_CODES = mixed(np.arange(256, dtype=U64))
_PLACES = mixed(np.arange(1, 65, dtype=U64)) | U64(1)
_powers: dict[int, np.ndarray] = {}


def _power_table(base: np.uint64, length: int) -> np.ndarray:
    table = _powers.get(int(base))
    if table is None or len(table) < length:
        steps = np.full(max(length, SLICE_BYTES + 1), base, U64)
        steps[0] = 1
        table = np.multiply.accumulate(steps)
        _powers[int(base)] = table
    return table[:length]


@dataclass
class Slice:
    """Rows ``first`` to ``last`` of a batch: their bytes and where each text starts (one more entry closes)."""

    first: int
    last: int
    data: np.ndarray
    starts: np.ndarray


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[Slice]:
    """Slices of a string column in row order. A null text has no bytes."""
    if column.null_count:
        column = column.fill_null("")
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    rows = len(column)
    if not rows:
        return
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + rows + 1]
    body = column.buffers()[2]
    data = np.frombuffer(body, np.uint8) if body is not None else np.zeros(0, np.uint8)
    first = 0
    while first < rows:
        last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        last = min(max(last, first + 1), rows)
        yield Slice(first, last, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first])
        first = last


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """``sums[i]`` is the positional hash of the first ``i`` bytes; see ``span_hashes``."""
    sums = np.zeros(len(data) + 1, U64)
    np.cumsum(_CODES[data] * _power_table(_BASE, len(data)), out=sums[1:])
    return sums


def span_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte spans; equal bytes give equal hashes wherever they stand."""
    back = _power_table(_BASE_INVERSE, len(sums))
    return mixed((sums[ends] - sums[starts]) * back[starts] ^ (ends - starts).astype(U64))


def words(part: Slice) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row (within the slice) of each word, lower-casing nothing."""
    if not len(part.data):
        none = np.zeros(0, np.int64)
        return none, none, none
    dark = ~_WHITE[part.data]
    edge = np.zeros(len(part.data) + 1, bool)
    edge[part.starts] = True
    after = np.concatenate(([False], dark[:-1]))
    starts = np.flatnonzero(dark & (~after | edge[:-1]))
    ahead = np.concatenate((dark[1:], [False]))
    ends = np.flatnonzero(dark & (~ahead | edge[1:])) + 1
    return starts, ends, np.searchsorted(part.starts, starts, "right") - 1


def lower_case(part: Slice) -> Slice:
    """The slice with A-Z lower-cased."""
    return Slice(part.first, part.last, _LOWER[part.data], part.starts)


def shingles(part: Slice, size: int = WORDS_IN_SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Distinct word shingles of each row: ``(values, bounds)``, row ``i`` owning ``values[bounds[i]:bounds[i + 1]]``.

    A row with fewer words than ``size`` has its whole sequence as one shingle,
    a row without words has none. Values of a row are sorted.
    """
    rows = part.last - part.first
    starts, ends, owner = words(part)
    hashes = span_hashes(prefix_sums(part.data), starts, ends)
    counts = np.bincount(owner, minlength=rows)
    first = np.concatenate(([0], np.cumsum(counts)))
    full = np.flatnonzero(owner[size - 1 :] == owner[: len(owner) - size + 1]) if len(owner) >= size else np.zeros(0, np.int64)
    joint = np.zeros(len(full), U64)
    for place in range(size):
        joint += hashes[full + place] * _PLACES[place]
    parts, rows_of = [mixed(joint)], [owner[full]]
    for length in range(1, size):
        short = np.flatnonzero(counts == length)
        joint = np.full(len(short), _PLACES[size + length], U64)
        for place in range(length):
            joint += hashes[first[short] + place] * _PLACES[place]
        parts.append(mixed(joint))
        rows_of.append(short)
    values, row = np.concatenate(parts), np.concatenate(rows_of)
    if any(len(x) for x in parts[1:]):
        order = np.argsort(row, kind="stable")
        values, row = values[order], row[order]
    bounds = np.concatenate(([0], np.cumsum(np.bincount(row, minlength=rows))))
    for i in np.flatnonzero(np.diff(bounds) > 1):
        values[bounds[i] : bounds[i + 1]].sort()
    fresh = np.ones(len(values), bool)
    fresh[1:] = (values[1:] != values[:-1]) | (row[1:] != row[:-1])
    return values[fresh], np.concatenate(([0], np.cumsum(np.bincount(row[fresh], minlength=rows))))


def ragged(flat: np.ndarray, bounds: np.ndarray, kind: pa.DataType) -> pa.Array:
    """An Arrow list array over flat values."""
    return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(flat, kind))
