"""Embedding whitening by polarisation: variances of dimensions and of sums of two dimensions give every covariance."""

from __future__ import annotations

import decimal
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripforge.session import Workspace

SCALE = 256
COMPONENTS = 4
#: Components with less than this share of the largest variance hold rounding only.
LEAST_SHARE = 1e-11

_ENTRIES = 1 << 20  # matrix entries held at once
_ROWS = 512  # vectors squared at once, so that they stay in a core's cache
_HALF = 1 << 60
_WIDTHS = {2: "<i2", 4: "<i4", 8: "<i8"}

_SUMS = "i int, j int, high decimal(38,0), low decimal(38,0)"
_WHITENED = (
    "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
)


def _matrices(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of usable vectors and their fixed-point values, short vectors filled up with zeros.

    A vector is usable when it is there and every entry is finite and has a fixed-point value that fits a long.
    """
    lengths = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    there = column.is_valid().to_numpy(zero_copy_only=False)
    entries = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    bounds = np.concatenate(([0], np.cumsum(lengths)))
    with np.errstate(over="ignore", invalid="ignore"):
        scaled = np.floor(entries * SCALE)
        bad = np.concatenate(([0], np.cumsum(~(np.abs(scaled) < 2.0**63))))
    usable = there & (bad[bounds[1:]] == bad[bounds[:-1]])
    step = max(1, _ENTRIES // max(1, int(lengths.max(initial=0))))
    for first in range(0, len(lengths), step):
        rows = first + np.flatnonzero(usable[first : first + step])
        if not len(rows):
            continue
        widest = int(lengths[rows].max())
        taken = np.arange(widest) < lengths[rows, None]
        values = np.zeros((len(rows), widest), np.int64)
        values[taken] = scaled[(bounds[rows, None] + np.arange(widest))[taken]].astype(np.int64)
        yield rows, values


def _packed(values: np.ndarray) -> tuple[list[bytes], np.ndarray]:
    """Each row as bytes (entry width, then its entries up to the last that is not 0), and the entries kept.

    Equal vectors, and only these, have equal bytes.
    """
    rows, widest = values.shape
    used = np.where(values.any(1), widest - np.argmax(values[:, ::-1] != 0, 1), 0) if widest else np.zeros(rows, np.int64)
    low, high = values.min(1, initial=0), values.max(1, initial=0)
    packed: list[bytes] = [b""] * rows
    narrow = np.zeros(rows, bool)
    for width, kind in _WIDTHS.items():
        edge = 1 << (8 * width - 1)
        fits = ~narrow & (low >= -edge) & (high <= edge - 1)
        narrow |= fits
        body = values[fits].astype(kind).tobytes()
        for place, row in enumerate(np.flatnonzero(fits)):
            start = place * widest * width
            packed[row] = bytes([width]) + body[start : start + used[row] * width]
    return packed, used


def _unpacked(bodies: list[bytes], dimensions: int) -> np.ndarray:
    """Vectors as a matrix with one row per dimension."""
    values = np.zeros((len(bodies), dimensions), np.int64)
    alike: dict[tuple[int, int], list[int]] = {}
    for place, body in enumerate(bodies):
        alike.setdefault((body[0], len(body)), []).append(place)
    for (width, size), places in alike.items():
        raw = np.frombuffer(b"".join(bodies[i] for i in places), np.uint8).reshape(len(places), size)[:, 1:]
        count = (size - 1) // width
        values[np.array(places), :count] = np.ascontiguousarray(raw).view(_WIDTHS[width]).reshape(len(places), count)
    return np.ascontiguousarray(values.T)


def fit_list(vectors: DataFrame) -> DataFrame:
    """Distinct fixed-point vectors: ``body`` and its number of entries, ``used``. Copies meet on the map side first."""

    def bodies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, values in _matrices(batch["embedding"]):
                packed, used = _packed(values)
                yield pa.RecordBatch.from_pydict({"body": pa.array(packed, pa.binary()), "used": pa.array(used.astype(np.int32))})

    return vectors.select("embedding").mapInArrow(bodies, "body binary, used int").distinct()


def _blocks(batch: pa.RecordBatch, dimensions: int, rows: int) -> Iterator[np.ndarray]:
    bodies = batch["body"].to_pylist()
    for first in range(0, len(bodies), rows):
        yield _unpacked(bodies[first : first + rows], dimensions)


def _exact_sums(fit: DataFrame, dimensions: int, measured, pairs: list[tuple[int, int]]) -> dict[tuple[int, int], int]:
    """Sums over the fit list of what ``measured`` gives per block, one whole number for each of ``pairs``.

    A task adds its blocks up as Python integers and sends two halves of each sum, so nothing overflows on the way.
    """

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = None
        for batch in batches:
            for block in _blocks(batch, dimensions, _ROWS):
                found = measured(block)
                totals = found if totals is None else totals + found
        if totals is None:
            return
        halves = [divmod(int(t), _HALF) for t in totals]
        columns = [[i for i, _ in pairs], [j for _, j in pairs]]
        kinds = [pa.int32(), pa.int32(), pa.decimal128(38, 0), pa.decimal128(38, 0)]
        columns += [[decimal.Decimal(h[side]) for h in halves] for side in (0, 1)]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["i", "j", "high", "low"])

    sums = fit.select("body").mapInArrow(added, _SUMS).groupBy("i", "j").agg(F.sum("high").alias("high"), F.sum("low").alias("low"))
    return {(r.i, r.j): int(r.high) * _HALF + int(r.low) for r in sums.collect()}


def _exact(block: np.ndarray, factor: int) -> np.ndarray:
    """The block as doubles where sums of ``factor`` times its squares stay exact in them, else as Python integers."""
    reach = max(-int(block.min(initial=0)), int(block.max(initial=0)))
    return block.astype(np.float64 if factor * reach * reach * max(1, block.shape[1]) < 1 << 53 else object)


def _squares(centres: np.ndarray):
    """Squares, summed over a block, of each centred dimension and of each sum of two centred dimensions."""

    def measured(block: np.ndarray) -> np.ndarray:
        wide = block.astype(object) - centres[:, None].astype(object) if np.abs(block).max(initial=0) > 1 << 61 else block - centres[:, None]
        centred = _exact(wide, 4)
        parts = []
        for i in range(len(centred)):
            both = centred[i + 1 :] + centred[i]
            parts.append(np.concatenate(([(centred[i] * centred[i]).sum()], (both * both).sum(1))))
        return np.array([int(x) for x in np.concatenate(parts)], object)

    return measured


@dataclass(frozen=True)
class Whitening:
    """A fitted whitening: ``total`` sums per dimension over ``n`` vectors, unit components by falling variance."""

    n: int
    total: list[int]
    components: np.ndarray  # one row per component
    variances: np.ndarray
    explained: np.ndarray

    def whitened(self, block: np.ndarray) -> np.ndarray:
        """Components by vectors. The mean's nearest integer leaves first, so large values lose nothing."""
        nearest = [round(t / self.n) for t in self.total]
        rest = np.array([(t - m * self.n) / self.n for t, m in zip(self.total, nearest, strict=True)])
        centred = (block - np.array(nearest, block.dtype)[:, None]).astype(np.float64) - rest[:, None]
        return (self.components @ centred) / np.sqrt(self.variances)[:, None]

    def deviations(self, block: np.ndarray) -> list[int | None]:
        """Exact squared distances from the mean, times n squared; None where a long can't hold one."""
        reach = max(-int(block.min(initial=0)), int(block.max(initial=0))) * self.n + max((abs(t) for t in self.total), default=0)
        kind = np.int64 if len(block) * reach * reach < 1 << 63 else object
        shifted = block.astype(kind) * self.n - np.array(self.total, kind)[:, None]
        return [int(x) if x < 1 << 63 else None for x in (shifted * shifted).sum(0)]


def fitted(fit: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """Whitening of a stored fit list; None where nothing varies.

    Only sums reach the driver: one per dimension and one per pair of them.
    """
    size = fit.agg(F.count("*").alias("n"), F.max("used").alias("used")).first()
    n, dimensions = size.n, size.used or 0
    if not n or not dimensions:
        return None
    found = _exact_sums(
        fit, dimensions, lambda block: np.array([int(x) for x in _exact(block, 1).sum(1)], object), [(i, i) for i in range(dimensions)]
    )
    total = [found[i, i] for i in range(dimensions)]
    nearest = [round(t / n) for t in total]
    pairs = [(i, j) for i in range(dimensions) for j in range(i, dimensions)]
    squares = _exact_sums(fit, dimensions, _squares(np.array(nearest)), pairs)
    # What the nearest integer leaves of the mean is taken off exactly: n times the sum of squares, less the sum squared.
    rest = [t - m * n for t, m in zip(total, nearest, strict=True)]
    spread = {}
    for i, j in pairs:
        left = rest[i] if i == j else rest[i] + rest[j]
        spread[i, j] = n * squares[i, j] - left * left
    covariance = np.zeros((dimensions, dimensions))
    for i, j in pairs:
        both = 2 * spread[i, i] if i == j else spread[i, j] - spread[i, i] - spread[j, j]
        covariance[i, j] = covariance[j, i] = both / (2 * n * n)
    trace = sum(spread[i, i] for i in range(dimensions)) / (n * n)
    values, columns = np.linalg.eigh(covariance)
    order = [k for k in np.argsort(-values, kind="stable")[:components] if values[k] > LEAST_SHARE * values.max()]
    if not order or not trace:
        return None
    rows = columns[:, order].T
    signs = np.sign(rows[np.arange(len(rows)), np.abs(rows).argmax(1)])
    return Whitening(n, total, rows * signs[:, None], values[order], values[order] / trace)


def identity_error(fit: DataFrame, model: Whitening) -> float:
    """Largest entry of the whitened fit list's covariance less the identity, measured on its vectors."""
    count, dimensions = len(model.variances), len(model.total)

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total = np.zeros((count, count + 1))
            for block in _blocks(batch, dimensions, _ROWS):
                white = model.whitened(block)
                total[:, :count] += white @ white.T
                total[:, count] += white.sum(1)
            places = np.indices(total.shape).reshape(2, -1).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(places[0]), pa.array(places[1]), pa.array(total.ravel())], ["i", "j", "value"])

    rows = fit.select("body").mapInArrow(moments, "i int, j int, value double").groupBy("i", "j").agg(F.sum("value").alias("value"))
    total = np.zeros((count, count + 1))
    for r in rows.collect():
        total[r.i, r.j] = r.value / model.n
    mean = total[:, count]
    return float(np.abs(total[:, :count] - np.outer(mean, mean) - np.eye(count)).max())


def whitened(vectors: DataFrame, work: Workspace, components: int = COMPONENTS) -> DataFrame:
    """Rows of ``vectors`` (vec_id, embedding) on the leading components of the fixed-point values' covariance.

    Each entry c becomes floor(256 * c). The fit list holds each distinct vector once; all covariances are over it.
    Returns, per row and component: vec_id, component (from 1 by falling variance), n, deviation, whitened, explained
    and identity_error.

    Rows whose vector is null, holds a null or non-finite entry, or an entry whose fixed-point value no long can hold,
    are dropped. A short vector counts as filled up with zeros. A null or repeated vec_id is carried as it is. There
    are fewer components where fewer dimensions vary; an empty table, or one without any variance, gives no rows. A
    deviation beyond a long is null. Other columns are ignored.
    """
    fit = work.store(fit_list(vectors), "fit")
    model = fitted(fit, components)
    if model is None:
        return vectors.sparkSession.createDataFrame([], _WHITENED)
    error, count, dimensions = identity_error(fit, model), len(model.variances), len(model.total)
    work.drop("fit")

    def projected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, values in _matrices(batch["embedding"]):
                block = np.zeros((dimensions, len(rows)), np.int64)
                width = min(dimensions, values.shape[1])
                block[:width] = values[:, :width].T  # what lies beyond is 0 in every vector
                size = len(rows) * count
                columns = [
                    batch["vec_id"].take(pa.array(np.repeat(rows, count))),
                    pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), len(rows))),
                    pa.array(np.full(size, model.n, np.int64)),
                    pa.array(model.deviations(block), pa.int64()).take(pa.array(np.repeat(np.arange(len(rows)), count))),
                    pa.array(model.whitened(block).T.ravel()),
                    pa.array(np.tile(model.explained, len(rows))),
                    pa.array(np.full(size, error)),
                ]
                yield pa.RecordBatch.from_arrays(columns, [f.split()[0] for f in _WHITENED.split(", ")])

    return vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").mapInArrow(projected, _WHITENED)
