"""Whitening against numpy on the distinct fixed-point vectors."""

import math

import numpy as np
import pytest

from tripforge.llm import whitening
from tripforge.llm.queries import QUERIES

COLUMNS = "vec_id long, embedding array<float>, component string, n long"


def expected(vectors):
    """Per distinct vector (as a tuple): deviation and absolute coordinates; explained shares."""
    fixed = {k: [math.floor(256 * c) for c in v] for k, v in vectors.items()}
    wide = max(map(len, fixed.values()))
    fixed = {k: tuple(v + [0] * (wide - len(v))) for k, v in fixed.items()}
    fit = np.array(sorted(set(fixed.values())), object)
    n, total = len(fit), fit.sum(0)
    centred = (fit - total / n).astype(float)
    values, columns = np.linalg.eigh(centred.T @ centred / n)
    out = {}
    for k, v in fixed.items():
        gap = np.array([n * x - s for x, s in zip(v, total)], object)
        scores = (gap / n).astype(float) @ columns[:, ::-1][:, :4] / np.sqrt(values[::-1][:4])
        out[k] = (int((gap * gap).sum()), np.abs(scores))
    return n, out, values[::-1][:4] / values.sum()


def compared(rows, vectors):
    n, want, explained = expected(vectors)
    assert len(rows) == 4 * len(want)
    for r in rows:
        deviation, scores = want[r.vec_id]
        assert (r.n, r.deviation) == (n, deviation if deviation < 1 << 63 else None)
        assert abs(r.whitened) == pytest.approx(scores[r.component - 1], rel=1e-7, abs=1e-9)
        assert r.explained == pytest.approx(explained[r.component - 1], rel=1e-9)
        assert r.identity_error < 1e-9


def test_query_matches_numpy(spark, small_tables):
    rows = spark.read.parquet(f"{small_tables}/embeddings.parquet").collect()
    compared(QUERIES["op11_whitening"](spark, small_tables).collect(), {r.vec_id: r.embedding for r in rows})


@pytest.mark.parametrize("scale,shift", [(1.0, 0.0), (3.0, 40_000.0), (1e-2, -7.0), (2.0**22, 2.0**24)])
def test_scales_and_copies(spark, work, scale, shift):
    draw = np.random.default_rng(3)
    vectors = (draw.normal(size=(90, 6)) * [1, 2, 3, 4, 5, 6] * scale + shift).astype(np.float32)
    rows = [(i, [float(x) for x in vectors[i % 60]], "x", 5) for i in range(300)]
    got = whitening.whitened(spark.createDataFrame(rows, COLUMNS).repartition(7), work).collect()
    compared(got, {i: [float(x) for x in vectors[i % 60]] for i in range(300)})
    signs = {}
    for r in got:
        signs.setdefault((r.vec_id % 60, r.component), set()).add(r.whitened)
    assert all(len(s) == 1 for s in signs.values())


def test_awkward_rows(spark, work):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 2.0, 3.0], None, None), (2, [2.0, 1.0], "x", 1), (3, None, "x", 1), (4, [1.0, None, 2.0], "x", 1),
        (5, [nan, 1.0, 2.0], "x", 1), (6, [1.0, inf, 2.0], "x", 1), (7, [1e30, 0.0, 0.0], "x", 1), (8, [], "x", 1),
        (None, [-0.0, 0.001, -0.001], "x", 1), (9, [3.0, 3.0, 3.0], "x", 1), (9, [3.0, 3.0, 3.0], "x", 1),
    ]
    got = whitening.whitened(spark.createDataFrame(rows, COLUMNS), work).collect()
    per = {}
    for r in got:
        per[r.vec_id] = per.get(r.vec_id, 0) + 1
    # Three dimensions vary, so there are three components; the short vector and the empty one stay, filled with zeros.
    assert per == {1: 3, 2: 3, 8: 3, None: 3, 9: 6}
    assert {r.n for r in got} == {5}
    assert got[0].identity_error < 1e-7


@pytest.mark.parametrize("rows", [[], [(1, None, "x", 1)], [(1, [1.0, 2.0], "x", 1), (2, [1.0, 2.0], "x", 1)], [(1, [], "x", 1)]])
def test_nothing_varies(spark, work, rows):
    found = whitening.whitened(spark.createDataFrame(rows, COLUMNS), work)
    assert found.collect() == [] and found.columns[0] == "vec_id"


def test_packing_is_canonical():
    values = np.array([[0, 0, 0], [1, 0, 0], [40_000, -1, 0], [-(1 << 40), 2, 1 << 62], [-32_768, 32_767, 0], [-(1 << 63), 0, 5]])
    bodies, used = whitening._packed(values)
    assert [b[0] for b in bodies] == [2, 2, 4, 8, 2, 8] and used.tolist() == [0, 1, 2, 3, 2, 3]
    assert (whitening._unpacked(bodies, 3).T == values).all()
