from __future__ import annotations

import math
import random

import numpy as np
import pytest

from claimscope.llm import whitening
from claimscope.llm.whitening import above, leading, whitening_report

SCHEMA = "vec_id long, embedding array<double>, label int, x int, whitened string"


def brute(rows):
    """The contract with numpy on all rows at once."""
    fine = [(i, [math.floor(256 * c) for c in v]) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    width = max((len(x) for _, x in fine), default=0)
    fine = [(i, tuple(x) + (0,) * (width - len(x))) for i, x in fine]
    fit = sorted({x for _, x in fine})
    n = len(fit)
    if not n or not width:
        return [], None
    sums = [sum(x[d] for x in fit) for d in range(width)]
    centred = np.array([[(n * c - s) / n for c, s in zip(x, sums, strict=True)] for x in fit])
    cov = centred.T @ centred / n
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1], vectors[:, ::-1]
    keep = [k for k in range(min(4, width)) if values[k] > 1e-9 * max(values[0], 1e-300)]
    out = []
    for i, x in fine:
        z = np.array([(n * c - s) / n for c, s in zip(x, sums, strict=True)])
        dev = sum((n * c - s) ** 2 for c, s in zip(x, sums, strict=True))
        out += [(i, k + 1, n, dev, float(z @ vectors[:, k]) / math.sqrt(values[k]), values[k] / np.trace(cov)) for k in keep]
    return out, keep


def same(df, rows):
    want, keep = brute(rows)
    found = df.collect()
    assert len(found) == len(want)
    if not want:
        return
    key = lambda r: (str(r[0]), r[1], r[3], abs(r[4]))
    a = sorted(((r.vec_id, r.component, r.n, r.deviation, r.whitened, r.explained) for r in found), key=key)
    b = sorted(want, key=key)
    sign = {}
    for x, y in zip(a, b, strict=True):
        assert x[:4] == y[:4]
        if abs(y[4]) > 1e-3:
            sign.setdefault(x[1], np.sign(x[4] * y[4]))
        assert x[4] == pytest.approx(sign.get(x[1], 1) * y[4], abs=1e-7)
        assert x[5] == pytest.approx(y[5], rel=1e-9)
    assert {r.identity_error for r in found} == {found[0].identity_error} and found[0].identity_error < 1e-8


@pytest.mark.parametrize("seed, width", [(1, 6), (2, 3), (3, 12)])
def test_against_numpy(spark, seed, width):
    rng = random.Random(seed)
    rows = [(i, [rng.gauss(0.2 * d, 0.1 * (d + 1)) for d in range(width)]) for i in range(300)]
    rows += [(i, rows[7][1]) for i in range(400, 500)]  # copies count once in the fit
    rows += [(600, None), (601, [None] * width), (602, [float("nan")] * width), (603, [float("inf")] + [0.0] * (width - 1)), (None, rows[3][1]), (5, rows[4][1])]
    rows += [(700, rows[8][1][: width - 1]), (701, rows[8][1][: width - 1] + [0.0]), (702, [])]
    df = spark.createDataFrame([(i, v, 0, 1, "w") for i, v in rows], SCHEMA).repartition(5)
    same(whitening_report(df), rows)


def test_few_rows_and_flat_dimensions(spark):
    frame = lambda rows: spark.createDataFrame([(i, v, 0, 1, "w") for i, v in rows], SCHEMA)
    assert whitening_report(frame([])).collect() == []
    assert whitening_report(frame([(1, [])])).collect() == []
    assert whitening_report(frame([(1, [1.0, 2.0]), (2, [1.0, 2.0])])).collect() == []
    for rows in ([(1, [1.0, 2.0]), (2, [3.0, 2.0])], [(i, [float(i), 2.0 * i, -0.5 * i, 7.0]) for i in range(9)], [(1, [-0.001, 0.0]), (2, [0.0, -0.0]), (3, [0.0, 0.0])]):
        same(whitening_report(frame(rows)), rows)


def test_large_entries_are_exact_or_refused(spark):
    frame = lambda rows: spark.createDataFrame([(i, v, 0, 1, "w") for i, v in rows], SCHEMA)
    rows = [(1, [1e6, -3e6]), (2, [2e6, 5.5]), (3, [-1.5e6, 0.25])]
    same(whitening_report(frame(rows)), rows)
    big = [(i, [2.0**44 + 3 * i, (-1.0) ** i * 2.0**43]) for i in range(6)]
    fit = whitening.fitted(whitening.integer_vectors(frame(big)).select("x").distinct())
    xs = [[math.floor(256 * c) for c in v] for _, v in big]
    assert fit.sums == [sum(x[d] for x in xs) for d in range(2)]
    with pytest.raises(Exception, match="beyond 2"):
        whitening_report(frame([(1, [1e300]), (2, [0.0])])).collect()


def spectrum(values, seed=0):
    q = np.linalg.qr(np.random.default_rng(seed).standard_normal((len(values), len(values))))[0]
    return (q * np.array(values, float)) @ q.T


@pytest.mark.parametrize(
    "values",
    [
        [9, 5, 3, 2, 1, 0.5],
        [9, 9, 9, 9, 9, 1],  # more equal ones than are wanted
        [1 + 1e-9, 1, 1, 1 - 1e-9, 1e-3, 1e-4],
        list(np.linspace(1, 2, 40)),
        [1e6, 1, 1e-3, 1e-6, 1e-7, 0, 0],
        [3, 0, 0, 0],
        [2.5],
        [1] * 7,
        list(1 + 1e-4 * np.arange(64)),
    ],
)
def test_components_of_hard_spectra(values):
    matrix = spectrum(values)
    found = leading(matrix)
    want = sorted([v for v in values if v > 5e-13 * max(values)], reverse=True)[:4]
    assert found.values == pytest.approx(want, rel=1e-9, abs=1e-13 * max(values))
    assert found.vectors.T @ found.vectors == pytest.approx(np.eye(len(want)), abs=1e-10)
    assert np.linalg.norm(matrix @ found.vectors - found.vectors * found.values) < 1e-11 * max(values)


def test_inertia_counts():
    rng = np.random.default_rng(4)
    for size in (1, 2, 5, 20):
        for _ in range(20):
            m = rng.standard_normal((size, size))
            m = m + m.T
            if size > 2:
                np.fill_diagonal(m, 0)  # pivots of two
            shift = float(rng.standard_normal())
            assert above(m, shift) == int((np.linalg.eigvalsh(m) > shift).sum())


def test_smoke_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    same(whitening_report(df), [(r.vec_id, r.embedding) for r in df.collect()])
