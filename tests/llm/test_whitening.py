"""Whitening against numpy's eigendecomposition, and the rank-one updates it rests on."""

import numpy as np
import pytest

from codesift.llm import whitening as wh
from codesift.llm.queries import q_whitening
from codesift.sources.corpus import read_table
from conftest import SF_SMALL


def check_spectrum(s, matrix):
    size = max(1e-300, np.abs(matrix).max())
    k = len(matrix)
    assert np.abs(s.vectors.T @ s.vectors - np.eye(k)).max() < 1e-11
    assert np.abs(s.vectors * s.values @ s.vectors.T - matrix).max() < 1e-11 * size
    assert (np.diff(s.values) >= 0).all()


@pytest.mark.parametrize("kind", ["random", "integers", "equal", "tiny", "graded", "one direction", "repeated values"])
def test_updates(kind):
    rng = np.random.default_rng(len(kind))
    k = 24
    s, matrix = wh.Spectrum.zero(k), np.zeros((k, k))
    for i in range(120):
        x = rng.normal(size=k)
        if kind == "integers":
            x = np.floor(x * 2)
        elif kind == "equal":
            x = np.ones(k)
        elif kind == "tiny":
            x *= 10.0 ** rng.integers(-9, 3)
        elif kind == "graded":
            x *= 10.0 ** -np.arange(k)
        elif kind == "one direction":
            x = np.eye(k)[3] * x[0]
        elif kind == "repeated values":
            x = np.eye(k)[i % k] * 3
        s, matrix = wh.rank_one(s, x, 0.5), matrix + 0.5 * np.outer(x, x)
        check_spectrum(s, matrix)


def test_combined_spectra():
    rng = np.random.default_rng(2)
    parts = [np.floor(rng.normal(size=(n, 10)) * 40) + shift for n, shift in ((3, 0), (40, 900), (1, -5), (200, 2))]
    moments = []
    for x in parts:
        (row,) = list(_moments_of(x.astype(np.int64)))
        moments.append(wh.Moments.of_state(row))
    total = moments[0]
    for m in moments[1:]:
        total = wh.combine(total, m)
    x = np.concatenate(parts)
    assert total.n == len(x) and total.sums == x.sum(axis=0).astype(int).tolist()
    check_spectrum(total.spectrum, np.cov(x.T, bias=True) * len(x))


def _moments_of(x):
    import pyarrow as pa
    from unittest import mock

    batch = pa.RecordBatch.from_arrays([pa.array(x.tolist(), pa.list_(pa.int64()))], names=["x"])
    with mock.patch.object(wh, "TaskContext") as context:
        context.get.return_value.partitionId.return_value = 0
        for out in wh._moments(iter([batch])):
            yield out.column(1)[0].as_py()


def by_numpy(rows, k=4):
    """{(position, component): (n, deviation, |whitened|, explained)} of the usable rows."""
    used = [(i, v) for i, v in rows if v and all(c is not None and np.isfinite(c) for c in v)]
    x = np.array([[int(np.floor(256.0 * c)) for c in v] for _, v in used], dtype=np.int64)
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(axis=0)
    values, vectors = np.linalg.eigh(np.cov(fit.T, bias=True))
    whitened = (x - sums / n) @ vectors[:, ::-1][:, :k] / np.sqrt(values[::-1][:k])
    deviation = ((n * x - sums) ** 2).sum(axis=1)
    return [(i, j + 1, n, int(d), abs(w[j]), values[::-1][j] / values.sum())
            for (i, _), d, w in zip(used, deviation, whitened) for j in range(k)], fit, vectors[:, ::-1][:, :k]


def check(got, want, tolerance=1e-7):
    key = lambda r: (r[0] is not None, r[0] or 0, r[1], r[3], round(r[4], 5))
    got = sorted(((r.vec_id, r.component, r.n, r.deviation, abs(r.whitened), r.explained) for r in got), key=key)
    want = sorted(want, key=key)
    assert [r[:4] for r in got] == [r[:4] for r in want]
    np.testing.assert_allclose([r[4] for r in got], [r[4] for r in want], rtol=tolerance, atol=tolerance)
    np.testing.assert_allclose([r[5] for r in got], [r[5] for r in want], rtol=1e-10)


def table(spark, rows):
    return spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").selectExpr(
        "*", "1 as x", "'x' as v", "2 as part", "3 as state").repartition(4)


def odd_rows():
    rng = np.random.default_rng(9)
    scales = 2.0 ** -np.arange(9)
    rows = [(i, (rng.normal(size=9) * scales).tolist()) for i in range(300)]
    rows += [(1000 + i, rows[3][1]) for i in range(160)] + [rows[5], rows[5], (None, rows[8][1]), (None, rows[9][1])]
    return rows + [(2000, None), (2001, []), (2002, [None] + [0.5] * 8), (2003, [float("nan")] * 9), (2004, [float("-inf")] + [0.5] * 8)]


def test_table_against_numpy(spark, monkeypatch):
    monkeypatch.setattr(wh, "FAN", 2)  # a tree of several levels
    monkeypatch.setattr(wh, "SHARE", 40)
    rows = odd_rows()
    got = wh.whiten(table(spark, rows + [(2005, [1.0, 2.0])])).collect()
    check(got, by_numpy(rows)[0])
    assert {r.identity_error for r in got} == {got[0].identity_error} and got[0].identity_error < 1e-10
    for j in range(1, 5):  # one sign for all rows of a component
        turn = {np.sign(r.whitened) for r in got if r.component == j and r.vec_id == 3 and abs(r.whitened) > 1e-9}
        assert len(turn) <= 1


def test_query_against_numpy(spark):
    rows = [(r.vec_id, [float(c) for c in r.embedding]) for r in read_table(spark, SF_SMALL, "embeddings").collect()]
    want, fit, vectors = by_numpy(rows)
    got = q_whitening(spark, SF_SMALL).collect()
    check(got, want)
    assert got[0].identity_error < 1e-10


def test_little_variance(spark):
    assert wh.whiten(table(spark, [])).count() == 0
    assert wh.whiten(table(spark, [(1, [0.5, 0.25]), (2, [0.5, 0.25])])).count() == 0
    got = wh.whiten(table(spark, [(1, [0.0, 0.0]), (2, [1.0, 0.0]), (3, [2.0, 0.0])])).collect()
    assert sorted((r.vec_id, r.component, r.n, r.deviation) for r in got) == [(1, 1, 3, 768 ** 2), (2, 1, 3, 0), (3, 1, 3, 768 ** 2)]
    assert abs(abs(got[0].explained) - 1) < 1e-12


def test_large_entries(spark):
    rows = [(1, [2.0 ** 40, 1.0]), (2, [-(2.0 ** 40), 3.0]), (3, [5.0, 9.0]), (4, [2.0 ** 54, 2.0]), (5, [2.0, 1e300])]
    got = {r.vec_id: r for r in wh.whiten(table(spark, rows)).filter("component = 1").collect()}
    x = {i: [min(int(np.floor(256 * c)) if c < 1e30 else 1 << 63, (1 << 63) - 1) for c in v] for i, v in rows}
    sums = [sum(v[j] for v in x.values()) for j in range(2)]
    for i, v in x.items():
        exact = sum((5 * a - s) ** 2 for a, s in zip(v, sums))
        assert got[i].deviation == (exact if exact < 1 << 63 else None)
    model = wh.Whitening(3, [10, -4], np.eye(2), np.ones(2), 1.0)
    assert model.deviation(np.array([[1 << 28, 5], [4, 4]])) == [(3 * (1 << 28) - 10) ** 2 + 19 ** 2, 2 ** 2 + 16 ** 2]
