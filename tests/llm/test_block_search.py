"""The block matrix join against all pairs."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from codesift.llm import block_search as bs
from codesift.sources.corpus import read_table


def every_pair(rows, k=5, step=50):
    """(query_id, rank, vec_id, score) over all pairs of usable rows."""
    rows = {(i, tuple(v)) for i, v in rows if v and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    out = []
    for q, x in rows:
        if q is None or q % step:
            continue
        near = []
        for c, y in rows:
            if (c, y) != (q, x):
                a, b = np.array(x), np.array(y)
                near.append((-float(a @ b / np.sqrt((a @ a) * (b @ b))), c is None, c))
        near.sort(key=lambda r: (round(r[0], 12), r[1], r[2] or 0))
        out += [(q, i + 1, c, -s) for i, (s, _, c) in enumerate(near[:k])]
    return out


def check(got, want):
    key = lambda r: (r[0], r[1], r[2] is None, r[2] or 0)
    got, want = sorted(map(tuple, got), key=key), sorted(want, key=key)
    assert [r[:3] for r in got] == [r[:3] for r in want]
    np.testing.assert_allclose([r[3] for r in got], [r[3] for r in want], rtol=0, atol=1e-12)


def table(spark, rows):
    return spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").selectExpr(
        "*", "1 as qid", "'x' as v", "2 as cell", "3 as ids").repartition(3)


def search(df):
    return bs.nearest(df, F.col("vec_id") % 50 == 0)


@pytest.fixture
def small_stripes(monkeypatch):
    monkeypatch.setattr(bs, "STRIPE_ROWS", 97)
    monkeypatch.setattr(bs, "LEAST_ROWS", 40)
    monkeypatch.setattr(bs, "STRIPE_BYTES", 5 * 12 * 8)
    monkeypatch.setattr(bs, "TILE_CANDIDATES", 16)


def odd_rows():
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(size=12).tolist()) for i in range(500)]
    hot = rng.normal(size=12)
    rows += [(1000 + i, hot.tolist()) for i in range(250)]  # one vector held by a third, queries among them
    rows += [(2000 + i, (hot + rng.normal(size=12) * 1e-4).tolist()) for i in range(60)]  # near copies
    rows += [(3000 + i, (hot * 2.0 ** (i - 5)).tolist()) for i in range(10)]  # one direction
    rows += [(4000, None), (4050, []), (4100, [0.0] * 12), (4150, [None] + [1.0] * 11), (4200, [float("nan")] * 12),
             (4250, [float("inf")] + [1.0] * 11), (4300, [1.0, 2.0]), (None, hot.tolist()), (None, rng.normal(size=12).tolist())]
    rows += [rows[50], rows[50], rows[7], (100, rng.normal(size=12).tolist())]  # repeated rows, an id used twice
    return rows + [(4350, [1e200] * 12), (4400, [-1e-200] * 12)]


def test_against_all_pairs(spark, small_stripes):
    rows = odd_rows()
    finite = [(i, [x / 1e200 for x in v] if i == 4350 else [x * 1e200 for x in v] if i == 4400 else v) for i, v in rows]
    usual = [(i, v) for i, v in finite if v is None or len(v) == 12]
    check(search(table(spark, rows)).collect(), every_pair(usual))


def test_one_cell_gives_the_same(spark):
    rows = [r for r in odd_rows() if r[0] is not None and r[0] < 1100]
    check(search(table(spark, rows)).collect(), every_pair(rows))


def test_few_and_none(spark):
    assert search(table(spark, [])).count() == 0
    assert search(table(spark, [(50, [1.0, 0.0])])).count() == 0
    got = search(table(spark, [(50, [1.0, 0.0]), (1, [0.0, 3.0]), (2, [1.0, 1.0])])).collect()
    check(got, [(50, 1, 2, 0.5 ** 0.5), (50, 2, 1, 0.0)])


def test_bounds_hold():
    rng = np.random.default_rng(1)
    for width in (3, 64, 2500):  # the last over several panels
        a, b = (bs.Coded(rng.normal(size=(40, width)) * 10.0 ** rng.integers(-3, 3, 40)[:, None]) for _ in range(2))
        lower, upper = bs.tile_bounds(a, slice(0, 40), b)
        exact = (a.vectors / a.norms[:, None]) @ (b.vectors / b.norms[:, None]).T
        assert (lower <= exact).all() and (exact <= upper).all() and (upper - lower).max() < 0.1


def test_recall_on_the_table(spark):
    df = read_table(spark, "/root/testdata/sf0.1", "embeddings")
    rows = [(r.vec_id, [float(x) for x in r.embedding]) for r in df.collect()]
    check(search(df).collect(), every_pair(rows))
