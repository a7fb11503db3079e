"""Quantile sketches: exact while values are few, else within the rank error they state."""

import numpy as np
import pytest

from cvforge.functions.sketch import column_cuts, cut_points, merge, quantile_sketches, summarize


def off(v, w, sketch):
    """How far estimated ranks are below the true ones, least and most, at every value."""
    order = np.argsort(v, kind="stable")
    points, upto = v[order], np.cumsum(w[order])
    true = upto[np.searchsorted(points, points, side="right") - 1]
    held = np.concatenate([[0.0], np.cumsum(sketch[1])])
    gap = true - held[np.searchsorted(sketch[0], points, side="right")]
    return gap.min(), gap.max()


@pytest.mark.parametrize("shape", ["normal", "hot", "ascending"])
def test_error_stays_within_the_stated_bound(shape):
    draw = np.random.default_rng(3)
    n = 40_000
    v = {"normal": draw.normal(size=n), "hot": np.where(draw.random(n) < 0.4, 7.0, draw.normal(size=n)), "ascending": np.arange(n, dtype=float)}[shape]
    w = draw.integers(1, 9, n) / 8
    parts = [summarize(v[i : i + 1000], w[i : i + 1000], 0.0, 300) for i in range(0, n, 1000)]
    while len(parts) > 1:
        parts = [merge(parts[k : k + 2], 300) for k in range(0, len(parts), 2)]
    found = parts[0]
    assert len(found[0]) <= 300 and found[1].sum() == pytest.approx(w.sum())
    low, high = off(v, w, found)
    assert low > -1e-6 and high <= found[2] + 1e-6 and found[2] < w.sum() * 7.01 / 300


def test_few_values_are_exact_and_merge_in_any_order():
    draw = np.random.default_rng(4)
    v, w = draw.integers(0, 50, 9000).astype(float), np.ones(9000)
    parts = [summarize(v[i::9], w[i::9], 0.0, 64) for i in range(9)]
    a, b = merge(parts, 64), merge([merge(parts[5:], 64), merge(parts[:5], 64)], 64)
    assert a[2] == b[2] == 0 and (a[0] == b[0]).all() and (a[1] == b[1]).all() and (a[1] == np.bincount(v.astype(int))).all()
    assert cut_points(a, 50) == list(range(1, 50)) and len(cut_points(a, 20)) <= 20


def test_columns_of_a_table(spark):
    draw = np.random.default_rng(5)
    rows = [(float(draw.normal()), int(draw.integers(4)), None, float(draw.random() < 0.25)) for _ in range(6000)]
    rows += [(None, None, None, 1.0), (float("nan"), 2, None, None)]
    table = spark.createDataFrame(rows, "a double, b int, c double, h double").repartition(7)
    (a, whole_a), (b, whole_b), c = column_cuts(table, ["a", "b", "c"], 16, points=500)
    assert (b, whole_b) == ([1.0, 2.0, 3.0], True) and c == ([], True) and not whole_a and len(a) == 15
    values = np.sort([r[0] for r in rows[:6000]])
    assert all(abs(np.searchsorted(values, x, side="right") / 6000 - (i + 1) / 16) < 0.03 for i, x in enumerate(a))
    weighed = np.sort([r[0] for r in rows[:6000] if r[3]])
    (by_weight, _) = column_cuts(table, ["a"], 16, weight="h")[0]
    assert by_weight == [weighed[int(np.ceil(len(weighed) * k / 16)) - 1] for k in range(1, 16)]
    assert column_cuts(table.limit(0), ["a"], 16) == [([], True)]
    found = quantile_sketches(table, ["a", "b"], points=500).collect()
    assert {r.fi: sum(r.w) for r in found} == {0: pytest.approx(6000), 1: 6001.0}
