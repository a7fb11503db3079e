"""Exact training on rows kept in order of a feature: the same splits as dense histograms, and no cell is moved."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cvforge.operators import boost
from cvforge.operators.boost import ModelSpec, bin_features, probabilities, train
from cvforge.spec import BoostParams


def _table(spark, n=3000):
    rng = np.random.default_rng(5)
    x = rng.integers(0, 400, n).astype(float)
    x[: n // 3] = 7.0  # a bin that takes several ranges
    z = rng.integers(0, 5, n).astype(float)
    y = ((x > 150) ^ (z > 2)).astype(int) + (rng.random(n) < 0.1)
    return spark.createDataFrame(pd.DataFrame({"row_id": np.arange(n), "fold": np.arange(n) % 3 + 1, "x": x, "z": z, "y": y}))


@pytest.mark.parametrize("n_classes,subsample", [(2, 1.0), (3, 0.7)])
def test_ordered_rows_give_the_same_trees(spark, monkeypatch, n_classes, subsample):
    df = _table(spark).withColumn("y", F.least("y", F.lit(n_classes - 1)))
    models = [ModelSpec(f, f, (0, 1), BoostParams(n_estimators=3, max_depth=3, learning_rate=0.3, subsample=subsample, reg_alpha=0.1)) for f in (1, 2, 3)]
    got = {}
    for dense in (4096, 8):
        monkeypatch.setattr(boost, "DENSE_BINS", dense)
        monkeypatch.setattr(boost, "RANGE_BYTES", 4096)
        res = train(bin_features(df, ["x", "z"], "y", max_bin=None), models, n_classes, checkpoint_every=2)
        tree = res.trees.select("model_id", "round", "tree", "node", "is_leaf", "fi", "bin", "threshold", F.round("gain", 9), F.round("value", 12))
        got[dense] = sorted(map(str, tree.collect()))
        assert probabilities(res.state, n_classes).count() == 9000
    assert got[8] == got[4096] and len(got[8]) > 9


def test_exact_bins_of_large_and_small_features_agree(spark, monkeypatch):
    df = _table(spark, 500).withColumn("x", F.when(F.col("row_id") % 11 > 0, F.col("x")))
    small = bin_features(df, ["x", "z"], "y", max_bin=None)
    plan = small.df._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan  # rows were exploded, joined and grouped anew
    rows = sorted(map(tuple, small.df.collect()))
    monkeypatch.setattr(boost, "BROADCAST_ROWS", 20)
    assert rows == sorted(map(tuple, bin_features(df, ["x", "z"], "y", max_bin=None).df.collect()))
    x = {r["row_id"]: r["x"] for r in df.collect()}
    rank = {v: i for i, v in enumerate(sorted({v for v in x.values() if v is not None}))}
    assert all(b[0] == (rank[x[i]] if x[i] is not None else small.missing_bin) for i, _, _, b in rows)


def test_a_range_read_in_parts_fails():
    import pyarrow as pa

    part = pa.RecordBatch.from_pydict({"range": pa.array([0, 0], pa.int32()), "place": [3, 4]})
    with pytest.raises(RuntimeError, match="whole"):
        list(boost.in_ranges(iter([part])))
