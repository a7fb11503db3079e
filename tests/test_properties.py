import hashlib

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cvforge.operators.metrics import classification_scores
from cvforge.operators.split import assign_folds
from tests.test_metrics import _brute_auc_ap

SETTINGS = settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 1), st.integers(0, 6)), min_size=2, max_size=60))
def test_auc_ap_match_brute_force(spark, rows):
    data = [(y, s / 6.0, int(s > 3)) for y, s in rows]
    df = spark.createDataFrame(data, "y int, score double, pred int")
    got = classification_scores(df, [], 2, 1, num_partitions=3).first()
    auc, ap = _brute_auc_ap([(y, s) for y, s, _ in data])
    if auc is None:
        assert got["roc_auc"] is None
    else:
        assert got["roc_auc"] == pytest.approx(auc, abs=1e-12)
    assert got["pr_auc"] == pytest.approx(ap, abs=1e-12)


@SETTINGS
@given(st.integers(2, 400), st.integers(2, 12), st.integers(1, 7))
def test_folds_are_ntile_of_md5_order(spark, n, k, parts):
    df = spark.range(n).select(F.col("id").alias("key"))
    got = {r["key"]: r["fold"] for r in assign_folds(df, ["key"], k=k, seed=7, num_partitions=parts).collect()}
    order = sorted(range(n), key=lambda i: hashlib.md5(f"7|{i}".encode()).hexdigest())
    q, r = divmod(n, k)
    expect, pos = {}, 0
    for f in range(1, k + 1):
        size = q + (1 if f <= r else 0)
        for key in order[pos : pos + size]:
            expect[key] = f
        pos += size
    assert got == expect
