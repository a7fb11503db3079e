import math
import random

import pytest
from pyspark.sql import functions as F

from cvforge.functions.columns import format_decimal
from cvforge.operators.metrics import classification_scores, confusion_matrix, fold_metric_table, fold_summary


def _brute_auc_ap(rows):
    pos = [s for y, s in rows if y == 1]
    neg = [s for y, s in rows if y == 0]
    if not pos or not neg:
        auc = None
    else:
        auc = sum(1.0 if p > n else 0.5 if p == n else 0.0 for p in pos for n in neg) / (len(pos) * len(neg))
    ap = 0.0
    for s in sorted({s for _, s in rows}, reverse=True):
        tp = sum(1 for y, x in rows if x >= s and y == 1)
        fp = sum(1 for y, x in rows if x >= s and y == 0)
        p_here = sum(1 for y, x in rows if x == s and y == 1)
        if p_here and pos:
            ap += p_here / len(pos) * tp / (tp + fp)
    return auc, (ap if pos else 0.0)


def test_hand_computed_vector(spark):
    rows = [(0, 0.1), (0, 0.4), (1, 0.35), (1, 0.8), (0, 0.35), (1, 0.2)]
    df = spark.createDataFrame([(y, s, int(s > 0.5)) for y, s in rows], "y int, score double, pred int")
    r = classification_scores(df, [], 2, 1).first()
    assert r["pr_auc"] == pytest.approx(0.7)
    assert r["roc_auc"] == pytest.approx(0.6111111111)
    assert r["accuracy"] == pytest.approx(4 / 6)


def test_ranking_scores_match_brute_force_across_ranges(spark):
    random.seed(7)
    data = []
    for g in range(3):
        for _ in range(300):
            y = random.randint(0, 1)
            s = round(random.random(), 1) if g < 2 else round(random.random(), 3)
            data.append((g, y, s, int(s > 0.5)))
    df = spark.createDataFrame(data, "g int, y int, score double, pred int")
    got = {r["g"]: r for r in classification_scores(df, ["g"], 2, 1, num_partitions=5).collect()}
    for g in range(3):
        auc, ap = _brute_auc_ap([(y, s) for gg, y, s, _ in data if gg == g])
        assert got[g]["roc_auc"] == pytest.approx(auc, abs=1e-12)
        assert got[g]["pr_auc"] == pytest.approx(ap, abs=1e-12)


def test_undefined_and_zero_division(spark):
    # one-class fold: only positives, all predicted negative
    df = spark.createDataFrame([(1, 0.2, 0), (1, 0.3, 0)], "y int, score double, pred int")
    r = classification_scores(df, [], 2, 1).first()
    assert r["roc_auc"] is None
    assert r["specificity"] is None
    assert r["precision"] == 0.0 and r["recall"] == 0.0 and r["f1_score"] == 0.0
    assert r["mcc"] == 0.0


def test_weighted_multiclass_and_mcc(spark):
    y = [0, 0, 1, 1, 2, 2, 2, 1]
    p = [0, 1, 1, 1, 2, 0, 2, 2]
    df = spark.createDataFrame(list(zip(y, p)), "y int, pred int")
    r = classification_scores(df, [], 3, None, score=None).first()
    # support-weighted precision by hand
    prec = {0: 1 / 2, 1: 2 / 3, 2: 2 / 3}
    sup = {0: 2, 1: 3, 2: 3}
    assert r["precision"] == pytest.approx(sum(sup[k] * prec[k] for k in sup) / 8)
    assert r["recall"] == pytest.approx(5 / 8)
    c, s = 5, 8
    pk = [2, 3, 3]
    tk = [2, 3, 3]
    mcc = (c * s - sum(a * b for a, b in zip(pk, tk))) / math.sqrt((s * s - sum(a * a for a in pk)) * (s * s - sum(a * a for a in tk)))
    assert r["mcc"] == pytest.approx(mcc)
    assert r["roc_auc"] is None and r["specificity"] is None


def test_fold_summary_skips_null(spark):
    df = spark.createDataFrame(
        [(1, 1, 0.9, 1), (1, 0, 0.1, 0), (2, 1, 0.8, 1), (2, 1, 0.7, 1)], "fold int, y int, score double, pred int"
    )
    fm = fold_metric_table(df, 2, 1)
    s = fold_summary(fm).first()
    assert s["mean_cv_roc_auc"] == pytest.approx(1.0)  # fold 2 has one class: skipped
    assert s["std_cv_accuracy"] == pytest.approx(0.0)


def test_confusion_matrix_zero_cells(spark):
    df = spark.createDataFrame([(0, 0), (0, 0), (1, 0)], "y int, pred int")
    cm = {(r["actual_label"], r["predicted_label"]): r["count"] for r in confusion_matrix(df, ["No", "Yes"]).collect()}
    assert cm == {("No", "No"): 2, ("No", "Yes"): 0, ("Yes", "No"): 1, ("Yes", "Yes"): 0}


def test_format_decimal(spark):
    df = spark.createDataFrame([(0.5,), (1.23456,), (-0.00001,), (2.0,)], "x double")
    got = [r[0] for r in df.select(format_decimal(F.col("x"))).collect()]
    assert got == ["0.5", "1.2346", "0", "2"]


def test_auc_of_complement_score(spark):
    random.seed(3)
    data = [(random.randint(0, 1), round(random.random(), 2)) for _ in range(400)]
    df = spark.createDataFrame([(y, s, 0) for y, s in data], "y int, score double, pred int")
    a = classification_scores(df, [], 2, 1).first()["roc_auc"]
    b = classification_scores(df.withColumn("score", 1 - F.col("score")), [], 2, 1).first()["roc_auc"]
    assert a + b == pytest.approx(1.0, abs=1e-12)
