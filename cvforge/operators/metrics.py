"""Classification metrics as grouped aggregates (M-1 .. M-17).

Input: one row per scored row with a class code ``y``, a predicted code and, for
two classes, the probability of the positive class. Any grouping key (fold,
model, fold x model) works; no group is ever collected.

Binary averaging is used for two classes with a positive label, support-weighted
averaging otherwise. ROC-AUC (tie-averaged rank formula) and average precision
(step sum over distinct scores) read running totals over distinct scores, built
by range partitioning so a large group is spread over many tasks.
"""

from __future__ import annotations

from itertools import product
from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cvforge.functions.columns import ratio_or_null, ratio_or_zero
from cvforge.functions.ordering import with_running_totals
from cvforge.spec import REPORT_METRICS


def _sum(cols: Sequence[Column]) -> Column:
    return sum(cols[1:], cols[0])


def _counts(df: DataFrame, group_cols: Sequence[str], y: str, pred: str, n_classes: int) -> DataFrame:
    aggs = [F.count(F.lit(1)).alias("_n"), F.count_if(F.col(y) == F.col(pred)).alias("_c")]
    for k in range(n_classes):
        aggs += [
            F.count_if(F.col(y) == k).alias(f"_t{k}"),
            F.count_if(F.col(pred) == k).alias(f"_p{k}"),
            F.count_if((F.col(y) == k) & (F.col(pred) == k)).alias(f"_tp{k}"),
        ]
    return df.groupBy(*group_cols).agg(*aggs)


def _mcc(n_classes: int) -> Column:
    s = F.col("_n").cast("double")
    c = F.col("_c").cast("double")
    pt = _sum([F.col(f"_p{k}").cast("double") * F.col(f"_t{k}") for k in range(n_classes)])
    pp = _sum([F.col(f"_p{k}").cast("double") * F.col(f"_p{k}") for k in range(n_classes)])
    tt = _sum([F.col(f"_t{k}").cast("double") * F.col(f"_t{k}") for k in range(n_classes)])
    den = F.sqrt((s * s - pp) * (s * s - tt))
    return F.when(den > 0, (c * s - pt) / den).otherwise(F.lit(0.0))


def _ranking_scores(
    df: DataFrame, group_cols: Sequence[str], y: str, score: str, positive: int, num_partitions: int | None
) -> DataFrame:
    """ROC-AUC and average precision per group from distinct-score cells."""
    cells = df.groupBy(*group_cols, score).agg(
        F.count_if(F.col(y) == positive).alias("pos"), F.count_if(F.col(y) != positive).alias("neg")
    )
    run = with_running_totals(cells, list(group_cols), score, ["pos", "neg"], num_partitions=num_partitions)
    totals = cells.groupBy(*group_cols).agg(F.sum("pos").alias("_P"), F.sum("neg").alias("_N"))
    j = run.join(totals, list(group_cols))
    tp_ge = F.col("_P") - F.col("cum_pos") + F.col("pos")
    fp_ge = F.col("_N") - F.col("cum_neg") + F.col("neg")
    terms = j.select(
        *group_cols,
        "_P",
        "_N",
        (F.col("pos") * (F.col("cum_neg") - F.col("neg") + F.col("neg") / 2.0)).alias("_auc"),
        F.when(F.col("pos") > 0, F.col("pos") / F.col("_P") * tp_ge / (tp_ge + fp_ge)).otherwise(F.lit(0.0)).alias("_ap"),
    )
    agg = terms.groupBy(*group_cols, "_P", "_N").agg(F.sum("_auc").alias("_auc"), F.sum("_ap").alias("_ap"))
    return agg.select(
        *group_cols,
        F.when((F.col("_P") > 0) & (F.col("_N") > 0), F.col("_auc") / (F.col("_P") * F.col("_N"))).alias("roc_auc"),
        F.when(F.col("_P") > 0, F.col("_ap")).otherwise(F.lit(0.0)).alias("pr_auc"),
    )


def classification_scores(
    df: DataFrame,
    group_cols: Sequence[str],
    n_classes: int,
    positive_label: int | None,
    y: str = "y",
    pred: str = "pred",
    score: str | None = "score",
    num_partitions: int | None = None,
) -> DataFrame:
    """M-2 .. M-11 per group: accuracy, precision, recall, specificity, f1_score, roc_auc, mcc, pr_auc, brier_score.

    Undefined values are NULL (never NaN), so later means skip them.
    """
    group_cols = list(group_cols)
    if not group_cols:
        keyed = df.withColumn("_g", F.lit(1))
        return classification_scores(keyed, ["_g"], n_classes, positive_label, y, pred, score, num_partitions).drop("_g")
    binary = n_classes == 2 and positive_label is not None
    c = _counts(df, group_cols, y, pred, n_classes)
    if binary:
        pos, neg = positive_label, 1 - positive_label
        tp, fp = F.col(f"_tp{pos}"), F.col(f"_p{pos}") - F.col(f"_tp{pos}")
        fn, tn = F.col(f"_t{pos}") - F.col(f"_tp{pos}"), F.col(f"_tp{neg}")
        precision = ratio_or_zero(tp, tp + fp)
        recall = ratio_or_zero(tp, tp + fn)
        f1 = ratio_or_zero(2 * tp, 2 * tp + fp + fn)
        specificity = F.when(F.col(f"_t{neg}") > 0, ratio_or_null(tn, tn + fp))
    else:
        n = F.col("_n").cast("double")
        precision = _sum([F.col(f"_t{k}") * ratio_or_zero(F.col(f"_tp{k}"), F.col(f"_p{k}")) for k in range(n_classes)]) / n
        recall = _sum([F.col(f"_t{k}") * ratio_or_zero(F.col(f"_tp{k}"), F.col(f"_t{k}")) for k in range(n_classes)]) / n
        f1 = (
            _sum(
                [
                    F.col(f"_t{k}") * ratio_or_zero(2 * F.col(f"_tp{k}"), F.col(f"_t{k}") + F.col(f"_p{k}"))
                    for k in range(n_classes)
                ]
            )
            / n
        )
        specificity = F.lit(None).cast("double")
    base = c.select(
        *group_cols,
        (F.col("_c") / F.col("_n")).alias("accuracy"),
        precision.alias("precision"),
        recall.alias("recall"),
        specificity.cast("double").alias("specificity"),
        f1.alias("f1_score"),
        _mcc(n_classes).alias("mcc"),
    )
    if n_classes == 2 and score is not None:
        pos = positive_label if positive_label is not None else 1
        brier = df.groupBy(*group_cols).agg(
            F.avg(F.pow(F.col(score) - (F.col(y) == pos).cast("double"), 2)).alias("brier_score")
        )
        ranks = _ranking_scores(df, group_cols, y, score, pos, num_partitions)
        out = base.join(ranks, group_cols).join(brier, group_cols)
    else:
        out = base.select(
            "*",
            F.lit(None).cast("double").alias("roc_auc"),
            F.lit(None).cast("double").alias("pr_auc"),
            F.lit(None).cast("double").alias("brier_score"),
        )
    return out.select(*group_cols, *REPORT_METRICS)


def fold_metric_table(
    df: DataFrame,
    n_classes: int,
    positive_label: int | None,
    fold_col: str = "fold",
    extra_keys: Sequence[str] = (),
    **kw,
) -> DataFrame:
    """M-14: fold, train_samples, test_samples and the nine metrics (per model when keyed)."""
    keys = [*extra_keys, fold_col]
    scores = classification_scores(df, keys, n_classes, positive_label, **kw)
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("test_samples"))
    total = df.groupBy(*extra_keys).agg(F.count(F.lit(1)).alias("_all")) if extra_keys else None
    if total is not None:
        sizes = sizes.join(total, list(extra_keys))
    else:
        # one row per fold: the window covers K rows
        sizes = sizes.withColumn("_all", F.sum("test_samples").over(Window.partitionBy(F.lit(1))))
    sizes = sizes.select(*keys, (F.col("_all") - F.col("test_samples")).alias("train_samples"), "test_samples")
    return sizes.join(scores, keys).select(*keys, "train_samples", "test_samples", *REPORT_METRICS)


def fold_summary(fold_metrics: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """M-13: mean_cv_<m> and population std_cv_<m> over folds; NULL metrics are skipped."""
    aggs = []
    for m in REPORT_METRICS:
        aggs += [F.avg(m).alias(f"mean_cv_{m}"), F.stddev_pop(m).alias(f"std_cv_{m}")]
    return fold_metrics.groupBy(*keys).agg(*aggs)


def confusion_matrix(df: DataFrame, classes: Sequence[str], group_cols: Sequence[str] = (), y: str = "y", pred: str = "pred") -> DataFrame:
    """M-1: one row per (actual_label, predicted_label) of the class cross product, zeros included."""
    counts = df.groupBy(*group_cols, F.col(y).alias("_a"), F.col(pred).alias("_p")).agg(F.count(F.lit(1)).alias("count"))
    pairs = [F.struct(F.lit(a).alias("_a"), F.lit(p).alias("_p")) for a, p in product(range(len(classes)), repeat=2)]
    names = F.array(*[F.lit(c) for c in classes])
    if group_cols:
        grid = df.select(*group_cols).distinct().select(*group_cols, F.explode(F.array(*pairs)).alias("_x"))
    else:
        grid = df.sparkSession.range(1).select(F.explode(F.array(*pairs)).alias("_x"))
    grid = grid.select(*group_cols, "_x._a", "_x._p")
    out = grid.join(counts, [*group_cols, "_a", "_p"], "left")
    return out.select(
        *group_cols,
        F.element_at(names, F.col("_a") + 1).alias("actual_label"),
        F.element_at(names, F.col("_p") + 1).alias("predicted_label"),
        F.coalesce("count", F.lit(0)).cast("long").alias("count"),
    )
