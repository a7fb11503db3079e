"""Ranking and reporting over result tables (G-12 .. G-20, G-22, G-23).

Result tables hold one row per grid combination or feature count, so they are
bounded by the grid configuration, not by the data. Rankings are ``row_number``
windows with explicit tie-break keys; ``top_k`` NULL means all features.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cvforge.functions.columns import format_decimal, round_metric_columns, top_k_label
from cvforge.spec import REPORT_METRICS, selection_metric_key

PARAM_COLS = ("learning_rate", "max_depth", "n_estimators", "subsample", "colsample_bytree")


def _metric_order(metric: str) -> list[Column]:
    key = selection_metric_key(metric)
    return [F.col(c).desc_nulls_last() for c in (f"mean_cv_{key}", "mean_cv_f1_score", "mean_cv_pr_auc", "mean_cv_roc_auc")]


def rank_grid(results: DataFrame, metric: str = "accuracy") -> DataFrame:
    """G-12: rank, is_best; ties: feature count (all last), then the five parameters ascending."""
    order = _metric_order(metric) + [F.col("top_k").asc_nulls_last()] + [F.col(c).asc() for c in PARAM_COLS]
    ranked = results.withColumn("rank", F.row_number().over(Window.orderBy(*order)))
    return ranked.select("rank", (F.col("rank") == 1).alias("is_best"), *[c for c in results.columns])


def rank_defaults(results: DataFrame, metric: str = "accuracy", position_col: str = "position") -> DataFrame:
    """G-13: default_rank, is_best_default; equal metrics keep input position order."""
    order = _metric_order(metric) + [F.col(position_col).asc()]
    ranked = results.withColumn("default_rank", F.row_number().over(Window.orderBy(*order)))
    return ranked.select(
        "default_rank", (F.col("default_rank") == 1).alias("is_best_default"), *[c for c in results.columns]
    )


def screened_feature_count(default_results: DataFrame, metric: str = "accuracy") -> DataFrame:
    """G-14: the best numeric feature count (ties: fewer features); raises when none is numeric."""
    numeric = default_results.where(F.col("top_k").isNotNull())
    order = _metric_order(metric) + [F.col("top_k").asc()]
    best = numeric.withColumn("_r", F.row_number().over(Window.orderBy(*order))).where(F.col("_r") == 1).drop("_r")
    if best.isEmpty():
        raise ValueError("no result with a feature count to choose from")
    return best


def best_by_feature_count(ranked_grid: DataFrame, metric: str = "accuracy") -> DataFrame:
    """G-15: best combination per feature count (ties: overall grid rank); ``all`` listed first."""
    w = Window.partitionBy("top_k").orderBy(*_metric_order(metric), F.col("rank").asc())
    best = ranked_grid.withColumn("_r", F.row_number().over(w)).where(F.col("_r") == 1).drop("_r")
    display = Window.orderBy(F.col("top_k").asc_nulls_first())
    keep = [
        "mean_cv_accuracy", "std_cv_accuracy", "mean_cv_precision", "mean_cv_recall", "mean_cv_specificity",
        "mean_cv_f1_score", "mean_cv_mcc", "mean_cv_roc_auc", "mean_cv_pr_auc", "mean_cv_brier_score", *PARAM_COLS,
    ]
    return best.select(
        F.row_number().over(display).alias("feature_count_rank"),
        "top_k",
        F.col("rank").alias("overall_grid_rank"),
        F.col("is_best").alias("is_best_overall"),
        *keep,
    )


def params_from_row(row) -> dict:
    """G-17: typed parameters of a result row (``top_k`` None = all)."""
    d = row.asDict() if hasattr(row, "asDict") else dict(row)
    return {
        "top_k": None if d.get("top_k") is None else int(d["top_k"]),
        "learning_rate": float(d["learning_rate"]),
        "max_depth": int(d["max_depth"]),
        "n_estimators": int(d["n_estimators"]),
        "subsample": float(d["subsample"]),
        "colsample_bytree": float(d["colsample_bytree"]),
    }


def default_vs_grid(best_by_count: DataFrame, default_results: DataFrame, metric: str = "accuracy") -> DataFrame:
    """G-18: defaults and best tuned rows per feature count, ranked within each count."""
    key = selection_metric_key(metric)
    metrics = [
        "mean_cv_accuracy", "std_cv_accuracy", "mean_cv_precision", "mean_cv_recall", "mean_cv_specificity",
        "mean_cv_f1_score", "mean_cv_roc_auc", "mean_cv_mcc", "mean_cv_pr_auc", "mean_cv_brier_score",
    ]
    d = default_results.select(
        "top_k",
        F.lit("default_xgboost").alias("model_type"),
        F.lit("XGBoost defaults").alias("hyperparameter_setup"),
        F.col(f"mean_cv_{key}").alias("mean_cv_selection_score"),
        *metrics,
        *[F.lit("xgboost_default").alias(c) for c in PARAM_COLS],
    )
    g = best_by_count.select(
        "top_k",
        F.lit("best_grid_search").alias("model_type"),
        F.lit("Best grid-search combination for this feature count").alias("hyperparameter_setup"),
        F.col(f"mean_cv_{key}").alias("mean_cv_selection_score"),
        *metrics,
        *[F.col(c).cast("string").alias(c) for c in PARAM_COLS],
    )
    both = d.unionByName(g).withColumn("_src", F.when(F.col("model_type") == "default_xgboost", 0).otherwise(1))
    w = Window.partitionBy("top_k").orderBy(
        *[F.col(c).desc_nulls_last() for c in ("mean_cv_selection_score", "mean_cv_f1_score", "mean_cv_pr_auc", "mean_cv_roc_auc")],
        F.col("_src").asc(),
    )
    ranked = both.withColumn("feature_count_model_rank", F.row_number().over(w)).drop("_src")
    return ranked.select(
        "feature_count_model_rank",
        (F.col("feature_count_model_rank") == 1).alias("is_best_for_feature_count"),
        *[c for c in ranked.columns if c != "feature_count_model_rank"],
    )


def winner(frame: DataFrame, n_features: int, metric: str = "accuracy") -> DataFrame:
    """G-19: the metric, F1, PR-AUC, ROC-AUC descending, then fewer features (all = every column)."""
    count = F.coalesce(F.col("top_k"), F.lit(n_features))
    place = F.row_number().over(Window.orderBy(*_metric_order(metric), count.asc()))
    return frame.withColumn("_r", place).where(F.col("_r") == 1).drop("_r")


def four_setup_summaries(comparison: DataFrame, n_features: int, metric: str = "accuracy") -> tuple[DataFrame, DataFrame]:
    """G-20: main and supporting summaries of the four setups."""
    is_all = F.col("top_k").isNull()
    is_default = F.col("model_type") == "default_xgboost"
    groups = [
        ("Default XGBoost + all features", is_default & is_all),
        ("Best grid search + all features", ~is_default & is_all),
        ("Default XGBoost + best IG feature count", is_default & ~is_all),
        ("Best grid search + best IG feature count", ~is_default & ~is_all),
    ]
    picked = None
    for i, (label, cond) in enumerate(groups):
        w = winner(comparison.where(cond), n_features, metric).select(F.lit(i).alias("_order"), F.lit(label).alias("Result"), "*")
        picked = w if picked is None else picked.unionByName(w)
    setup = F.when(F.col("top_k").isNull(), F.lit("All encoded features")).otherwise(
        F.concat(F.lit("Top "), F.col("top_k").cast("string"), F.lit(" IG features"))
    )
    model = F.when(is_default, F.lit("Untuned XGBoost")).otherwise(
        F.concat(
            F.lit("lr="), F.col("learning_rate"), F.lit(", depth="), F.col("max_depth"), F.lit(", n="),
            F.col("n_estimators"), F.lit(", subsample="), F.col("subsample"), F.lit(", colsample="), F.col("colsample_bytree"),
        )
    )
    main = picked.select(
        "_order", "Result", setup.alias("Feature setup"),
        F.col("mean_cv_accuracy").alias("Accuracy"), F.col("mean_cv_precision").alias("Precision"),
        F.col("mean_cv_recall").alias("Recall"), F.col("mean_cv_specificity").alias("Specificity"),
        F.col("mean_cv_f1_score").alias("F1-score"),
    )
    supporting = picked.select(
        "_order", "Result", setup.alias("Feature setup"),
        F.col("mean_cv_mcc").alias("MCC"), F.col("mean_cv_roc_auc").alias("ROC-AUC"),
        F.col("mean_cv_pr_auc").alias("PR-AUC"), F.col("mean_cv_brier_score").alias("Brier score"),
        model.alias("Setup"),
    )
    return round_metric_columns(main), round_metric_columns(supporting)


def prediction_table(probs: DataFrame, classes: Sequence[str]) -> DataFrame:
    """G-22: source_row_index, fold, actual/predicted labels, is_correct, probability_<class>."""
    names = F.array(*[F.lit(c) for c in classes])
    actual = F.element_at(names, F.col("y") + 1)
    predicted = F.element_at(names, F.col("pred") + 1)
    out = probs.select(
        F.col("row_id").alias("source_row_index"),
        "fold",
        actual.alias("actual_label"),
        predicted.alias("predicted_label"),
        (actual == predicted).alias("is_correct"),
        *[F.element_at("probability", i + 1).alias(f"probability_{c}") for i, c in enumerate(classes)],
    )
    return round_metric_columns(out)


def final_ranking(main: DataFrame, supporting: DataFrame) -> tuple[DataFrame, DataFrame]:
    """G-23: min-rank on accuracy, percentages x100, supporting table joined on Result."""
    ranked = main.withColumn("Rank", F.rank().over(Window.orderBy(F.col("Accuracy").desc())))
    pct = ["Accuracy", "Precision", "Recall", "Specificity", "F1-score"]
    main_out = ranked.select(
        "Rank", "Result", "Feature setup", *[(F.col(f"`{m}`") * 100).alias(f"{m} (%)") for m in pct]
    )
    sup = supporting.join(ranked.select("Rank", "Result"), "Result", "left").select(
        "Rank", "Result", "MCC", (F.col("`ROC-AUC`") * 100).alias("ROC-AUC (%)"),
        (F.col("`PR-AUC`") * 100).alias("PR-AUC (%)"), "Brier score", "Setup",
    )
    return main_out.orderBy("Rank", "Result"), sup.orderBy("Rank", "Result")


def format_metric_text(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """M-17 applied to a result table: the given numeric columns as display text."""
    return df.select(*[format_decimal(F.col(f"`{c}`")).alias(c) if c in columns else F.col(f"`{c}`") for c in df.columns])


def top_k_text(df: DataFrame) -> DataFrame:
    """G-16 display: ``ig_top_k`` text with ``all`` for NULL."""
    return df.withColumn("ig_top_k", top_k_label(F.col("top_k")))


__all__ = [
    "rank_grid", "rank_defaults", "screened_feature_count", "best_by_feature_count", "params_from_row",
    "default_vs_grid", "four_setup_summaries", "prediction_table", "final_ranking", "format_metric_text",
    "top_k_text", "REPORT_METRICS",
]
