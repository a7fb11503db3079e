"""Full workflow: screen feature counts with defaults, tune the grid, compare the
four setups and produce out-of-fold predictions for the winner."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cvforge.operators.boost import Binned, bin_features
from cvforge.operators.infogain import fold_information_gain, fold_selection_table, selection_frequency
from cvforge.operators.metrics import classification_scores, fold_metric_table
from cvforge.operators.report import (
    best_by_feature_count,
    default_vs_grid,
    final_ranking,
    four_setup_summaries,
    params_from_row,
    prediction_table,
    rank_defaults,
    screened_feature_count,
    winner,
)
from cvforge.operators.search import (
    default_combinations,
    fold_feature_lists,
    oof_predictions,
    run_grid_search,
    shape_default_screen,
)
from cvforge.plans.prepare import Prepared
from cvforge.session import reliable_checkpoint
from cvforge.spec import BoostParams, GridSpec, RunConfig


@dataclass
class WorkflowResult:
    fold_ig: DataFrame
    defaults: DataFrame  # ranked default screen
    screened: DataFrame  # G-14 row
    grid: DataFrame  # ranked grid
    best_by_count: DataFrame
    comparison: DataFrame
    main_summary: DataFrame
    supporting_summary: DataFrame
    final_main: DataFrame
    final_supporting: DataFrame
    predictions: DataFrame
    fold_metrics: DataFrame
    fold_selection: DataFrame
    selection_frequency: DataFrame
    oof_scores: DataFrame
    best_params: dict


def run_workflow(
    p: Prepared,
    grid: GridSpec,
    config: RunConfig = RunConfig(),
    base: BoostParams = BoostParams(),
    exact: bool = False,
    progress_path: str | None = None,
) -> WorkflowResult:
    """Histogram binning with ``base.max_bin`` cut points, or every distinct value with ``exact``."""
    tenc = p.encoded.target
    fold_ig = reliable_checkpoint(
        fold_information_gain(p.folded, p.features, p.target, p.n_classes, p.k, roles=p.roles(), nullable=p.nullable)
    )
    lists = fold_feature_lists(fold_ig)
    binned = bin_features(p.folded, p.features, p.target, max_bin=None if exact else base.max_bin)
    binned = Binned(reliable_checkpoint(binned.df), binned.thresholds, binned.features, binned.missing_bin)

    # the default screen (G-10) trains in the same jobs as the grid's first batch
    top_k_values = grid.normalized_top_k()
    ranked, default_rows = run_grid_search(
        binned, lists, grid, p.n_classes, tenc.positive_label, config, base, progress_path,
        extra_combos=default_combinations(top_k_values, base),
    )
    ranked = reliable_checkpoint(ranked)
    defaults = reliable_checkpoint(
        rank_defaults(shape_default_screen(default_rows, top_k_values), config.selection_metric)
    )
    screened = screened_feature_count(defaults, config.selection_metric)
    by_count = best_by_feature_count(ranked, config.selection_metric)
    comparison = reliable_checkpoint(default_vs_grid(by_count, defaults, config.selection_metric))
    main, supporting = four_setup_summaries(comparison, len(p.features), config.final_metric)

    # the final setup: best tuned row among numeric feature counts
    tuned = comparison.where((F.col("model_type") == "best_grid_search") & F.col("top_k").isNotNull())
    best = params_from_row(winner(tuned, len(p.features), config.final_metric).first())
    probs = reliable_checkpoint(oof_predictions(binned, lists, best, p.n_classes, base))
    pos = tenc.positive_label if tenc.positive_label is not None else 1
    scored = probs.select("fold", "y", "pred", F.element_at("probability", pos + 1).alias("score"))
    score_col = "score" if p.n_classes == 2 else None
    fold_metrics = fold_metric_table(scored, p.n_classes, tenc.positive_label, score=score_col)
    oof_scores = classification_scores(scored, [], p.n_classes, tenc.positive_label, score=score_col)
    final_main, final_supporting = final_ranking(main, supporting)
    return WorkflowResult(
        fold_ig=fold_ig,
        defaults=defaults,
        screened=screened,
        grid=ranked,
        best_by_count=by_count,
        comparison=comparison,
        main_summary=main,
        supporting_summary=supporting,
        final_main=final_main,
        final_supporting=final_supporting,
        predictions=prediction_table(probs, tenc.classes),
        fold_metrics=fold_metrics,
        fold_selection=fold_selection_table(fold_ig, p.folded, best["top_k"], feature_order=p.features),
        selection_frequency=selection_frequency(fold_ig, best["top_k"], p.k),
        oof_scores=oof_scores,
        best_params=best,
    )
