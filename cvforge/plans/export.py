"""Write a finished workflow: every result table plus one run-metadata JSON (S-4, S-5)."""

from __future__ import annotations


from cvforge.functions.columns import round_metric_columns
from cvforge.functions.fingerprints import dataset_fingerprint
from cvforge.operators.audit import cleaning_stats
from cvforge.operators.encode import feature_role_table
from cvforge.operators.report import winner
from cvforge.operators.search import configuration_signature, fit_plan
from cvforge.plans.prepare import Prepared
from cvforge.plans.workflow import WorkflowResult
from cvforge.sources.tables import seal_tables, write_metadata, write_table
from cvforge.spec import BoostParams, GridSpec, RunConfig

# Artifact names of the workflow's output folder.
OUTPUT_NAMES = (
    "feature_encoding_roles",
    "encoded_classification_dataset",
    "encoded_feature_encoding_roles",
    "default_feature_count_screening",
    "grid_search_results",
    "best_grid_search_parameters",
    "default_vs_grid_search_by_feature_count",
    "best_selected_features_by_fold",
    "best_selected_feature_frequency",
    "best_fold_metrics",
    "classification_main_summary",
    "classification_supporting_summary",
    "best_cv_predictions",
    "run_metadata",
)


def export_results(
    p: Prepared,
    w: WorkflowResult,
    out_dir: str,
    grid: GridSpec,
    config: RunConfig = RunConfig(),
    base: BoostParams = BoostParams(),
    fmt: str = "parquet",
    data_path: str | None = None,
    run_name: str | None = None,
    progress_path: str | None = None,
    exact: bool = False,
) -> dict[str, str]:
    """Write each table to ``out_dir/<name>``; returns name -> path.

    ``run_seal`` binds the tables to the configuration and the input: ``sources.tables.verify_tables`` tells
    whether they are what this run wrote. ``exact`` as given to ``run_workflow``.
    """
    spark = p.folded.sparkSession
    out = out_dir.rstrip("/")
    spec = p.binding.spec
    source_features = [c for c in p.clean.columns if c != spec.target and c not in set(spec.exclude)]
    best = spark.createDataFrame([tuple(w.best_params[k] for k in w.best_params)], ", ".join(
        f"{k} {'int' if k in ('top_k', 'max_depth', 'n_estimators') else 'double'}" for k in w.best_params
    ))
    tables = {
        "feature_encoding_roles": feature_role_table(p.clean, spec, source_features),
        "encoded_classification_dataset": p.encoded.df,
        "encoded_feature_encoding_roles": p.encoded.roles(spark),
        "default_feature_count_screening": round_metric_columns(w.defaults),
        "grid_search_results": round_metric_columns(w.grid),
        "best_grid_search_parameters": best,
        "default_vs_grid_search_by_feature_count": round_metric_columns(w.comparison),
        "best_selected_features_by_fold": w.fold_selection,
        "best_selected_feature_frequency": round_metric_columns(w.selection_frequency),
        "best_fold_metrics": round_metric_columns(w.fold_metrics),
        "classification_main_summary": w.main_summary.orderBy("_order").drop("_order"),
        "classification_supporting_summary": w.supporting_summary.orderBy("_order").drop("_order"),
        "best_cv_predictions": w.predictions,
    }
    paths = {}
    for name, df in tables.items():
        path = f"{out}/{name}"
        write_table(df, path, fmt=fmt)
        paths[name] = path
    stats = cleaning_stats(p.binding.raw).first().asDict()
    screened = w.screened.first()
    default = winner(w.comparison.where("model_type = 'default_xgboost' and top_k is not null"), len(p.features), config.final_metric).first()
    top_k_text = lambda k: "all" if k is None else k
    tree_method = "exact" if exact else "hist"
    signature = configuration_signature(
        {"grid": grid, "run": config, "base": base, "spec": spec, "cv_splits": p.k, "tree_method": tree_method}
    )
    source = dataset_fingerprint(p.binding.raw)
    sealed = seal_tables(spark, out, list(tables), signature, source, fmt)
    metadata = {
        "data_path": data_path,
        "run_name": run_name,
        "grid_search_progress_path": progress_path,
        "progress_every": config.progress_every,
        "tree_method": tree_method,
        "checkpoint_signature": signature,
        "input_fingerprint": source,
        "run_digest": sealed,
        "feature_encoding_roles": [r.asDict() for r in tables["feature_encoding_roles"].collect()],  # one row a column
        "selected_grid_ig_top_k": top_k_text(w.best_params["top_k"]),
        "grid_feature_setups": [top_k_text(k) for k in grid.normalized_top_k()],
        "best_default_ig_top_k": top_k_text(default["top_k"]) if default else "all",
        "target_col": spec.target,
        "exclude_features": list(spec.exclude),
        "cv_splits": p.k,
        "positive_class": p.encoded.target.positive_class,
        "selection_metric": config.selection_metric,
        "preprocessing_stats": stats,
        "encoded_feature_encoding_roles": [
            dict(zip(("source_feature", "encoded_feature", "source_role", "encoded_role", "encoding"), r))
            for r in p.encoded.role_rows
        ],
        "encoded_feature_count": len(p.features),
        "seed": config.seed,
        "feature_count_screening_options": ["all" if k is None else k for k in grid.normalized_top_k()],
        "default_screened_ig_top_k": screened["top_k"],
        "param_grid": {
            "ig_top_k": ["all" if k is None else k for k in grid.normalized_top_k()],
            "learning_rate": list(grid.learning_rates),
            "max_depth": list(grid.max_depths),
            "n_estimators": list(grid.n_estimators),
            "subsample": list(grid.subsamples),
            "colsample_bytree": list(grid.colsample_bytree),
        },
        **dict(fit_plan(grid, grid.normalized_top_k(), p.k)),
        "fixed_booster_params": {
            "base_score": base.base_score, "gamma": base.gamma, "min_child_weight": base.min_child_weight,
            "reg_alpha": base.reg_alpha, "reg_lambda": base.reg_lambda,
            "scale_pos_weight": base.scale_pos_weight, "max_bin": base.max_bin,
        },
        "target_metadata": {
            "classes": p.encoded.target.classes,
            "positive_class": p.encoded.target.positive_class,
            "positive_label": p.encoded.target.positive_label,
            "label_mapping": p.encoded.target.mapping,
        },
        "best_params": {k: ("all" if (k == "top_k" and v is None) else v) for k, v in w.best_params.items()},
        "selected_features": list(p.features)
        if w.best_params["top_k"] is None
        else [r["feature"] for r in w.selection_frequency.orderBy("rank").collect()][: w.best_params["top_k"]],
    }
    path = f"{out}/run_metadata"
    write_metadata(spark, metadata, path)
    paths["run_metadata"] = path
    return paths
