"""Cross-validated evaluation, default screening and the resumable grid search
(G-2 .. G-11, G-21, G-24 .. G-28).

A grid combination never becomes a driver loop over folds: every (combination,
fold) pair is a model id inside one training batch, and combinations that differ
only in ``n_estimators`` share one boosting path (predictions are recorded at each
requested round). Progress is appended per batch, keyed by a configuration
signature, so a killed run resumes with an anti join.
"""

from __future__ import annotations

import hashlib
from dataclasses import asdict, replace

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cvforge.functions.fingerprints import dataset_fingerprint
from cvforge.operators.boost import Binned, ModelSpec, bin_features, probabilities, train
from cvforge.operators.metrics import fold_metric_table, fold_summary
from cvforge.operators.report import rank_grid
from cvforge.session import reliable_checkpoint, shared_root, write_shared
from cvforge.sources.progress import append_progress, read_progress
from cvforge.spec import REPORT_METRICS, SCHEMA_VERSION, BoostParams, GridSpec, RunConfig

GRID_KEYS = ("top_k", "learning_rate", "max_depth", "n_estimators", "subsample", "colsample_bytree")
MAX_STATE_ROWS = 50_000_000  # rows x models x trees held by one training batch


def grid_combinations(spark: SparkSession, grid: GridSpec) -> DataFrame:
    """G-2: Cartesian product of the six axes, built with ``explode`` (no join)."""
    top = grid.normalized_top_k()
    df = spark.range(1).select(F.explode(F.array(*[F.lit(k).cast("int") for k in top])).alias("top_k"))
    for name, values, typ in (
        ("learning_rate", grid.learning_rates, "double"),
        ("max_depth", grid.max_depths, "int"),
        ("n_estimators", grid.n_estimators, "int"),
        ("subsample", grid.subsamples, "double"),
        ("colsample_bytree", grid.colsample_bytree, "double"),
    ):
        df = df.withColumn(name, F.explode(F.array(*[F.lit(v).cast(typ) for v in values])))
    return df


def grid_key(df: DataFrame) -> DataFrame:
    """G-3: text key of a combination (``all`` for NULL top_k)."""
    parts = [F.coalesce(F.col("top_k").cast("string"), F.lit("all"))] + [F.col(c).cast("string") for c in GRID_KEYS[1:]]
    return df.withColumn("grid_key", F.concat_ws("|", *parts))


def check_grid_top_k(grid: GridSpec) -> None:
    """G-4: the grid needs ``all`` and at least one numeric feature count."""
    top = grid.normalized_top_k()
    if None not in top or not [k for k in top if k is not None]:
        raise ValueError("a grid compares all features (None) with at least one feature count; top_k lacks one of them")


def _same_key(left: DataFrame, right: DataFrame):
    return [left[c].eqNullSafe(right[c]) for c in GRID_KEYS]


def latest_within_grid(progress: DataFrame, combos: DataFrame) -> DataFrame:
    """G-6: completed rows of the current grid, last write (highest ``seq``) wins."""
    inside = progress.join(combos, [progress[c].eqNullSafe(combos[c]) for c in GRID_KEYS], "left_semi")
    w = Window.partitionBy(*GRID_KEYS).orderBy(F.col("seq").desc())
    return inside.withColumn("_r", F.row_number().over(w)).where(F.col("_r") == 1).drop("_r")


def pending_combinations(combos: DataFrame, completed: DataFrame) -> DataFrame:
    """G-5: grid minus completed, on typed keys (NULL top_k matches NULL)."""
    return combos.join(completed, _same_key(combos, completed), "left_anti")


def configuration_signature(config: dict) -> str:
    """G-28: one text for everything that decides a stored result: name and value of each
    setting, sorted by name, under the layout version of the progress table."""
    lines = [f"layout {SCHEMA_VERSION}"] + [f"{name} = {config[name]!r}" for name in sorted(config)]
    return hashlib.blake2b("\n".join(lines).encode(), digest_size=16).hexdigest()


def fit_plan(grid: GridSpec, screen_top_k: tuple[int | None, ...], cv_splits: int) -> list[tuple[str, int]]:
    """G-25: planned model fits."""
    screening = len(screen_top_k) * cv_splits
    combos = len(grid.normalized_top_k()) * grid.hyperparameter_combinations()
    return [
        ("feature_count_screening_fits", screening),
        ("grid_search_combinations", combos),
        ("grid_search_fits", combos * cv_splits),
        ("final_oof_prediction_fits", cv_splits),
        ("total_planned_model_fits", screening + combos * cv_splits + cv_splits),
    ]


# ---- cross-validated evaluation ------------------------------------------------------------


def fold_feature_lists(fold_ig: DataFrame) -> dict[int, list[str]]:
    """Ranked feature names per fold (K x features rows: model metadata, not data)."""
    ranks: dict[int, list[tuple[int, str]]] = {}
    for r in fold_ig.select("fold", "rank", "feature").collect():
        ranks.setdefault(r["fold"], []).append((r["rank"], r["feature"]))
    return {f: [n for _, n in sorted(v)] for f, v in ranks.items()}


def _selected(ranked: list[str], top_k: int | None) -> list[str]:
    return list(ranked) if top_k is None else ranked[: min(int(top_k), len(ranked))]


def evaluate_combinations(
    binned: Binned,
    fold_lists: dict[int, list[str]],
    combos: list[dict],
    n_classes: int,
    positive_label: int | None,
    base: BoostParams = BoostParams(),
    max_state_rows: int = MAX_STATE_ROWS,
    n_rows: int | None = None,
    keep_index: bool = False,
) -> DataFrame:
    """G-8 / G-9: cross-validate each combination; returns one row per combination with
    the six grid keys and mean/std (population) of the nine metrics over folds
    (plus ``_combo``, the position in ``combos``, when ``keep_index``)."""
    spark = binned.df.sparkSession
    index = {f: i for i, f in enumerate(binned.features)}
    all_features = list(binned.features)
    folds = sorted(fold_lists)
    # combinations differing only in n_estimators share one boosting path
    paths: dict[tuple, list[int]] = {}
    for ci, c in enumerate(combos):
        key = (c["top_k"], c["learning_rate"], c["max_depth"], c["subsample"], c["colsample_bytree"])
        paths.setdefault(key, []).append(ci)
    models: list[ModelSpec] = []
    record: dict[int, list[int]] = {}
    mapping: list[tuple[int, int, int]] = []  # (model_id, round, combo index)
    for key, members in paths.items():
        top_k, lr, depth, sub, col = key
        rounds = sorted({combos[ci]["n_estimators"] for ci in members})
        params = replace(base, learning_rate=lr, max_depth=depth, subsample=sub, colsample_bytree=col, n_estimators=rounds[-1])
        for f in folds:
            names = all_features if top_k is None else _selected(fold_lists[f], top_k)
            mid = len(models)
            models.append(ModelSpec(mid, f, tuple(sorted(index[n] for n in names)), params))
            record[mid] = rounds
            for ci in members:
                mapping.append((mid, combos[ci]["n_estimators"], ci))
    n_trees = 1 if n_classes == 2 else n_classes
    n_rows = n_rows or binned.rows()
    # batch size: state rows (rows x models x trees), which also bound the open nodes of a level
    by_state = max_state_rows // max(1, n_rows * n_trees)
    per_batch = max(len(folds), by_state // len(folds) * len(folds))
    snaps = []
    for start in range(0, len(models), per_batch):
        batch = models[start : start + per_batch]
        res = train(binned, batch, n_classes, record_rounds={m.model_id: record[m.model_id] for m in batch}, keep_trees=False, held_out_only=True)
        snaps.append(res.snapshots)
    snap = snaps[0]
    for s in snaps[1:]:
        snap = snap.unionByName(s)
    oof = probabilities(snap.where(~F.col("in_train")), n_classes, keys=("model_id", "round", "row_id"))
    scored = oof.select(
        "model_id", "round", "fold", "y", "pred",
        (F.element_at("probability", (positive_label if positive_label is not None else 1) + 1)).alias("score"),
    )
    # the metrics read them several times; unwritten, all rows would walk all models' trees each time
    scored = write_shared(scored, "scored")
    fm = fold_metric_table(
        scored, n_classes, positive_label, extra_keys=("model_id", "round"), score="score" if n_classes == 2 else None
    )
    # (model, round) -> combination: bounded by the number of fits in the batch
    link = spark.createDataFrame(mapping, "model_id int, round int, _combo int")
    per_combo = fm.join(F.broadcast(link), ["model_id", "round"]).drop("model_id", "round")
    summary = fold_summary(per_combo, keys=["_combo"])
    combo_rows = [
        (i, c["top_k"], float(c["learning_rate"]), int(c["max_depth"]), int(c["n_estimators"]),
         float(c["subsample"]), float(c["colsample_bytree"]))
        for i, c in enumerate(combos)
    ]
    cdf = spark.createDataFrame(
        combo_rows,
        "_combo int, top_k int, learning_rate double, max_depth int, n_estimators int, subsample double, colsample_bytree double",
    )
    out = cdf.join(summary, "_combo")
    index = ["_combo"] if keep_index else []
    return out.select(*index, *GRID_KEYS, *[x for m in REPORT_METRICS for x in (f"mean_cv_{m}", f"std_cv_{m}")])


def default_combinations(top_k_values: tuple[int | None, ...], base: BoostParams = BoostParams()) -> list[dict]:
    """G-9 inputs: default parameters once per feature count."""
    return [
        {"top_k": k, "learning_rate": base.learning_rate, "max_depth": base.max_depth, "n_estimators": base.n_estimators,
         "subsample": base.subsample, "colsample_bytree": base.colsample_bytree}
        for k in top_k_values
    ]


def shape_default_screen(results: DataFrame, top_k_values: tuple[int | None, ...]) -> DataFrame:
    """G-10 output: input position (for stable ranking), labels and the metric summary."""
    pos = results.sparkSession.createDataFrame([(i, k) for i, k in enumerate(top_k_values)], "position int, top_k int")
    res = results.join(pos, results["top_k"].eqNullSafe(pos["top_k"])).drop(pos["top_k"])
    return res.select(
        "position", "top_k", F.lit("default_xgboost").alias("model_type"),
        F.lit("xgboost_defaults").alias("hyperparameter_setup"),
        *[x for m in REPORT_METRICS for x in (f"mean_cv_{m}", f"std_cv_{m}")],
    )


def default_screen(
    binned: Binned,
    fold_lists: dict[int, list[str]],
    top_k_values: tuple[int | None, ...],
    n_classes: int,
    positive_label: int | None,
    base: BoostParams = BoostParams(),
) -> DataFrame:
    """G-10: default parameters for every feature count; position kept for stable ranking."""
    res = evaluate_combinations(binned, fold_lists, default_combinations(top_k_values, base), n_classes, positive_label, base)
    return shape_default_screen(res, top_k_values)


PATH_KEYS = tuple(k for k in GRID_KEYS if k != "n_estimators")


def path_batches(pending: list[dict], size: int) -> list[list[dict]]:
    """Combinations in batches of about ``size`` that never part those which differ only in
    ``n_estimators``: they share one boosting path, which so trains once."""
    place = lambda c: tuple((c[k] is not None, c[k] or 0) for k in (*PATH_KEYS, "n_estimators"))
    batches: list[list[dict]] = []
    last = None
    for c in sorted(pending, key=place):
        path = tuple(c[k] for k in PATH_KEYS)
        if not batches or (len(batches[-1]) >= size and path != last):
            batches.append([])
        batches[-1].append(c)
        last = path
    return batches


def run_grid_search(
    binned: Binned,
    fold_lists: dict[int, list[str]],
    grid: GridSpec,
    n_classes: int,
    positive_label: int | None,
    config: RunConfig = RunConfig(),
    base: BoostParams = BoostParams(),
    progress_path: str | None = None,
    signature: str | None = None,
    batch_size: int | None = None,
    max_batches: int | None = None,
    extra_combos: list[dict] | None = None,
):
    """G-11: evaluate pending combinations in batches, append each batch, resume by anti join.

    Returns the ranked grid (G-12) once every combination is complete; raises (G-7)
    while combinations remain (e.g. when ``max_batches`` stopped the run early).
    ``extra_combos`` (e.g. the default screen) train in the same jobs as the first
    batch; they are not written to the progress table and are returned as a second
    DataFrame: ``(ranked, extra_results)``.
    """
    spark = binned.df.sparkSession
    check_grid_top_k(grid)
    combos = grid_combinations(spark, grid)
    if signature is None:
        signature = configuration_signature(
            {"grid": asdict(grid), "base": asdict(base), "folds": config.cv_splits, "seed": config.seed,
             "metric": config.selection_metric, "features": binned.features, "selected": fold_lists,
             "classes": n_classes, "positive": positive_label, "exact": binned.missing_bin is not None,
             "data": dataset_fingerprint(binned.df), "cuts": dataset_fingerprint(binned.thresholds)}
        )
    if progress_path is None:
        progress_path = f"{shared_root(spark)}/grid_progress"
    done = latest_within_grid(read_progress(spark, progress_path, signature), combos)
    # the pending list is bounded by the grid configuration, not by the data
    pending = [r.asDict() for r in pending_combinations(combos, done).collect()]
    batches = path_batches(pending, batch_size or config.progress_every)
    start_seq = read_progress(spark, progress_path, signature).agg(F.max("seq")).first()[0]
    batch_no = ((start_seq or 0) >> 40) + 1
    extra = list(extra_combos or [])
    extra_rows = None
    for i, batch in enumerate(batches):
        if max_batches is not None and i >= max_batches:
            break
        rows = evaluate_combinations(
            binned, fold_lists, batch + extra, n_classes, positive_label, base, keep_index=True
        )
        if extra:
            extra_rows = reliable_checkpoint(rows.where(F.col("_combo") >= len(batch)).drop("_combo"))
            extra = []
        grid_rows = rows.where(F.col("_combo") < len(batch)).drop("_combo")
        append_progress(grid_rows.withColumn("status", F.lit("completed")), progress_path, signature, batch_no << 40)
        batch_no += 1
    if extra:  # nothing was pending (fully resumed): evaluate the extras alone
        extra_rows = evaluate_combinations(binned, fold_lists, extra, n_classes, positive_label, base)
    final = latest_within_grid(read_progress(spark, progress_path, signature), combos)
    remaining = pending_combinations(combos, final).count()
    if remaining:
        raise RuntimeError(f"{remaining} grid combinations have no result yet; run again to go on")
    ranked = rank_grid(final.drop("seq", "signature"), config.selection_metric)
    return ranked if extra_combos is None else (ranked, extra_rows)


def oof_predictions(
    binned: Binned,
    fold_lists: dict[int, list[str]],
    params: dict,
    n_classes: int,
    base: BoostParams = BoostParams(),
) -> DataFrame:
    """G-21 / G-24: one model per fold with the given setup; out-of-fold probabilities and classes."""
    index = {f: i for i, f in enumerate(binned.features)}
    p = replace(
        base,
        learning_rate=params["learning_rate"], max_depth=params["max_depth"], n_estimators=params["n_estimators"],
        subsample=params["subsample"], colsample_bytree=params["colsample_bytree"],
    )
    models = []
    for f in sorted(fold_lists):
        names = list(binned.features) if params["top_k"] is None else _selected(fold_lists[f], params["top_k"])
        models.append(ModelSpec(f, f, tuple(sorted(index[n] for n in names)), p))
    last = {m.model_id: [p.n_estimators] for m in models}
    res = train(binned, models, n_classes, record_rounds=last, keep_trees=False, held_out_only=True)
    return probabilities(res.snapshots.drop("round"), n_classes)


__all__ = [
    "grid_combinations", "grid_key", "check_grid_top_k", "latest_within_grid", "pending_combinations",
    "dataset_fingerprint", "configuration_signature", "fit_plan", "fold_feature_lists", "evaluate_combinations",
    "default_screen", "default_combinations", "shape_default_screen", "run_grid_search", "oof_predictions", "bin_features",
]


def default_model_report(
    binned: Binned,
    fold_lists: dict[int, list[str]],
    top_k: int | None,
    n_classes: int,
    positive_label: int | None,
    base: BoostParams = BoostParams(),
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """G-24: default parameters for one feature count -> (fold metrics, fold means, pooled OOF scores)."""
    from cvforge.operators.metrics import classification_scores

    params = {"top_k": top_k, "learning_rate": base.learning_rate, "max_depth": base.max_depth,
              "n_estimators": base.n_estimators, "subsample": base.subsample, "colsample_bytree": base.colsample_bytree}
    probs = oof_predictions(binned, fold_lists, params, n_classes, base)
    pos = positive_label if positive_label is not None else 1
    scored = probs.select("fold", "y", "pred", F.element_at("probability", pos + 1).alias("score"))
    score = "score" if n_classes == 2 else None
    fm = fold_metric_table(scored, n_classes, positive_label, score=score)
    return fm, fold_summary(fm), classification_scores(scored, [], n_classes, positive_label, score=score)
