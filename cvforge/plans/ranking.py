"""Progress, ranking and reporting operators over a progress table made of ``lineitem``.

Every row of ``lineitem`` falls under a parameter combination given by its keys and
belongs to a write of that combination (its line number) and to a run signature (its
return flag). The metrics of a write are averages over its rows, cut to few steps so that
ties are common. Each query is paired with SQL that recomputes it from the table.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cvforge.functions.columns import format_decimal
from cvforge.operators.report import (
    best_by_feature_count,
    default_vs_grid,
    final_ranking,
    four_setup_summaries,
    params_from_row,
    prediction_table,
    rank_defaults,
    rank_grid,
    screened_feature_count,
    top_k_text,
)
from cvforge.operators.search import (
    GRID_KEYS,
    fit_plan,
    grid_combinations,
    grid_key,
    latest_within_grid,
    pending_combinations,
)
from cvforge.session import checkpoint_dir
from cvforge.sources.progress import append_progress, read_progress, stage_batch
from cvforge.spec import REPORT_METRICS, GridSpec

#: The grid asked for; the table also holds combinations outside it and lacks some inside.
GRID = GridSpec(
    top_k=(None, 2, 3, 5, 3),
    learning_rates=(0.05, 0.1, 0.3),
    max_depths=(4, 6, 8),
    n_estimators=(100, 300),
    subsamples=(0.8, 1.0),
    colsample_bytree=(0.8, 1.0),
)
N_FEATURES = 5
#: (metric, column, rows per step, divisor): floor(average / step) / divisor.
STEPS = {
    "accuracy": ("l_quantity", 2, 20),
    "precision": ("l_partkey % 97", 5, 30),
    "recall": ("l_suppkey % 89", 5, 30),
    "specificity": ("l_orderkey % 83", 5, 30),
    "f1_score": ("l_partkey % 11", 1, 20),
    "roc_auc": ("l_orderkey % 13", 1, 20),
    "mcc": ("l_suppkey % 17", 1, 20),
    "pr_auc": ("l_orderkey % 7", 1, 10),
    "brier_score": ("l_partkey % 19", 2, 20),
}

KEY_SQL = {
    "top_k": "CASE l_partkey % 5 WHEN 0 THEN NULL WHEN 1 THEN 2 WHEN 2 THEN 3 WHEN 3 THEN 5 ELSE 9 END",
    "learning_rate": "CASE l_suppkey % 3 WHEN 0 THEN 0.05 WHEN 1 THEN 0.1 ELSE 0.3 END",
    "max_depth": "CASE l_orderkey % 2 WHEN 0 THEN 4 ELSE 6 END",
    "n_estimators": "CASE WHEN l_partkey % 7 < 3 THEN 100 WHEN l_partkey % 7 < 6 THEN 300 ELSE 500 END",
    "subsample": "CASE l_suppkey % 2 WHEN 0 THEN 0.8 ELSE 1.0 END",
    "colsample_bytree": "CASE WHEN l_orderkey % 3 < 2 THEN 0.8 ELSE 1.0 END",
}
KEY_TYPES = {"top_k": "int", "learning_rate": "double", "max_depth": "int", "n_estimators": "int", "subsample": "double", "colsample_bytree": "double"}
SIGNATURE = "A"


def _metrics(prefix: str = "") -> dict[str, str]:
    """SQL of each mean and std, the same text for both engines."""
    out = {}
    for m, (c, step, of) in STEPS.items():
        average = f"CAST(sum(CAST({c} AS BIGINT)) AS DOUBLE) / count(*)"
        out[f"mean_cv_{m}"] = f"CAST(floor({average} / {step}) AS DOUBLE) / {of}"
        out[f"std_cv_{m}"] = f"CAST(count(*) % {of} AS DOUBLE) / {of * 4}"
    return out


def progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Progress rows as ``sources.progress`` stores them, of all signatures and writes."""
    li = spark.read.parquet(f"{sf_dir.rstrip('/')}/lineitem.parquet")
    keyed = li.selectExpr("*", *[f"CAST({e} AS {KEY_TYPES[k]}) AS {k}" for k, e in KEY_SQL.items()])
    found = keyed.groupBy(*GRID_KEYS, F.col("l_returnflag").alias("signature"), F.col("l_linenumber").cast("long").alias("seq"))
    return found.agg(*[F.expr(e).alias(n) for n, e in _metrics().items()], F.lit("completed").alias("status"))


def stored_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S-2, S-3: one committed batch for each write of this run, one that was never committed, and what a reader sees."""
    path = f"{checkpoint_dir(spark)}/progress-{uuid.uuid4().hex}"
    writes = progress(spark, sf_dir)
    own = writes.where(F.col("signature") == SIGNATURE)
    for (seq,) in own.select("seq").distinct().collect():  # line numbers, 1 to 7
        append_progress(own.where(F.col("seq") == seq), path, SIGNATURE, seq << 40)
    append_progress(writes.where("signature = 'N'"), path, "N", 1 << 40)
    stage_batch(own, path, SIGNATURE)
    seen = read_progress(spark, path, SIGNATURE)
    return seen.withColumn("seq", F.shiftright("seq", 40))


def own_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G-28: the writes under this run's signature only."""
    return progress(spark, sf_dir).where(F.col("signature") == SIGNATURE)


def latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_within_grid(own_progress(spark, sf_dir), grid_combinations(spark, GRID))


def ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rank_grid(latest(spark, sf_dir).drop("seq", "signature", "status"))


def defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each feature count: the averages over all rows of that count."""
    li = spark.read.parquet(f"{sf_dir.rstrip('/')}/lineitem.parquet")
    keyed = li.selectExpr("*", f"CAST({KEY_SQL['top_k']} AS int) AS top_k")
    found = keyed.groupBy("top_k").agg(*[F.expr(e).alias(n) for n, e in _metrics().items()])
    position = F.expr(POSITION)
    return rank_defaults(found.withColumn("position", position.cast("int")))


POSITION = "CASE WHEN top_k IS NULL THEN 0 WHEN top_k = 5 THEN 1 WHEN top_k = 2 THEN 2 WHEN top_k = 9 THEN 3 ELSE 4 END"


def comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    return default_vs_grid(best_by_feature_count(ranked(spark, sf_dir)), defaults(spark, sf_dir))


def setups(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    main, supporting = four_setup_summaries(comparison(spark, sf_dir), N_FEATURES)
    return main.drop("_order"), supporting.drop("_order")


def coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G-2/G-3: every combination of the grid with its text key and the number of its writes."""
    combos = grid_combinations(spark, GRID)
    own = own_progress(spark, sf_dir)
    counted = own.groupBy(*[F.col(k).alias(f"p_{k}") for k in GRID_KEYS]).agg(F.count("*").alias("n"))
    on = [combos[k].eqNullSafe(counted[f"p_{k}"]) for k in GRID_KEYS]
    joined = combos.join(counted, on, "left")
    parts = grid_key(joined.select(*GRID_KEYS, F.coalesce("n", F.lit(0)).alias("writes")))
    return parts


def planned_fits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G-25 of the grid whose axes are the values found in the table."""
    row = progress(spark, sf_dir).agg(*[F.sort_array(F.collect_set(k)).alias(k) for k in GRID_KEYS], F.max(F.col("top_k").isNull()).alias("all")).first()
    top_k = tuple(row["top_k"]) + ((None,) if row["all"] else ())
    grid = GridSpec(top_k, *(tuple(row[k]) for k in GRID_KEYS[1:]))
    return spark.createDataFrame(fit_plan(grid, top_k, 10), "item string, fits long")


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G-22 for a fixed probability of return made of discount and tax."""
    from cvforge.plans.registry import scored

    p, _ = scored(spark, sf_dir, "lineitem")
    score: Column = F.least(F.greatest(F.col("l_discount") * 5.0 + F.col("l_tax") * 5.0, F.lit(0.0)), F.lit(1.0))
    rows = p.folded.select("row_id", "fold", F.col(p.target).alias("y"), (score > 0.5).cast("int").alias("pred"), F.array(1 - score, score).alias("probability"))
    return prediction_table(rows, p.encoded.target.classes)


def display_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G-16: feature counts as text with their place in display order (``all`` first)."""
    counts = progress(spark, sf_dir).groupBy("top_k").agg(F.count("*").alias("writes"))
    by_text = top_k_text(counts)
    place = F.row_number().over(_window(F.col("top_k").asc_nulls_first()))
    return by_text.select("ig_top_k", "writes", place.alias("place"))


def best_params(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G-17: typed parameters of the best combination of each feature count."""
    rows = best_by_feature_count(ranked(spark, sf_dir)).collect()  # one row a feature count of the grid
    return spark.createDataFrame([tuple(params_from_row(r).values()) for r in rows], ", ".join(f"{k} {t}" for k, t in KEY_TYPES.items()))


def metric_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M-17: the metrics of all writes as text."""
    return progress(spark, sf_dir).select(*GRID_KEYS, "signature", "seq", *[format_decimal(F.col(m) / 7 - 0.05).alias(m) for m in TEXT_METRICS])


TEXT_METRICS = ("mean_cv_accuracy", "mean_cv_recall", "mean_cv_brier_score", "std_cv_accuracy")


def _window(*order: Column):
    from pyspark.sql import Window

    return Window.orderBy(*order)


# ---- SQL --------------------------------------------------------------------------------

_KEYS = ", ".join(GRID_KEYS)
_SEEN = ", ".join(f"CAST({e} AS {KEY_TYPES[k]}) AS {k}" for k, e in KEY_SQL.items())
_MEANS = ", ".join(f"{e} AS {n}" for n, e in _metrics().items())
_NAMES = [f"{x}_cv_{m}" for m in REPORT_METRICS for x in ("mean", "std")]
_AXES = {
    "top_k": "(VALUES (CAST(NULL AS INT)), (2), (3), (5)) a(top_k)",
    "learning_rate": "(VALUES (CAST(0.05 AS DOUBLE)), (0.1), (0.3)) b(learning_rate)",
    "max_depth": "(VALUES (4), (6), (8)) c(max_depth)",
    "n_estimators": "(VALUES (100), (300)) d(n_estimators)",
    "subsample": "(VALUES (CAST(0.8 AS DOUBLE)), (1.0)) e(subsample)",
    "colsample_bytree": "(VALUES (CAST(0.8 AS DOUBLE)), (1.0)) f(colsample_bytree)",
}
_ON = lambda l, r: " AND ".join(f"{l}.{k} IS NOT DISTINCT FROM {r}.{k}" for k in GRID_KEYS)  # noqa: E731, E741
_BEST = lambda m: f"mean_cv_{m} DESC, mean_cv_f1_score DESC, mean_cv_pr_auc DESC, mean_cv_roc_auc DESC"

BASE_SQL = f"""
keyed AS (SELECT *, {_SEEN} FROM lineitem),
progress AS (SELECT {_KEYS}, l_returnflag AS signature, CAST(l_linenumber AS BIGINT) AS seq, {_MEANS}
             FROM keyed GROUP BY {_KEYS}, l_returnflag, l_linenumber),
grid AS (SELECT * FROM {', '.join(_AXES.values())}),
own AS (SELECT * FROM progress WHERE signature = '{SIGNATURE}'),
inside AS (SELECT own.* FROM own JOIN grid ON {_ON('own', 'grid')}),
latest AS (SELECT * EXCLUDE (place) FROM (SELECT *, row_number() OVER (PARTITION BY {_KEYS} ORDER BY seq DESC) AS place FROM inside) WHERE place = 1),
ranked AS (
  SELECT CAST(row_number() OVER (ORDER BY {_BEST('accuracy')}, top_k ASC NULLS LAST, learning_rate, max_depth, n_estimators, subsample, colsample_bytree) AS INT) AS rank,
         * EXCLUDE (seq, signature) FROM latest),
by_count AS (
  SELECT * EXCLUDE (place) FROM (SELECT *, row_number() OVER (PARTITION BY top_k ORDER BY {_BEST('accuracy')}, rank) AS place FROM ranked) WHERE place = 1),
defaults AS (
  SELECT CAST(row_number() OVER (ORDER BY {_BEST('accuracy')}, position) AS INT) AS default_rank, * FROM (
    SELECT *, CAST({POSITION} AS INT) AS position FROM (SELECT top_k, {_MEANS} FROM keyed GROUP BY top_k)))"""

_SHOWN = ["accuracy", "precision", "recall", "specificity", "f1_score", "mcc", "roc_auc", "pr_auc", "brier_score"]
_SIX = ", ".join(f"mean_cv_{m}" for m in _SHOWN) + ", std_cv_accuracy"
_TEXT = ", ".join(f"CAST({k} AS VARCHAR) AS {k}" for k in GRID_KEYS[1:])
COMPARE_SQL = (
    BASE_SQL
    + f""",
both_kinds AS (
  SELECT top_k, 'default_xgboost' AS model_type, 'XGBoost defaults' AS hyperparameter_setup, mean_cv_accuracy AS mean_cv_selection_score, {_SIX},
         {', '.join(f"'xgboost_default' AS {k}" for k in GRID_KEYS[1:])}, 0 AS src FROM defaults
  UNION ALL BY NAME
  SELECT top_k, 'best_grid_search' AS model_type, 'Best grid-search combination for this feature count' AS hyperparameter_setup,
         mean_cv_accuracy AS mean_cv_selection_score, {_SIX}, {_TEXT}, 1 AS src FROM by_count),
compared AS (
  SELECT CAST(row_number() OVER (PARTITION BY top_k ORDER BY mean_cv_selection_score DESC, mean_cv_f1_score DESC, mean_cv_pr_auc DESC, mean_cv_roc_auc DESC, src) AS INT)
           AS feature_count_model_rank, * FROM both_kinds),
winners AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY model_type, top_k IS NULL ORDER BY {_BEST('accuracy')}, coalesce(top_k, {N_FEATURES})) AS place,
           CASE WHEN model_type = 'default_xgboost' THEN 'Default XGBoost' ELSE 'Best grid search' END
             || CASE WHEN top_k IS NULL THEN ' + all features' ELSE ' + best IG feature count' END AS "Result",
           CASE WHEN top_k IS NULL THEN 'All encoded features' ELSE 'Top ' || top_k || ' IG features' END AS "Feature setup"
    FROM compared) WHERE place = 1),
main AS (SELECT "Result", "Feature setup", round(mean_cv_accuracy, 4) AS "Accuracy", round(mean_cv_precision, 4) AS "Precision", round(mean_cv_recall, 4) AS "Recall",
                round(mean_cv_specificity, 4) AS "Specificity", round(mean_cv_f1_score, 4) AS "F1-score" FROM winners),
supporting AS (
  SELECT "Result", "Feature setup", round(mean_cv_mcc, 4) AS "MCC", round(mean_cv_roc_auc, 4) AS "ROC-AUC", round(mean_cv_pr_auc, 4) AS "PR-AUC",
         round(mean_cv_brier_score, 4) AS "Brier score",
         CASE WHEN model_type = 'default_xgboost' THEN 'Untuned XGBoost' ELSE 'lr=' || learning_rate || ', depth=' || max_depth || ', n=' || n_estimators
           || ', subsample=' || subsample || ', colsample=' || colsample_bytree END AS "Setup" FROM winners)"""
)

_ALL = ", ".join([*GRID_KEYS, *_NAMES])
_PCT = lambda names: ", ".join(f'"{m}" * 100 AS "{m} (%)"' for m in names)

SQL = {
    "grid_coverage": f"WITH {BASE_SQL} SELECT {', '.join('grid.' + k for k in GRID_KEYS)}, CAST(count(own.seq) AS BIGINT) AS writes, "
    f"coalesce(CAST(grid.top_k AS VARCHAR), 'all') || '|' || {' || '.join(chr(39) + '|' + chr(39) + ' || ' + f'CAST(grid.{k} AS VARCHAR)' if i else f'CAST(grid.{k} AS VARCHAR)' for i, k in enumerate(GRID_KEYS[1:]))} AS grid_key "
    f"FROM grid LEFT JOIN own ON {_ON('grid', 'own')} GROUP BY ALL",
    "progress_latest": f"WITH {BASE_SQL} SELECT {_ALL}, seq, signature, 'completed' AS status FROM latest",
    "progress_stored": f"WITH {BASE_SQL} SELECT {_ALL}, seq, signature, 'completed' AS status FROM own",
    "progress_pending": f"WITH {BASE_SQL} SELECT {_KEYS} FROM grid WHERE NOT EXISTS (SELECT 1 FROM latest WHERE {_ON('grid', 'latest')})",
    "progress_signatures": f"WITH {BASE_SQL} SELECT signature, CAST(count(*) AS BIGINT) AS writes, CAST(count(DISTINCT ({_KEYS})) AS BIGINT) AS combinations FROM progress GROUP BY signature",
    "ranked_grid": f"WITH {BASE_SQL} SELECT rank, rank = 1 AS is_best, {_ALL} FROM ranked",
    "ranked_defaults": f"WITH {BASE_SQL} SELECT default_rank, default_rank = 1 AS is_best_default, top_k, position, {', '.join(_NAMES)} FROM defaults",
    "screened_count": f"WITH {BASE_SQL} SELECT default_rank, default_rank = 1 AS is_best_default, top_k, position, {', '.join(_NAMES)} FROM defaults "
    f"WHERE top_k IS NOT NULL ORDER BY {_BEST('accuracy')}, top_k LIMIT 1",
    "best_by_count": f"WITH {BASE_SQL} SELECT CAST(row_number() OVER (ORDER BY top_k ASC NULLS FIRST) AS INT) AS feature_count_rank, top_k, rank AS overall_grid_rank, "
    f"rank = 1 AS is_best_overall, {_SIX}, {', '.join(GRID_KEYS[1:])} FROM by_count",
    "default_vs_grid": f"WITH {COMPARE_SQL} SELECT * EXCLUDE (src), feature_count_model_rank = 1 AS is_best_for_feature_count FROM compared",
    "setup_main": f"WITH {COMPARE_SQL} SELECT * FROM main",
    "setup_supporting": f"WITH {COMPARE_SQL} SELECT * FROM supporting",
    "final_main": f'WITH {COMPARE_SQL} SELECT CAST(rank() OVER (ORDER BY "Accuracy" DESC) AS INT) AS "Rank", "Result", "Feature setup", '
    + _PCT(["Accuracy", "Precision", "Recall", "Specificity", "F1-score"])
    + " FROM main",
    "final_supporting": f'WITH {COMPARE_SQL} SELECT r."Rank", "Result", "MCC", {_PCT(["ROC-AUC", "PR-AUC"])}, "Brier score", "Setup" FROM supporting '
    'JOIN (SELECT "Result", CAST(rank() OVER (ORDER BY "Accuracy" DESC) AS INT) AS "Rank" FROM main) r USING ("Result")',
    "planned_fits": f"WITH {BASE_SQL}, n AS (SELECT count(DISTINCT coalesce(top_k, -1)) AS t, count(DISTINCT coalesce(top_k, -1)) * count(DISTINCT learning_rate) * count(DISTINCT max_depth) "
    "* count(DISTINCT n_estimators) * count(DISTINCT subsample) * count(DISTINCT colsample_bytree) AS c FROM progress) "
    "SELECT 'feature_count_screening_fits' AS item, CAST(t * 10 AS BIGINT) AS fits FROM n UNION ALL SELECT 'grid_search_combinations', c FROM n "
    "UNION ALL SELECT 'grid_search_fits', c * 10 FROM n UNION ALL SELECT 'final_oof_prediction_fits', 10 FROM n "
    "UNION ALL SELECT 'total_planned_model_fits', t * 10 + c * 10 + 10 FROM n",
    "best_params": f"WITH {BASE_SQL} SELECT {_KEYS} FROM by_count",
    "metric_text": f"WITH {BASE_SQL} SELECT {_KEYS}, signature, seq, "
    + ", ".join(
        f"CASE WHEN round({m} / 7 - 0.05, 4) = 0 THEN '0' ELSE regexp_replace(regexp_replace(printf('%.4f', round({m} / 7 - 0.05, 4)), '0+$', ''), '\\.$', '') END AS {m}"
        for m in TEXT_METRICS
    )
    + " FROM progress",
    "display_order": f"WITH {BASE_SQL} SELECT coalesce(CAST(top_k AS VARCHAR), 'all') AS ig_top_k, CAST(count(*) AS BIGINT) AS writes, "
    "CAST(row_number() OVER (ORDER BY top_k ASC NULLS FIRST) AS INT) AS place FROM progress GROUP BY top_k",
}

QUERIES = {
    "grid_coverage": coverage,
    "progress_latest": lambda s, d: latest(s, d),
    "progress_stored": stored_progress,
    "progress_pending": lambda s, d: pending_combinations(grid_combinations(s, GRID), latest(s, d)),
    "progress_signatures": lambda s, d: progress(s, d).groupBy("signature").agg(
        F.count("*").alias("writes"), F.count_distinct(F.struct(*GRID_KEYS)).alias("combinations")
    ),
    "ranked_grid": ranked,
    "ranked_defaults": defaults,
    "screened_count": lambda s, d: screened_feature_count(defaults(s, d)),
    "best_by_count": lambda s, d: best_by_feature_count(ranked(s, d)),
    "default_vs_grid": comparison,
    "setup_main": lambda s, d: setups(s, d)[0],
    "setup_supporting": lambda s, d: setups(s, d)[1],
    "final_main": lambda s, d: final_ranking(*setups(s, d))[0],
    "final_supporting": lambda s, d: final_ranking(*setups(s, d))[1],
    "planned_fits": planned_fits,
    "best_params": best_params,
    "metric_text": metric_text,
    "display_order": display_order,
}
