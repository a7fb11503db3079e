import json
import os

from pyspark.sql import functions as F

from cvforge.plans.datasets import Binding
from cvforge.plans.export import OUTPUT_NAMES, export_results
from cvforge.sources.tables import verify_tables
from cvforge.plans.prepare import prepare
from cvforge.plans.workflow import run_workflow
from cvforge.spec import BoostParams, FeatureSpec, GridSpec


def test_workflow_end_to_end_and_export(spark, tmp_dir):
    raw = spark.range(240).select(
        F.col("id").alias("key"),
        F.when(F.col("id") % 3 == 0, "lo").when(F.col("id") % 3 == 1, "mid").otherwise("hi").alias("level"),
        F.when(F.col("id") % 2 == 0, "a").otherwise("b").alias("kind"),
        (F.col("id") % 17).cast("double").alias("x"),
        F.when((F.col("id") % 3 == 0) | (F.col("id") % 7 == 0), "Yes").otherwise("No").alias("target"),
    )
    spec = FeatureSpec(
        target="target", positive_class="Yes", ordinal={"level": {"lo": 0, "mid": 1, "hi": 2}},
        nominal={"kind": None}, numeric=("x",), exclude=("key",), key_cols=("key",),
    )
    p = prepare(Binding("toy", raw, spec), k=3, materialize=True)
    grid = GridSpec(top_k=(None, 2), learning_rates=(0.3,), max_depths=(2,), n_estimators=(1, 2), subsamples=(1.0,), colsample_bytree=(1.0,))
    base = BoostParams(n_estimators=2, max_depth=2)
    w = run_workflow(p, grid, base=base, progress_path=f"{tmp_dir}/progress")
    assert w.grid.count() == 4
    assert w.predictions.count() == 240
    assert w.main_summary.count() == 4
    paths = export_results(p, w, f"{tmp_dir}/out", grid, base=base)
    assert set(paths) == set(OUTPUT_NAMES)
    meta_dir = paths["run_metadata"]
    text = "".join(open(os.path.join(meta_dir, f)).read() for f in os.listdir(meta_dir) if f.startswith("part-"))
    meta = json.loads(text)
    assert meta["grid_search_combinations"] == 4 and meta["target_metadata"]["classes"] == ["No", "Yes"]
    assert spark.read.parquet(paths["best_cv_predictions"]).count() == 240
    assert (meta["tree_method"], meta["best_default_ig_top_k"], meta["grid_feature_setups"]) == ("hist", 2, ["all", 2])
    assert {r["feature"] for r in meta["feature_encoding_roles"]} >= {"x", "kind", "level"}
    sealed = verify_tables(spark, f"{tmp_dir}/out", meta["checkpoint_signature"]).collect()
    assert {r.name for r in sealed} == set(OUTPUT_NAMES) - {"run_metadata"} and all(r.intact for r in sealed)
