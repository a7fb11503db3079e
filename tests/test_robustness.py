"""Inputs and situations at the edges of the workflow: constant features, missing tokens in CSV,
very many classes, categories and unknown values, and runs that go on from another one's progress."""

import os

import pytest
from pyspark.sql import functions as F

from cvforge.operators.boost import ModelSpec, bin_features, train
from cvforge.operators.encode import encode_features, encode_target
from cvforge.operators.search import configuration_signature, dataset_fingerprint, grid_combinations, path_batches
from cvforge.sources.progress import append_progress, commit_batch, read_progress, stage_batch
from cvforge.sources.tables import load_table
from cvforge.spec import REPORT_METRICS, BoostParams, FeatureSpec, GridSpec


def test_constant_and_missing_features_train(spark):
    rows = [(i, i // 2 % 2 + 1, i % 2, float(i % 2), 1.0, None) for i in range(40)]
    df = spark.createDataFrame(rows, "row_id long, fold int, y int, a double, same double, none double")
    binned = bin_features(df, ["a", "same", "none"], "y", max_bin=16)
    assert {tuple(r["b"]) for r in binned.df.collect()} == {(0, 0, 1), (1, 0, 1)}
    res = train(binned, [ModelSpec(0, 1, (0, 1, 2), BoostParams(n_estimators=1, max_depth=2))], 2)
    assert {r["feature"] for r in res.trees.where("not is_leaf").collect()} == {"a"}


def test_deep_trees_train(spark):
    df = spark.createDataFrame([(i, i % 10 + 1, i % 3 % 2, float(i)) for i in range(60)], "row_id long, fold int, y int, a double")
    models = [ModelSpec(f, f, (0,), BoostParams(n_estimators=1, max_depth=18, min_child_weight=0.0)) for f in range(1, 3)]
    assert train(bin_features(df, ["a"], "y"), models, 2, keep_trees=False).state.count() == 120


def test_csv_types_after_missing_tokens(spark, tmp_path):
    (tmp_path / "t.csv").write_text("n,x,word,none,y\n1,1.5,a,NA,Yes\nNA,NA,NA,,No\n3,4.25,b7,nan,Yes\n")
    df = load_table(spark, str(tmp_path / "t.csv"), "y", fmt="csv")
    assert dict(df.dtypes) == {"n": "bigint", "x": "double", "word": "string", "none": "string", "y": "string"}
    assert [tuple(r) for r in df.collect()] == [(1, 1.5, "a", None, "Yes"), (None, None, None, None, "No"), (3, 4.25, "b7", None, "Yes")]


def test_many_classes_and_categories(spark):
    df = spark.range(1500).select(F.concat(F.lit("c"), "id").alias("kind"), F.concat(F.lit("y"), "id").alias("label"))
    assert len(encode_target(df, "label", None).classes) == 1500
    assert len(encode_features(df, FeatureSpec(target="label")).features) == 1500


def test_all_unknown_categories_are_named(spark):
    df = spark.range(60).select(F.format_string("v%02d", "id").alias("kind"), F.lit("x").alias("label"))
    with pytest.raises(ValueError) as said:
        encode_features(df, FeatureSpec(target="label", binary={"kind": {"a": 0, "b": 1}}))
    assert all(f"v{i:02d}" in str(said.value) for i in range(60))


def test_fingerprint_tells_nulls_apart(spark):
    a = spark.createDataFrame([(None, 1)], "p int, q int")
    assert dataset_fingerprint(a) != dataset_fingerprint(spark.createDataFrame([(1, None)], "p int, q int"))
    assert configuration_signature({"positive": 0}) != configuration_signature({"positive": 1})


def test_damaged_progress_is_no_empty_progress(spark, tmp_path):
    assert read_progress(spark, str(tmp_path / "absent")).count() == 0
    for part in ("log", "batches"):
        os.makedirs(tmp_path / f"bad-{part}/{part}/signature=s/batch=b")
        (tmp_path / f"bad-{part}/{part}/signature=s/batch=b/part-0.parquet").write_bytes(b"no parquet")
        with pytest.raises(Exception):
            read_progress(spark, str(tmp_path / f"bad-{part}"), "s").count()


def test_readers_see_committed_batches_only(spark, tmp_path):
    path, seq = str(tmp_path / "p"), 1 << 40
    rows = spark.createDataFrame([(k, 0.1, 2, 5, 1.0, 1.0, "completed") for k in (1, 2)], "top_k int, learning_rate double, max_depth int, n_estimators int, subsample double, colsample_bytree double, status string")
    rows = rows.select("*", *[F.lit(0.5).alias(f"{s}_cv_{m}") for m in REPORT_METRICS for s in ("mean", "std")])
    seen = lambda: sorted((r.top_k, r.seq >> 40) for r in read_progress(spark, path, "s").collect())
    stage_batch(rows, path, "s")  # this writer is killed before its commit
    assert seen() == []
    one, two = stage_batch(rows, path, "s"), stage_batch(rows, path, "s")  # two writers that began alike
    commit_batch(spark, path, "s", two, seq)
    assert seen() == [(1, 1), (2, 1)]
    commit_batch(spark, path, "s", one, seq)
    stored = read_progress(spark, path).collect()
    assert len(stored) == len({r.seq for r in stored}) == 4 and {r.signature for r in stored} == {"s"}
    append_progress(rows.where("top_k = 1"), path, "s", 2 * seq)
    append_progress(rows.limit(0), path, "s", 3 * seq)
    append_progress(rows, path, "007", seq)  # a signature that looks like a number
    assert seen() == [(1, 1), (1, 1), (1, 2), (2, 1), (2, 1)] and read_progress(spark, path, "007").count() == 2
    for part in (tmp_path / f"p/batches/signature=s/batch={one}").glob("*part-*"):
        part.unlink()
    with pytest.raises(ValueError, match="should have 2 rows"):
        read_progress(spark, path, "s")


def test_default_grid_trains_every_path_once(spark):
    combos = [r.asDict() for r in grid_combinations(spark, GridSpec()).collect()]
    seen: set[tuple] = set()
    for batch in path_batches(combos, 25):
        paths = {tuple(v for k, v in c.items() if k != "n_estimators") for c in batch}
        assert not paths & seen and len(batch) == 25
        seen |= paths
    assert len(seen) == len(combos) // 5


def test_metrics_written_as_text_are_rounded(spark):
    from cvforge.functions.columns import round_metric_columns

    rows = [("0.123456", "0.5", "NaN", None, 0.98765, "x"), (" 2 ", "n/a", "1", None, None, "y")]
    table = spark.createDataFrame(rows, "a_score string, b_score string, c_score string, d_score string, auc double, name string")
    got = [tuple(r) for r in round_metric_columns(table).collect()]
    assert got == [(0.1235, "0.5", "NaN", None, 0.9877, "x"), (2.0, "n/a", "1", None, None, "y")]
