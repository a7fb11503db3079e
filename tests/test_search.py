import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cvforge.operators.boost import ModelSpec, bin_features, probabilities, train
from cvforge.operators.report import best_by_feature_count, rank_grid
from cvforge.operators.search import fit_plan, grid_combinations, run_grid_search
from cvforge.spec import BoostParams, GridSpec, REPORT_METRICS


def _results(spark):
    rows = []
    for top_k in (None, 10, 11):
        r = {"top_k": top_k, "learning_rate": 0.1, "max_depth": 4, "n_estimators": 100, "subsample": 1.0, "colsample_bytree": 1.0}
        for m in REPORT_METRICS:
            r[f"mean_cv_{m}"] = 0.9
            r[f"std_cv_{m}"] = 0.0
        rows.append(r)
    cols = ["top_k", "learning_rate", "max_depth", "n_estimators", "subsample", "colsample_bytree"] + [
        f"{s}_cv_{m}" for m in REPORT_METRICS for s in ("mean", "std")
    ]
    schema = "top_k int, learning_rate double, max_depth int, n_estimators int, subsample double, colsample_bytree double, " + ", ".join(
        f"{c} double" for c in cols[6:]
    )
    return spark.createDataFrame([tuple(r[c] for c in cols) for r in rows], schema)


def test_grid_rank_ties_put_all_last(spark):
    ranked = rank_grid(_results(spark)).orderBy("rank").collect()
    assert [r["top_k"] for r in ranked] == [10, 11, None]
    assert ranked[0]["is_best"] and not ranked[1]["is_best"]
    best = best_by_feature_count(rank_grid(_results(spark))).orderBy("feature_count_rank").collect()
    assert [r["top_k"] for r in best] == [None, 10, 11]


def test_grid_product_and_plan(spark):
    g = GridSpec(top_k=(None, 10), learning_rates=(0.1, 0.2), max_depths=(3,), n_estimators=(1, 2), subsamples=(1.0,), colsample_bytree=(1.0,))
    assert grid_combinations(spark, g).count() == 8
    plan = dict(fit_plan(GridSpec(), (None, *range(10, 21)), 10))
    assert plan["grid_search_combinations"] == 37500
    assert plan["total_planned_model_fits"] == 375130


@pytest.fixture
def small(spark):
    rng = np.random.default_rng(5)
    n = 300
    pdf = pd.DataFrame({"row_id": np.arange(n), "fold": (np.arange(n) % 3) + 1, "a": rng.normal(size=n), "b": rng.integers(0, 3, n).astype(float)})
    pdf["y"] = ((pdf["a"] + 0.3 * rng.normal(size=n)) > 0).astype(int)
    return spark.createDataFrame(pdf)


def test_training_loss_falls_and_is_partition_stable(spark, small):
    binned = bin_features(small, ["a", "b"], "y", max_bin=32)
    params = BoostParams(n_estimators=3, max_depth=2)
    models = [ModelSpec(1, None, (0, 1), params)]

    def losses(res_state):
        pr = probabilities(res_state, 2).toPandas()
        p = np.array([x[1] for x in pr["probability"]])
        y = pr["y"].to_numpy()
        return float(-np.mean(y * np.log(p) + (1 - y) * np.log(1 - p)))

    res1 = train(binned, [ModelSpec(1, None, (0, 1), BoostParams(n_estimators=1, max_depth=2))], 2)
    res3 = train(binned, models, 2)
    assert losses(res3.state) < losses(res1.state) < math.log(2)
    re = bin_features(small.repartition(5), ["a", "b"], "y", max_bin=32)
    res3b = train(re, models, 2)
    cols = ["round", "node", "is_leaf", "fi", "bin"]
    a = res3.trees.select(*cols).orderBy(*cols).collect()
    b = res3b.trees.select(*cols).orderBy(*cols).collect()
    assert a == b


def test_resume_equals_one_shot(spark, small, tmp_dir):
    binned = bin_features(small, ["a", "b"], "y", max_bin=16)
    lists = {f: ["a", "b"] for f in (1, 2, 3)}
    grid = GridSpec(top_k=(None, 1), learning_rates=(0.3,), max_depths=(1, 2), n_estimators=(1, 2), subsamples=(1.0,), colsample_bytree=(1.0,))
    base = BoostParams(n_estimators=2, max_depth=2)
    with pytest.raises(RuntimeError, match="no result yet"):
        run_grid_search(binned, lists, grid, 2, 1, base=base, progress_path=f"{tmp_dir}/p", signature="s", batch_size=3, max_batches=1)
    resumed = run_grid_search(binned, lists, grid, 2, 1, base=base, progress_path=f"{tmp_dir}/p", signature="s", batch_size=3)
    one_shot = run_grid_search(binned, lists, grid, 2, 1, base=base, progress_path=f"{tmp_dir}/q", signature="s", batch_size=8)
    cols = ["rank", "top_k", "max_depth", "n_estimators", "mean_cv_accuracy", "mean_cv_roc_auc"]
    assert resumed.count() == 8
    assert resumed.select(*cols).orderBy("rank").collect() == one_shot.select(*cols).orderBy("rank").collect()


def test_softmax_booster_three_classes(spark):
    rng = np.random.default_rng(9)
    n = 300
    a = rng.normal(size=n)
    pdf = pd.DataFrame({"row_id": np.arange(n), "fold": (np.arange(n) % 3) + 1, "a": a, "b": rng.integers(0, 3, n).astype(float)})
    pdf["y"] = np.digitize(a + 0.2 * rng.normal(size=n), [-0.5, 0.5]).astype(int)
    df = spark.createDataFrame(pdf)
    binned = bin_features(df, ["a", "b"], "y", max_bin=32)
    one = train(binned, [ModelSpec(1, 1, (0, 1), BoostParams(n_estimators=1, max_depth=2))], 3)
    three = train(binned, [ModelSpec(1, 1, (0, 1), BoostParams(n_estimators=3, max_depth=2))], 3)

    def mlogloss(res):
        pr = probabilities(res.state.where(F.col("in_train")), 3).toPandas()
        probs = np.array([list(x) for x in pr["probability"]])
        assert np.allclose(probs.sum(axis=1), 1.0)
        return float(-np.mean(np.log(probs[np.arange(len(pr)), pr["y"].to_numpy()])))

    assert mlogloss(three) < mlogloss(one) < math.log(3)
    oof = probabilities(three.state.where(~F.col("in_train")), 3).toPandas()
    assert len(oof) == 100 and set(oof["pred"]) <= {0, 1, 2}


def _soft(g, alpha):
    return np.sign(g) * max(abs(g) - alpha, 0.0)


def _numpy_boost(b, y, train, rounds, depth, lr, lam=1.0, mcw=1.0, alpha=0.0, gamma=0.0, spw=1.0):
    """Reference: same second-order greedy algorithm over bins, in numpy."""
    n, m = b.shape
    margin = np.zeros(n)
    w = np.where(y == 1, spw, 1.0)
    score = lambda G, H: _soft(G, alpha) ** 2 / (H + lam)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-margin))
        g = (p - y) * w
        h = np.maximum(p * (1 - p), 1e-16) * w
        node = np.zeros(n, dtype=int)
        open_nodes = {0}
        leaf_val = {}
        for d in range(depth):
            nxt = set()
            for nd in sorted(open_nodes):
                rows = train & (node == nd)
                G, H = g[rows].sum(), h[rows].sum()
                best = None
                for fi in range(m):
                    for s in sorted(set(b[rows, fi])):
                        left = rows & (b[:, fi] <= s)
                        GL, HL = g[left].sum(), h[left].sum()
                        GR, HR = G - GL, H - HL
                        if HL < mcw or HR < mcw or HL <= 0 or HR <= 1e-12:
                            continue
                        gain = 0.5 * (score(GL, HL) + score(GR, HR) - score(G, H)) - gamma
                        key = (-round(gain, 12), fi, s)
                        if best is None or key < best[0]:
                            best = (key, fi, s, gain, GL, HL)
                if best is None or best[3] <= 0:
                    leaf_val[nd] = -_soft(G, alpha) / (H + lam) * lr
                    continue
                _, fi, s, _, GL, HL = best
                here = node == nd
                right = here & (b[:, fi] > s)
                node[here] = 2 * nd + 1
                node[right] = 2 * nd + 2
                if d + 1 >= depth:
                    leaf_val[2 * nd + 1] = -_soft(GL, alpha) / (HL + lam) * lr
                    leaf_val[2 * nd + 2] = -_soft(G - GL, alpha) / (H - HL + lam) * lr
                else:
                    nxt |= {2 * nd + 1, 2 * nd + 2}
            open_nodes = nxt
        margin = margin + np.array([leaf_val.get(x, 0.0) for x in node])
    return margin


@pytest.mark.parametrize("every", [1, 2, 8])
def test_trainer_matches_numpy_reference(spark, small, every):
    binned = bin_features(small, ["a", "b"], "y", max_bin=16)
    params = BoostParams(n_estimators=3, max_depth=3, learning_rate=0.3)
    res = train(binned, [ModelSpec(7, 2, (0, 1), params)], 2, checkpoint_every=every)
    got = res.state.select("row_id", "margin").toPandas().set_index("row_id")["margin"].sort_index()
    bd = binned.df.toPandas().sort_values("row_id")
    b = np.array(bd["b"].tolist())
    expect = _numpy_boost(b, bd["y"].to_numpy(), (bd["fold"] != 2).to_numpy(), 3, 3, 0.3)
    assert np.allclose(got.to_numpy(), expect, atol=1e-9)


@pytest.mark.parametrize("n_classes", [2, 3])
def test_predict_reproduces_training_margins(spark, small, n_classes):
    from cvforge.operators.boost import predict

    df = small if n_classes == 2 else small.withColumn("y", (F.col("row_id") % 3).cast("int"))
    binned = bin_features(df, ["a", "b"], "y", max_bin=16)
    models = [ModelSpec(1, 1, (0, 1), BoostParams(n_estimators=2, max_depth=2, colsample_bytree=0.5)),
              ModelSpec(2, None, (0, 1), BoostParams(n_estimators=3, max_depth=3))]
    res = train(binned, models, n_classes)
    want = probabilities(res.state, n_classes).select("model_id", "row_id", "probability", "pred").toPandas()
    got = predict(res.trees, df, ["a", "b"], models, n_classes).toPandas()
    m = want.merge(got, on=["model_id", "row_id"], suffixes=("_w", "_g"))
    assert len(m) == len(want) == 600
    assert np.allclose(np.stack(m["probability_w"]), np.stack(m["probability_g"]), atol=1e-12)
    assert (m["pred_w"] == m["pred_g"]).all()


def test_parameter_ranges_raise():
    from cvforge.spec import RunConfig

    for bad in ({"learning_rate": 0}, {"max_depth": 0}, {"subsample": 1.5}, {"colsample_bytree": 0}, {"max_bin": 1}):
        with pytest.raises(ValueError):
            BoostParams(**bad)
    with pytest.raises(ValueError):
        GridSpec(subsamples=(0.0,))
    with pytest.raises(ValueError):
        RunConfig(cv_splits=1)
    with pytest.raises(ValueError):
        RunConfig(selection_metric="mcc")


def test_default_model_report(spark, small):
    from cvforge.operators.search import default_model_report

    binned = bin_features(small, ["a", "b"], "y", max_bin=16)
    fm, means, pooled = default_model_report(binned, {f: ["a", "b"] for f in (1, 2, 3)}, 1, 2, 1,
                                             BoostParams(n_estimators=2, max_depth=2))
    assert fm.count() == 3 and means.count() == 1 and pooled.count() == 1
    assert 0.5 < pooled.first()["accuracy"] <= 1.0


@pytest.mark.parametrize(
    "kw",
    [
        {"reg_alpha": 0.5},
        {"gamma": 0.3},
        {"min_child_weight": 8.0},
        {"scale_pos_weight": 2.5, "reg_lambda": 0.5},
    ],
)
def test_trainer_regularisation_matches_numpy(spark, small, kw):
    binned = bin_features(small, ["a", "b"], "y", max_bin=16)
    params = BoostParams(n_estimators=2, max_depth=3, learning_rate=0.3, **kw)
    res = train(binned, [ModelSpec(3, 1, (0, 1), params)], 2)
    got = res.state.select("row_id", "margin").toPandas().set_index("row_id")["margin"].sort_index()
    bd = binned.df.toPandas().sort_values("row_id")
    b = np.array(bd["b"].tolist())
    expect = _numpy_boost(
        b, bd["y"].to_numpy(), (bd["fold"] != 1).to_numpy(), 2, 3, 0.3,
        lam=params.reg_lambda, mcw=params.min_child_weight, alpha=params.reg_alpha,
        gamma=params.gamma, spw=params.scale_pos_weight,
    )
    assert np.allclose(got.to_numpy(), expect, atol=1e-9)


def test_progress_last_write_wins_and_signature_filter(spark, tmp_dir):
    from cvforge.operators.search import latest_within_grid, pending_combinations
    from cvforge.sources.progress import append_progress, read_progress

    grid = GridSpec(top_k=(None, 3), learning_rates=(0.1,), max_depths=(2,), n_estimators=(5,), subsamples=(1.0,), colsample_bytree=(1.0,))
    combos = grid_combinations(spark, grid)
    cols = ["top_k", "learning_rate", "max_depth", "n_estimators", "subsample", "colsample_bytree"]
    schema = ", ".join(
        ["top_k int", "learning_rate double", "max_depth int", "n_estimators int", "subsample double", "colsample_bytree double"]
        + [f"{s}_cv_{m} double" for m in REPORT_METRICS for s in ("mean", "std")]
        + ["status string"]
    )

    def rows(top_k, acc):
        vals = []
        for m in REPORT_METRICS:
            vals += [acc if m == "accuracy" else 0.5, 0.0]
        return spark.createDataFrame([(top_k, 0.1, 2, 5, 1.0, 1.0, *vals, "completed")], schema)

    path = f"{tmp_dir}/progress"
    append_progress(rows(None, 0.60), path, "sig-a", 1 << 40)
    append_progress(rows(None, 0.70), path, "sig-a", 2 << 40)  # same key again: later write wins
    append_progress(rows(3, 0.99), path, "sig-b", 3 << 40)  # another configuration
    done = latest_within_grid(read_progress(spark, path, "sig-a"), combos)
    got = done.collect()
    assert len(got) == 1 and got[0]["top_k"] is None and got[0]["mean_cv_accuracy"] == 0.70
    pending = pending_combinations(combos, done).select(*cols).collect()
    assert [r["top_k"] for r in pending] == [3]  # sig-b's row does not count for sig-a


def test_dataset_fingerprint_is_order_free(spark):
    from cvforge.operators.search import dataset_fingerprint

    df = spark.range(500).select((F.col("id") * 7 % 13).alias("a"), (F.col("id") % 5).cast("double").alias("b"))
    same = dataset_fingerprint(df.repartition(7).orderBy(F.rand(3)))
    assert dataset_fingerprint(df) == same
    changed = df.withColumn("b", F.when(F.col("a") == 0, F.lit(9.0)).otherwise(F.col("b")))
    assert dataset_fingerprint(changed) != same
