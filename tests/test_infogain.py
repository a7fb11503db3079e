
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cvforge.operators.infogain import fold_information_gain, information_gain, selection_frequency


def _entropy(y):
    if len(y) == 0:
        return 0.0
    p = pd.Series(y).value_counts(normalize=True).to_numpy()
    return float(-(p * np.log2(p)).sum())


def _cond(y, x):
    f = pd.DataFrame({"y": y, "x": x})
    return float(sum(len(g) / len(f) * _entropy(g["y"]) for _, g in f.groupby("x", dropna=False)))


@pytest.fixture
def table(spark):
    rng = np.random.default_rng(11)
    n = 400
    pdf = pd.DataFrame(
        {
            "a": rng.integers(0, 4, n).astype(float),
            "b": rng.integers(0, 2, n).astype(float),
            "c": rng.integers(0, 30, n).astype(float),
            "fold": (np.arange(n) % 5) + 1,
        }
    )
    pdf["y"] = ((pdf["a"] + rng.integers(0, 2, n)) > 2).astype(int)
    return pdf, spark.createDataFrame(pdf)


def test_whole_table_ig_matches_brute_force(spark, table):
    pdf, df = table
    got = {r["feature"]: r for r in information_gain(df, ["a", "b", "c"], "y", 2).collect()}
    h = _entropy(pdf["y"])
    for f in "abc":
        assert got[f]["information_gain"] == pytest.approx(h - _cond(pdf["y"], pdf[f]), abs=1e-12)
        assert 0 <= got[f]["information_gain"] <= h + 1e-12
    assert got["a"]["rank"] == 1


def test_fold_ig_equals_filtering(spark, table):
    pdf, df = table
    got = fold_information_gain(df, ["a", "b", "c"], "y", 2, 5).toPandas()
    for fold in range(1, 6):
        train = pdf[pdf["fold"] != fold]
        h = _entropy(train["y"])
        for f in "abc":
            row = got[(got["fold"] == fold) & (got["feature"] == f)].iloc[0]
            assert row["information_gain"] == pytest.approx(h - _cond(train["y"], train[f]), abs=1e-12)
            assert row["feature_value_count"] == train[f].nunique()


def test_relabelling_feature_values_keeps_ig(spark, table):
    pdf, df = table
    a = information_gain(df, ["a"], "y", 2).first()["information_gain"]
    b = information_gain(df.withColumn("a", F.col("a") * 10 + 3), ["a"], "y", 2).first()["information_gain"]
    assert a == pytest.approx(b, abs=1e-15)


def test_missing_values_use_training_median(spark, table):
    pdf, _ = table
    pdf = pdf.copy()
    pdf.loc[pdf.index % 7 == 0, "c"] = np.nan
    df = spark.createDataFrame(pdf).withColumn("c", F.nanvl("c", F.lit(None).cast("double")))
    got = fold_information_gain(df, ["c"], "y", 2, 5, nullable=["c"]).toPandas()
    for fold in range(1, 6):
        train = pdf[pdf["fold"] != fold]
        x = train["c"].fillna(train["c"].median())
        expect = _entropy(train["y"]) - _cond(train["y"], x)
        assert got[got["fold"] == fold]["information_gain"].iloc[0] == pytest.approx(expect, abs=1e-12)


def test_selection_frequency_ties_by_name(spark, table):
    _, df = table
    ig = fold_information_gain(df, ["a", "b", "c"], "y", 2, 5)
    freq = selection_frequency(ig, 3, 5).orderBy("rank").collect()
    assert [r["feature"] for r in freq] == ["a", "b", "c"]
    assert all(r["selection_frequency_pct"] == 100.0 for r in freq)


def test_discretized_ig_bounds_cells(spark, table):
    from cvforge.operators.infogain import discretize_for_ig

    pdf, df = table
    df = df.withColumn("row_id", F.monotonically_increasing_id())
    binned = discretize_for_ig(df, ["a", "b", "c"], max_bin=8, only=["c"])
    got = fold_information_gain(binned, ["a", "b", "c"], "y", 2, 5).toPandas()
    assert got[got["feature"] == "c"]["feature_value_count"].max() <= 8
    exact = fold_information_gain(df, ["a"], "y", 2, 5).toPandas().set_index("fold")["information_gain"]
    same = got[got["feature"] == "a"].set_index("fold")["information_gain"]
    assert np.allclose(exact.sort_index(), same.sort_index())


def test_hot_value_is_combined_map_side(spark):
    # one value holds a third of all rows: the plan must aggregate before the shuffle
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit(0.0)).otherwise(F.col("id").cast("double")).alias("x"),
        (F.col("id") % 2).cast("int").alias("y"),
        ((F.col("id") % 5) + 1).cast("int").alias("fold"),
    )
    ig = fold_information_gain(df, ["x"], "y", 2, 5)
    plan = ig._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan
    assert ig.count() == 5


def test_fold_selection_all_uses_column_order(spark, table):
    from cvforge.operators.infogain import fold_selection_table

    _, df = table
    ig = fold_information_gain(df, ["a", "b", "c"], "y", 2, 5)
    rows = fold_selection_table(ig, df, None, feature_order=["c", "a", "b"]).collect()
    assert all(r["selected_features"] == "c, a, b" and r["selected_feature_count"] == 3 for r in rows)
    top = fold_selection_table(ig, df, 1).collect()
    assert all(r["selected_features"] == "a" for r in top)


def test_gaps_take_each_training_folds_median_or_most_frequent(spark):
    rng = np.random.default_rng(3)
    n = 300
    pdf = pd.DataFrame({"x": rng.integers(0, 9, n).astype(float), "w": rng.choice(["a", "b", "c", ""], n), "fold": np.arange(n) % 3 + 1, "y": rng.integers(0, 3, n)})
    pdf.loc[rng.random(n) < 0.3, "x"] = np.nan
    pdf["w"] = pdf["w"].astype(object).where(rng.random(n) > 0.3, None)
    pdf["none"] = pd.Series([None] * n, dtype=object)
    pdf.loc[pdf["fold"] == 1, "only"] = 5.0  # training rows of fold 1 hold no value
    df = spark.createDataFrame(pdf, "x double, w string, fold int, y int, none string, only double")
    got = fold_information_gain(df, ["x", "w", "none", "only"], "y", 3, 3, nullable=["x", "only"]).toPandas().set_index(["fold", "feature"])
    for fold in (1, 2, 3):
        train = pdf[pdf["fold"] != fold]
        h = _entropy(train["y"])
        x = train["x"].fillna(train["x"].median())
        counts = train["w"].value_counts()
        w = train["w"].fillna(min(counts[counts == counts.max()].index))
        for name, filled in {"x": x, "w": w}.items():
            row = got.loc[(fold, name)]
            assert row["information_gain"] == pytest.approx(h - _cond(train["y"], filled), abs=1e-12)
            assert row["feature_value_count"] == filled.nunique()
        for name in ("none", "only"):
            assert got.loc[(fold, name), "information_gain"] == pytest.approx(0, abs=1e-12) and got.loc[(fold, name), "feature_value_count"] == 1


def test_class_rows_equal_class_columns(spark, table, monkeypatch):
    from cvforge.operators import infogain

    _, df = table
    wide = fold_information_gain(df, ["a", "b", "c"], "y", 2, 5).toPandas()
    whole = information_gain(df, ["a", "b", "c"], "y", 2).toPandas()
    monkeypatch.setattr(infogain, "WIDE_CELLS", 0)
    order = ["fold", "rank"]
    pd.testing.assert_frame_equal(fold_information_gain(df, ["a", "b", "c"], "y", 2, 5).toPandas().sort_values(order), wide.sort_values(order), atol=1e-12)
    pd.testing.assert_frame_equal(information_gain(df, ["a", "b", "c"], "y", 2).toPandas(), whole, atol=1e-12)
