"""The cleaned table and the rows in fold order come from one shuffle; copies are counted by hashes."""

import pytest
from pyspark.sql import functions as F

from cvforge.functions import ordering
from cvforge.operators import audit
from cvforge.operators.audit import clean_dataset
from cvforge.operators.encode import encode_features
from cvforge.operators.split import assign_folds
from cvforge.plans import prepare as plans
from cvforge.plans.datasets import Binding
from cvforge.spec import FeatureSpec

SPEC = FeatureSpec(target="label", positive_class="Yes", nominal={"kind": None}, numeric=("x",), exclude=("key",), key_cols=("key",))


def _raw(spark, keys):
    """Rows of which every 20th comes twice, and some lack a value; ``keys`` different keys."""
    rows = spark.range(400).select(
        (F.col("id") % keys).alias("key"),
        F.when(F.col("id") % 41 > 0, F.concat(F.lit("k"), F.col("id") % 3)).alias("kind"),
        (F.col("id") % 17).cast("double").alias("x"),
        F.when(F.col("id") % 5 < 2, "Yes").otherwise("No").alias("label"),
    )
    return rows.unionByName(rows.where("key % 20 = 0"))


def _sorted(df):
    return sorted(map(tuple, df.collect()))


@pytest.mark.parametrize("keys,writes", [(400, ["ranged"]), (7, ["clean", "ranged"])])
def test_clean_and_folds_from_one_shuffle(spark, monkeypatch, keys, writes):
    seen, shuffles = [], []

    def noted(real):
        def write(df, name):
            seen.append(name)
            shuffles.append(df._jdf.queryExecution().executedPlan().toString().count("Exchange "))
            return real(df, name)

        return write

    for module in (ordering, plans):
        monkeypatch.setattr(module, "write_shared", noted(module.write_shared))
    raw = _raw(spark, keys)
    p = plans.prepare(Binding("toy", raw, SPEC), k=4, materialize=True)
    assert seen == writes
    if len(writes) == 1:
        assert shuffles == [1]
    clean = clean_dataset(raw)
    expected = assign_folds(encode_features(clean, SPEC).df, ["key"], k=4)
    assert p.folded.columns == expected.columns
    assert _sorted(p.folded) == _sorted(expected)
    assert _sorted(p.clean) == _sorted(clean)
    assert _sorted(p.encoded.df) == _sorted(expected.drop("row_id", "fold"))


def test_repeated_rows(spark):
    df = spark.createDataFrame([(1, 0.0, None), (1, -0.0, None), (None, 1.0, "a"), (None, 1.0, "a"), (None, 1.0, "a"), (2, 1.0, "a"), (None, None, "a")], "a int, x double, t string")
    assert audit.repeated_rows(df).first()["dups"] == df.count() - df.distinct().count() == 3
    assert audit.repeated_rows(df.distinct()).first()["dups"] == 0
    assert audit.repeated_rows(df.limit(0)).first()["dups"] == 0
