"""Sealed tables: a reader sees which tables are what the run wrote."""

import pytest

from cvforge.sources.tables import seal_tables, verify_tables, write_table


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_damage_is_found(spark, tmp_dir, fmt):
    a = spark.createDataFrame([(1, "x", None), (2, None, 0.5), (2, None, 0.5)], "n int, t string, d double")
    for name in ("a", "b", "c"):
        write_table(a, f"{tmp_dir}/{name}", fmt)
    first = seal_tables(spark, tmp_dir, ["a", "b", "c"], "run 1", "input", fmt)
    state = lambda **k: {r.name: (r.rows, r.intact) for r in verify_tables(spark, tmp_dir, **k).collect()}
    assert state() == {k: (3, True) for k in "abc"}
    write_table(a.orderBy("n", ascending=False).repartition(2), f"{tmp_dir}/a", fmt)  # same rows in another order
    write_table(a.dropDuplicates(), f"{tmp_dir}/b", fmt)
    assert state() == {"a": (3, True), "b": (2, False), "c": (3, True)}
    assert not any(ok for _, ok in state(signature="run 2").values())
    assert seal_tables(spark, tmp_dir, ["a", "b", "c"], "run 1", "other input", fmt) != first
    assert seal_tables(spark, tmp_dir, ["a", "c"], "run 1", "input", fmt) != first
