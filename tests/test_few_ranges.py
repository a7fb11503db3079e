"""Ranges in fold order: few enough for a shuffle without a sort of its map side; copies go by the sort alone."""

import pytest
from pyspark.sql import functions as F

from cvforge.functions import ordering
from cvforge.operators import split


def _written(monkeypatch):
    """Partitions and plans of what is written."""
    seen, real = [], ordering.write_shared

    def write(rows, name):
        plan = rows._jdf.queryExecution().executedPlan().toString()
        done = real(rows, name)
        seen.append((done.select("_pid").distinct().count(), plan))
        return done

    monkeypatch.setattr(ordering, "write_shared", write)
    return seen


def test_ranges_grow_before_a_shuffle_sorts_its_map_side(spark, monkeypatch):
    df = spark.range(1600).select(F.col("id").alias("key"), (F.col("id") % 17).cast("double").alias("x"))
    seen = _written(monkeypatch)
    monkeypatch.setattr(split, "RANGE_CELLS", 10)  # 320 ranges by this alone, beyond the 200 of an unsorted shuffle
    rows, _ = split.distinct_in_fold_order(df, ["key"], [F.col("x")])
    assert [r["_row_id"] for r in rows.orderBy("_row_id").collect()] == [*range(1600)]
    assert 150 < seen[0][0] <= 200


@pytest.mark.parametrize("cells,parts", [(1, 1), (500_000_000, 200), (500_000_001, 200), (2_500_000_000, 200), (2_512_500_000, 201)])
def test_range_count(cells, parts):
    assert split.range_count(cells, 200) == parts


def test_copies_are_dropped_by_the_sort(spark, monkeypatch):
    rows = [(k, float(k % 3), f"t{k % 5}", k % 2 == 0) for k in range(300)]
    rows += rows[::20] + rows[::20] + [(7, 1.0, "t2", True), (500, -0.0, "z", True), (500, 0.0, "z", True)]
    df = spark.createDataFrame(rows, "key long, x double, t string, b boolean").repartition(5)
    seen = _written(monkeypatch)
    found, clean = split.distinct_in_fold_order(df, ["key"], [F.col("x")])
    _, plan = seen[0]
    assert "HashAggregate" not in plan and plan.count("Sort [") == 1  # a range is held once, not in two hash tables too
    as_text = lambda d: sorted(str(tuple(r)) for r in d.collect())  # noqa: E731 - tells -0.0 from 0.0
    assert as_text(clean) == as_text(df.dropDuplicates())
    expected = split.assign_folds(df.dropDuplicates(), ["key"]).select("row_id", "key", "x", "t", "b")
    assert as_text(found.select("_row_id", "key", "x", "t", "b")) == as_text(expected)


def test_equal_first_bits_of_digests(spark, monkeypatch):
    """All rows share the bits that are moved, so order and copies go by the whole digest and the row."""
    monkeypatch.setattr(split, "shuffle_key", lambda seed, keys: F.concat(F.lit("0" * 15), F.md5(F.col(keys[0]).cast("string"))))
    df = spark.range(500).select(F.col("id").alias("key"), (F.col("id") % 7).alias("x"))
    df = df.unionByName(df.where("key < 20")).unionByName(df.where("key < 9"))
    found, _ = split.distinct_in_fold_order(df, ["key"], [F.col("x")])
    expected = split.assign_folds(df.dropDuplicates(), ["key"]).select("row_id", "key", "x")
    assert sorted(map(tuple, found.select("_row_id", "key", "x").collect())) == sorted(map(tuple, expected.collect()))
