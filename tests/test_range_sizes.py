"""Ranges of rows in fold order are bounded by cells; AQE does not merge them again."""

from pyspark.sql import functions as F

from cvforge.functions import ordering
from cvforge.operators import split


def test_ranges_below_the_shuffle_partitions_stay_bounded(spark, monkeypatch):
    cores = spark.sparkContext.defaultParallelism
    df = spark.range(100 * cores).select(F.col("id").alias("key"), (F.col("id") % 17).cast("double").alias("x"))
    monkeypatch.setattr(split, "RANGE_CELLS", 100)  # 50 rows of two columns
    sizes, real = [], ordering.write_shared

    def write(rows, name):
        done = real(rows, name)
        sizes.extend(r["count"] for r in done.groupBy("_pid").count().collect())
        return done

    monkeypatch.setattr(ordering, "write_shared", write)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(4 * cores))
    try:
        rows, _ = split.distinct_in_fold_order(df, ["key"], [F.col("x")])
        assert [r["_row_id"] for r in rows.orderBy("_row_id").collect()] == [*range(100 * cores)]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert len(sizes) == 2 * cores and max(sizes) <= 100  # merged into one range of all rows before
