"""Data-quality audit, cleaning and exploratory summaries (Q-1 .. Q-8, X-1 .. X-4, X-6).

Duplicate counting, missing-row counting and cleaning all read one grouped table
``groupBy(all columns).count()``: partial aggregation collapses copies map-side,
so a row repeated a billion times costs one row per map task, not one hot reducer.
"""

from __future__ import annotations

from functools import reduce
from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cvforge.functions.columns import col, is_missing, is_numeric_type, nan_to_null
from cvforge.functions.ordering import BROADCAST_ROWS, weighted_quantiles
from cvforge.session import write_shared


def _missing_flags(df: DataFrame) -> list[Column]:
    return [is_missing(col(f.name), f.dataType) for f in df.schema.fields]


def _copy_groups(df: DataFrame) -> DataFrame:
    """One row per distinct full row: ``_c`` copies, ``_m`` missing cells, ``_z`` any missing."""
    flags = _missing_flags(df)
    n_missing = sum((f.cast("long") for f in flags[1:]), flags[0].cast("long")) if flags else F.lit(0)
    return (
        df.groupBy(*[col(c) for c in df.columns])
        .agg(F.count(F.lit(1)).alias("_c"))
        .withColumn("_m", n_missing)
    )


def clean_dataset(df: DataFrame) -> DataFrame:
    """Q-3 + Q-4: drop exact duplicate rows (one copy kept) and rows with any missing value."""
    return without_missing(df.dropDuplicates())


def without_missing(df: DataFrame) -> DataFrame:
    """Q-4: the rows without any missing value."""
    flags = _missing_flags(df)
    any_missing = F.greatest(*[f.cast("int") for f in flags]) if len(flags) > 1 else flags[0].cast("int")
    return df.where(any_missing == 0)


def repeated_rows(df: DataFrame) -> DataFrame:
    """``dups``: rows less distinct rows. Only 64-bit hashes are grouped of rows whose hash no
    other row has; the rest is grouped by all columns, so that hashes decide nothing."""
    real = (T.FloatType, T.DoubleType)  # -0.0 and 0.0 are one value
    cells = [col(f.name) + F.lit(0.0) if isinstance(f.dataType, real) else col(f.name) for f in df.schema.fields]
    hashed = df.withColumn("_hash", F.xxhash64(*cells))
    shared = write_shared(hashed.groupBy("_hash").agg(F.count(F.lit(1)).alias("_c")).where("_c > 1").select("_hash"), "shared-hashes")
    few = F.broadcast(shared) if shared.count() <= BROADCAST_ROWS else shared
    groups = hashed.join(few, "_hash", "left_semi").groupBy(*[col(c) for c in df.columns]).agg(F.count(F.lit(1)).alias("_c"))
    return groups.agg(F.coalesce(F.sum(F.col("_c") - 1), F.lit(0)).cast("long").alias("dups"))


def cleaning_stats(df: DataFrame) -> DataFrame:
    """Q-5: rows_before, duplicate_rows_removed, missing_rows_before_cleaning, rows_after, total_rows_removed.

    Both counts are taken on the raw table, so ``removed`` need not equal ``duplicates + missing``.
    """
    g = _copy_groups(df)
    s = g.agg(
        F.sum("_c").cast("long").alias("rows_before"),
        F.sum(F.col("_c") - 1).cast("long").alias("duplicate_rows_removed"),
        F.coalesce(F.sum(F.when(F.col("_m") > 0, F.col("_c"))), F.lit(0)).cast("long").alias(
            "missing_rows_before_cleaning"
        ),
        F.count_if(F.col("_m") == 0).cast("long").alias("rows_after"),
    )
    return s.select(
        F.coalesce("rows_before", F.lit(0)).alias("rows_before"),
        F.coalesce("duplicate_rows_removed", F.lit(0)).alias("duplicate_rows_removed"),
        "missing_rows_before_cleaning",
        "rows_after",
        (F.coalesce("rows_before", F.lit(0)) - F.col("rows_after")).alias("total_rows_removed"),
    )


def preprocessing_summary(stats: DataFrame) -> DataFrame:
    """Q-6: the cleaning stats as ``(item, value)`` rows."""
    items = [
        ("rows_before_preprocessing", "rows_before"),
        ("duplicate_rows_removed_keep_first", "duplicate_rows_removed"),
        ("missing_rows_before_cleaning", "missing_rows_before_cleaning"),
        ("rows_after_preprocessing", "rows_after"),
        ("total_rows_removed", "total_rows_removed"),
    ]
    return stats.select(
        F.explode(
            F.array(*[F.struct(F.lit(i).alias("item"), F.col(c).cast("long").alias("value")) for i, c in items])
        ).alias("r")
    ).select("r.*")


def raw_audit(df: DataFrame, target: str) -> DataFrame:
    """Q-1: rows, columns, target, feature count, duplicates, missing cells, per-class counts.

    ``(item STRING, value STRING)``; classes (missing shown as ``nan``) as ``target_count_<label>``.
    """
    if target not in df.columns:
        raise ValueError(f"the table has no column '{target}' to predict")
    g = _copy_groups(df)
    ncols = len(df.columns)
    totals = g.agg(
        F.sum("_c").cast("long").alias("rows"),
        F.sum(F.col("_c") - 1).cast("long").alias("dups"),
        F.sum(F.col("_c") * F.col("_m")).cast("long").alias("missing"),
    ).select(
        F.explode(
            F.array(
                F.struct(F.lit("rows").alias("item"), F.coalesce("rows", F.lit(0)).cast("string").alias("value")),
                F.struct(F.lit("columns").alias("item"), F.lit(str(ncols)).alias("value")),
                F.struct(F.lit("target_column").alias("item"), F.lit(target).alias("value")),
                F.struct(F.lit("feature_columns").alias("item"), F.lit(str(ncols - 1)).alias("value")),
                F.struct(F.lit("duplicate_rows").alias("item"), F.coalesce("dups", F.lit(0)).cast("string").alias("value")),
                F.struct(
                    F.lit("total_missing_values").alias("item"), F.coalesce("missing", F.lit(0)).cast("string").alias("value")
                ),
            )
        ).alias("r")
    ).select("r.*")
    per_class = g.groupBy(F.coalesce(col(target).cast("string"), F.lit("nan")).alias("_label")).agg(
        F.sum("_c").cast("long").alias("_n")
    )
    per_class = per_class.select(
        F.concat(F.lit("target_count_"), F.col("_label")).alias("item"), F.col("_n").cast("string").alias("value")
    )
    return totals.unionByName(per_class)


def column_profile(df: DataFrame) -> DataFrame:
    """Q-2 / Q-8: column, dtype, missing_values, unique_values (missing counts as one value)."""
    parts = []
    for i, f in enumerate(df.schema.fields):
        c = col(f.name)
        real = isinstance(f.dataType, (T.FloatType, T.DoubleType))
        # one column is read, and its distinct values alone are moved
        values = df.select((nan_to_null(c) if real else c).alias("v")).groupBy("v").agg(F.count(F.lit(1)).alias("n"))
        missing = F.coalesce(F.sum(F.when(F.col("v").isNull(), F.col("n"))), F.lit(0)).cast("long")
        parts.append(
            values.agg(missing.alias("m"), F.count(F.lit(1)).alias("d")).select(
                F.lit(i).alias("position"),
                F.lit(f.name).alias("column"),
                F.lit(f.dataType.simpleString()).alias("dtype"),
                F.col("m").alias("missing_values"),
                F.col("d").alias("unique_values"),
            )
        )
    return reduce(DataFrame.unionByName, parts)


def quality_check(clean: DataFrame, encoded: DataFrame, target: str) -> DataFrame:
    """Q-7: cleaned_rows, cleaned_columns, remaining_missing_values, remaining_duplicate_rows,
    encoded_feature_rows, encoded_target_rows as ``(check, value)``."""
    n_missing = sum((f.cast("long") for f in _missing_flags(clean)), F.lit(0))
    c = clean.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(n_missing), F.lit(0)).cast("long").alias("missing"))
    c = c.crossJoin(repeated_rows(clean))
    e = encoded.agg(
        F.count(F.lit(1)).alias("enc_rows"),
        F.count(col(target)).alias("enc_target"),
    )
    def rows(frame: DataFrame, items: list[tuple[str, Column]]) -> DataFrame:
        return frame.select(
            F.explode(F.array(*[F.struct(F.lit(n).alias("check"), v.cast("long").alias("value")) for n, v in items])).alias("r")
        ).select("r.*")

    clean_rows = rows(
        c,
        [
            ("cleaned_rows", F.col("rows")),
            ("cleaned_columns", F.lit(len(clean.columns))),
            ("remaining_missing_values", F.col("missing")),
            ("remaining_duplicate_rows", F.col("dups")),
        ],
    )
    enc_rows = rows(e, [("encoded_feature_rows", F.col("enc_rows")), ("encoded_target_rows", F.col("enc_target"))])
    return clean_rows.unionByName(enc_rows)


def target_distribution(df: DataFrame, target: str) -> DataFrame:
    """X-1: class_label, count, percentage (missing target rows are not counted)."""
    counts = (
        df.where(col(target).isNotNull())
        .groupBy(col(target).cast("string").alias("class_label"))
        .agg(F.count(F.lit(1)).alias("count"))
    )
    # one row per class: the window covers a bounded table
    total = F.sum("count").over(Window.partitionBy(F.lit(1)))
    return counts.select("class_label", "count", (F.col("count") / total * 100.0).alias("percentage"))


def _long_numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(
        F.explode(
            F.array(*[F.struct(F.lit(c).alias("feature"), nan_to_null(col(c)).alias("value")) for c in columns])
        ).alias("r")
    ).select("r.*")


def numeric_summary(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """X-2 / X-4: feature, count, mean, std (sample), min, p25, p50, p75, max; exact quartiles."""
    if columns is None:
        columns = [f.name for f in df.schema.fields if is_numeric_type(f.dataType)]
    long = _long_numeric(df, columns)
    basic = long.groupBy("feature").agg(
        F.count("value").alias("count"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
    qs = weighted_quantiles(long, ["feature"], "value", None, [0.25, 0.5, 0.75])
    wide = qs.groupBy("feature").agg(
        *[F.max(F.when(F.col("q") == q, F.col("quantile"))).alias(n) for q, n in ((0.25, "p25"), (0.5, "p50"), (0.75, "p75"))]
    )
    return basic.join(wide, "feature", "left").select(
        "feature", "count", "mean", "std", "min", "p25", "p50", "p75", "max"
    )


def categorical_summary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """X-3: feature, unique_values, most_common_value, most_common_count (ties: smaller value)."""
    long = df.select(
        F.explode(
            F.array(*[F.struct(F.lit(c).alias("feature"), col(c).cast("string").alias("value")) for c in columns])
        ).alias("r")
    ).select("r.*")
    counts = long.groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n"))
    best = counts.groupBy("feature").agg(
        F.count(F.lit(1)).alias("unique_values"),
        F.min(F.struct((-F.col("n")).alias("neg_n"), F.col("value").alias("value"))).alias("top"),
    )
    return best.select(
        "feature",
        "unique_values",
        F.col("top.value").alias("most_common_value"),
        (-F.col("top.neg_n")).alias("most_common_count"),
    )


def fold_class_distribution(folded: DataFrame, label: Column, fold_col: str = "fold") -> DataFrame:
    """X-6: fold, class_label, count, percentage of the fold; absent classes have no row."""
    counts = folded.groupBy(F.col(fold_col).alias("fold"), label.alias("class_label")).agg(
        F.count(F.lit(1)).alias("count")
    )
    # (fold x class) rows: bounded by K * classes
    total = F.sum("count").over(Window.partitionBy("fold"))
    return counts.select("fold", "class_label", "count", (F.col("count") / total * 100.0).alias("percentage"))
