"""Shuffled K-fold assignment (K-1, K-2).

Rows are ordered by ``md5(seed|key...)`` with the key and the remaining columns
as tie-breakers; position ``p`` of ``n`` rows goes to fold ``ntile(k)``: the first
``n mod k`` folds get one extra row, as in a shuffled K-fold split. Positions come
from range partitioning plus per-range offsets, never from a single-partition window.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cvforge.functions.columns import col
from cvforge.functions.ordering import number_rows, with_global_position


def shuffle_key(seed: int, key_cols: Sequence[str]) -> Column:
    """md5 of ``seed|k1|k2|...`` over the text of integer key columns."""
    parts = [F.lit(str(seed))] + [col(k).cast("string") for k in key_cols]
    return F.md5(F.concat_ws("|", *parts))


def ntile_of(pos: Column, total: Column, k: int) -> Column:
    """1-based fold of 0-based position ``pos`` among ``total`` rows (ntile semantics)."""
    q = F.floor(total / k)
    r = total - q * k
    big = (q + 1) * r  # rows held by the first r (larger) folds
    return F.when(pos < big, F.floor(pos / (q + 1)) + 1).otherwise(
        F.floor((pos - big) / F.greatest(q, F.lit(1))) + r + 1
    ).cast("int")


def assign_folds(
    df: DataFrame,
    key_cols: Sequence[str],
    k: int = 10,
    seed: int = 42,
    tie_cols: Sequence[str] | None = None,
    fold_col: str = "fold",
    row_id_col: str = "row_id",
    num_partitions: int | None = None,
) -> DataFrame:
    """K-1/K-2: add ``row_id`` (0-based position in shuffled order) and ``fold`` (1..k)."""
    if k < 2:
        raise ValueError("cv_splits must be at least 2.")
    if tie_cols is None:
        tie_cols = [c for c in df.columns if c not in set(key_cols)]
    order = [shuffle_key(seed, key_cols).alias("_h")]
    keyed = df.withColumn("_h", order[0])
    order_cols = [F.col("_h")] + [col(c) for c in key_cols] + [col(c) for c in tie_cols]
    rows, _ = with_global_position(keyed, order_cols, name=row_id_col, num_partitions=num_partitions)
    return rows.withColumn(fold_col, ntile_of(F.col(row_id_col), F.col("_total"), k)).drop("_h", "_total")


#: Cells (rows x columns) of a range of rows. A task holds a range once, to sort it.
RANGE_CELLS = 2_500_000
#: Cells of a range at most, if smaller ones were too many for a shuffle without a sort of its map side.
RANGE_CELLS_MOST = 12_500_000


def range_count(cells: int, unsorted: int) -> int:
    """Ranges for so many cells. A shuffle into at most ``unsorted`` ranges writes rows as they come; into
    more, each map task holds its rows to sort them and spills them, so ranges grow before their number does."""
    parts = -(-cells // RANGE_CELLS)
    return parts if parts <= unsorted else max(unsorted, -(-cells // RANGE_CELLS_MOST))


def distinct_in_fold_order(
    df: DataFrame, key_cols: Sequence[str], tie_cols: Sequence[Column], seed: int = 42
) -> tuple[DataFrame, DataFrame] | None:
    """The distinct rows of ``df`` in the order of :func:`assign_folds` with ``_row_id`` and
    ``_total``, and these rows alone, from one shuffle: copies have the same key, so they meet in
    the range of its digest, where the sort puts them side by side. None if many rows share their
    key, as all of these would meet too.
    """
    if not key_cols:
        return None
    known = df.agg(F.count(F.lit(1)).alias("n"), F.approx_count_distinct(F.xxhash64(*[col(c) for c in key_cols]), 0.02).alias("keys")).first()
    if known["keys"] < 0.9 * known["n"]:
        return None
    digest = shuffle_key(seed, key_cols)
    # -0.0 and 0.0 are one value, as in dropDuplicates
    kinds = {f.name: f.dataType for f in df.schema.fields if isinstance(f.dataType, (T.FloatType, T.DoubleType))}
    cells = [(col(c) + F.lit(0.0)).cast(kinds[c]).alias(c) if c in kinds else col(c) for c in df.columns]
    # the first 60 bits are moved and sorted; the whole digest is taken again where they are equal
    keyed = df.select(*cells).withColumn("_h", F.conv(F.substring(digest, 1, 15), 16, 10).cast("long"))
    # a given number of ranges is not merged by AQE, which goes by compressed bytes and so may give a
    # task more rows than its memory holds; a small table has the session's number, which AQE merges
    sc = df.sparkSession.sparkContext
    parts = range_count(known["n"] * len(df.columns), int(sc.getConf().get("spark.shuffle.sort.bypassMergeThreshold", "200")))
    wide = parts > sc.defaultParallelism
    ranged = keyed.repartitionByRange(parts, "_h") if wide else keyed.repartitionByRange("_h")
    rest = [col(c) for c in df.columns if c not in set(key_cols)]
    ordered = ranged.sortWithinPartitions("_h", digest, *[col(c) for c in key_cols], *tie_cols, *rest)
    # the window needs no order but that of _h, so it leaves the rows as sorted; each sees the one before it
    whole = F.struct(*[col(c) for c in df.columns])
    before = F.first(whole).over(Window.partitionBy("_h").rowsBetween(-1, -1))
    distinct = ordered.withColumn("_copy", before.eqNullSafe(whole)).where(~F.col("_copy"))
    rows, _, written = number_rows(distinct.drop("_h", "_copy"), "_row_id")
    return rows, written


def fold_sizes(folded: DataFrame, fold_col: str = "fold") -> DataFrame:
    """X-5: fold, test_samples_in_fold."""
    return folded.groupBy(fold_col).agg(F.count(F.lit(1)).alias("test_samples_in_fold"))
