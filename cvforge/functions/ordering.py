"""Global order primitives that never gather a group into one task.

Spark's un-partitioned windows (``row_number() over (order by x)``) pull every row
into one partition. These helpers range-partition instead, compute positions or
running sums inside each range, and add per-range offsets from a small table whose
size is bounded by the number of ranges (plus the number of groups).
"""

from __future__ import annotations

from typing import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cvforge.session import write_shared

#: Offset tables of up to so many rows are broadcast; beyond, they are joined.
BROADCAST_ROWS = 1_000_000
_LOCAL_BITS = 33  # monotonically_increasing_id keeps the row index in the low 33 bits


def _range_partition(df: DataFrame, num_partitions: int | None, *keys) -> DataFrame:
    """Range-partition on ``keys``. Without an explicit count AQE may merge adjacent
    ranges of small data; merged ranges stay contiguous, so per-range offsets hold."""
    if num_partitions:
        return df.repartitionByRange(int(num_partitions), *keys)
    return df.repartitionByRange(*keys)


def with_global_position(
    df: DataFrame,
    order_by: Sequence[Column],
    name: str = "_pos",
    num_partitions: int | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Add a 0-based position in ``order_by`` order (keys must be unique).

    Returns ``(rows, sizes)`` where ``sizes`` holds one row per range with the
    cumulative offset and the grand total (column ``_total``).
    """
    rows, sizes, _ = number_rows(_range_partition(df, num_partitions, *order_by).sortWithinPartitions(*order_by), name)
    return rows, sizes


def number_rows(ordered: DataFrame, name: str = "_pos") -> tuple[DataFrame, DataFrame, DataFrame]:
    """Add a 0-based position to rows that stand in order within ranges that do.

    Returns ``(rows, sizes, written)``: as :func:`with_global_position`, and the rows as written,
    for readers that need no position.
    """
    # Range bounds come from sampling the input; read twice, two samples of a shuffled input
    # can disagree. Materialise the ranged rows once so sizes and rows share partition ids.
    ranged = write_shared(
        ordered.withColumn("_pid", F.spark_partition_id())
        .withColumn("_local", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1))),
        "ranged",
    )
    # one row per range (bounded by the partition count): collected once, so later reads of
    # the result do not rescan the ranged rows to recount them
    counts = sorted((r["_pid"], r["_n"]) for r in ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n")).collect())
    total = sum(n for _, n in counts)
    offsets, running = [], 0
    for pid, n in counts:
        offsets.append((pid, running, total))
        running += n
    sizes = ordered.sparkSession.createDataFrame(offsets or [(-1, 0, 0)], "_pid int, _offset long, _total long")
    rows = ranged.join(F.broadcast(sizes), "_pid").withColumn(name, F.col("_offset") + F.col("_local"))
    return rows.drop("_pid", "_local", "_offset"), sizes, ranged.drop("_pid", "_local")


def with_running_totals(
    df: DataFrame,
    group_cols: Sequence[str],
    order_col: str,
    value_cols: Sequence[str],
    prefix: str = "cum_",
    num_partitions: int | None = None,
) -> DataFrame:
    """Inclusive running sums of ``value_cols`` per group in ``order_col`` order.

    ``order_col`` must be unique within a group (aggregate ties first). Work is
    split into balanced key ranges; a group may span many ranges, so a hot group
    never lands in a single task.
    """
    keys = [F.col(c) for c in group_cols] + [F.col(order_col)]
    # the running sums within each range are taken while its rows stand in order, before they
    # are written: one shuffle of the rows, and both branches below see the same ranges
    ranged = _range_partition(df, num_partitions, *keys).sortWithinPartitions(*keys)
    local = write_shared(_local_sums(ranged, list(group_cols), list(value_cols)).withColumn("_pid", F.spark_partition_id()), "running")
    totals = local.groupBy("_pid", *group_cols).agg(*[F.sum(v).alias(f"_tot_{v}") for v in value_cols])
    off_base = Window.partitionBy(*group_cols) if group_cols else Window
    off_w = off_base.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        "_pid",
        *group_cols,
        *[F.coalesce(F.sum(f"_tot_{v}").over(off_w), F.lit(0)).alias(f"_off_{v}") for v in value_cols],
    )
    # a row for each range and group that meet: ranges + groups at most
    offsets = write_shared(offsets, "offsets")
    if offsets.count() <= BROADCAST_ROWS:
        offsets = F.broadcast(offsets)
    joined = local.join(offsets, ["_pid", *group_cols])
    return joined.select(
        *[F.col(c) for c in df.columns],
        *[(F.col(f"_off_{v}") + F.col(f"_loc_{v}")).alias(f"{prefix}{v}") for v in value_cols],
    )


def _local_sums(ordered: DataFrame, group_cols: list[str], value_cols: list[str]) -> DataFrame:
    """Running sums ``_loc_<value>`` over each partition's rows, which stand in group order."""
    sums = ordered.select(*[F.sum(v).over(Window.partitionBy()).alias(f"_loc_{v}") for v in value_cols]).schema  # sum types
    whole = {v: isinstance(sums[f"_loc_{v}"].dataType, T.LongType) for v in value_cols}
    schema = T.StructType([*ordered.schema.fields, *[T.StructField(f"_loc_{v}", T.LongType() if whole[v] else T.DoubleType()) for v in value_cols]])

    def run(batches):
        last, carry = None, {}
        for batch in batches:
            if not batch.num_rows:
                continue
            new = np.zeros(batch.num_rows, bool)
            for c in group_cols:
                codes = pc.dictionary_encode(batch.column(c), null_encoding="encode").indices.to_numpy()
                new[1:] |= codes[1:] != codes[:-1]
            first = tuple(batch.column(c)[0].as_py() for c in group_cols)
            starts = np.append(0, np.flatnonzero(new))
            ends = np.append(starts[1:], batch.num_rows)
            columns = list(batch.columns)
            for v in value_cols:
                kind = np.int64 if whole[v] else np.float64
                values = pc.fill_null(batch.column(v).cast(pa.int64() if whole[v] else pa.float64()), 0).to_numpy()
                out = np.empty(batch.num_rows, kind)
                for n, (a, b) in enumerate(zip(starts, ends, strict=True)):
                    before = carry[v] if n == 0 and last == first and v in carry else kind(0)
                    out[a:b] = np.cumsum(np.append(before, values[a:b]))[1:]
                carry[v] = out[-1]
                columns.append(pa.array(out))
            last = tuple(batch.column(c)[batch.num_rows - 1].as_py() for c in group_cols)
            yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in schema])

    return ordered.mapInArrow(run, schema)


def weighted_quantiles(
    df: DataFrame,
    group_cols: Sequence[str],
    value_col: str,
    weight_col: str | None,
    quantiles: Sequence[float],
    num_partitions: int | None = None,
) -> DataFrame:
    """Exact quantiles with linear interpolation (numpy/``quantile_cont`` rule).

    Returns ``(group..., q, quantile)``. Values are first collapsed to distinct
    ``(group, value)`` cells (partial aggregation absorbs hot values), then ranked
    with :func:`with_running_totals`; no group is ever gathered into one task.
    NULL values are ignored.
    """
    if not group_cols:
        grouped = weighted_quantiles(
            df.withColumn("_g", F.lit(0)), ["_g"], value_col, weight_col, quantiles, num_partitions
        )
        return grouped.drop("_g")
    weight = F.col(weight_col) if weight_col else F.lit(1)
    cells = (
        df.where(F.col(value_col).isNotNull())
        .groupBy(*group_cols, value_col)
        .agg(F.sum(weight).cast("long").alias("_w"))
        .where(F.col("_w") > 0)
    )
    run = with_running_totals(cells, group_cols, value_col, ["_w"], num_partitions=num_partitions)
    totals = cells.groupBy(*group_cols).agg(F.sum("_w").alias("_n"))
    targets = totals.select(
        *group_cols,
        F.explode(F.array(*[F.lit(float(q)) for q in quantiles])).alias("q"),
        "_n",
    ).select(
        *group_cols,
        "q",
        (F.col("q") * (F.col("_n") - 1)).alias("_h"),
    ).select(
        *group_cols,
        "q",
        F.floor("_h").cast("long").alias("_lo"),
        F.ceil("_h").cast("long").alias("_hi"),
        (F.col("_h") - F.floor("_h")).alias("_frac"),
    )
    # equi-join on the group; each cell matches only the <= len(quantiles) targets of its group
    hit = run.join(targets, list(group_cols)).where(
        ((F.col("cum__w") - F.col("_w") <= F.col("_lo")) & (F.col("_lo") < F.col("cum__w")))
        | ((F.col("cum__w") - F.col("_w") <= F.col("_hi")) & (F.col("_hi") < F.col("cum__w")))
    )
    lo_hit = (F.col("cum__w") - F.col("_w") <= F.col("_lo")) & (F.col("_lo") < F.col("cum__w"))
    hi_hit = (F.col("cum__w") - F.col("_w") <= F.col("_hi")) & (F.col("_hi") < F.col("cum__w"))
    res = hit.groupBy(*group_cols, "q").agg(
        F.max(F.when(lo_hit, F.col(value_col))).alias("_vlo"),
        F.max(F.when(hi_hit, F.col(value_col))).alias("_vhi"),
        F.first("_frac").alias("_frac"),
    )
    return res.select(
        *group_cols,
        "q",
        (F.col("_vlo") + F.col("_frac") * (F.col("_vhi") - F.col("_vlo"))).alias("quantile"),
    )
