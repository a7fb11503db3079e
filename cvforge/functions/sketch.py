"""Mergeable weighted quantile sketches of many columns in one scan.

A sketch is at most ``points`` values in ascending order, each with the weight of the values
that it stands for, and ``err``: the estimated rank of any number (the weights of the values up
to it) is at most ``err`` below its true rank and never above it. Up to ``points`` distinct
values a sketch is exact and ``err`` is 0. Cutting a sketch of total weight W down adds at most
W / points; merging adds up errors. Tasks keep one sketch a level, as in a binary counter, so a
task of 2^n batches cuts a value's weight n times, and partial sketches merge in two steps.
Missing values, and rows whose weight is missing or not above 0, have no part in it.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cvforge.functions.columns import col

POINTS = 16_384
#: Values of one column that a task turns into a sketch at a time.
BATCH = 1 << 16
SCHEMA = "fi int, v array<double>, w array<double>, err double"
Sketch = tuple[np.ndarray, np.ndarray, float]


def summarize(v: np.ndarray, w: np.ndarray, err: float, points: int) -> Sketch:
    """One sketch of values with weights; ``err`` is what they are off already."""
    values, place = np.unique(v, return_inverse=True)
    weights = np.bincount(place, weights=w, minlength=len(values))
    if len(values) <= points:
        return values, weights, err
    upto = np.cumsum(weights)
    kept = np.unique(np.searchsorted(upto, upto[-1] * (np.arange(1, points + 1) / points), side="left").clip(max=len(values) - 1))
    return values[kept], np.diff(upto[kept], prepend=0.0), err + upto[-1] / points


def merge(sketches: Sequence[Sketch], points: int) -> Sketch:
    return summarize(np.concatenate([s[0] for s in sketches]), np.concatenate([s[1] for s in sketches]), sum(s[2] for s in sketches), points)


def _table(found: dict[int, Sketch]) -> pa.Table:
    return pa.table(
        {
            "fi": pa.array(list(found), pa.int32()),
            "v": pa.array([s[0] for s in found.values()], pa.list_(pa.float64())),
            "w": pa.array([s[1] for s in found.values()], pa.list_(pa.float64())),
            "err": pa.array([s[2] for s in found.values()], pa.float64()),
        }
    )


def quantile_sketches(df: DataFrame, columns: Sequence[str], weight: str | None = None, points: int = POINTS, fan: int = 64) -> DataFrame:
    """(fi, v, w, err): the sketch of each column that has a value, ``fi`` its place in ``columns``.

    ``weight`` names a column, such as the second derivatives of a boosting round. Tasks send one
    sketch a column; ``fan`` tasks a column merge them first.
    """
    n = len(columns)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        levels: list[dict[int, Sketch]] = [{} for _ in range(n)]
        for batch in batches:
            w = batch.column(n).to_numpy(zero_copy_only=False)
            for start in range(0, batch.num_rows, BATCH):
                part = slice(start, start + BATCH)
                for i in range(n):
                    v = batch.column(i).to_numpy(zero_copy_only=False).astype(float)[part]
                    good = ~np.isnan(v) & (w[part] > 0)
                    if not good.any():
                        continue
                    new, level = summarize(v[good], w[part][good], 0.0, points), 0
                    while level in levels[i]:
                        new, level = merge([levels[i].pop(level), new], points), level + 1
                    levels[i][level] = new
        found = {i: merge([held[k] for k in sorted(held)], points) for i, held in enumerate(levels) if held}
        yield from _table(found).to_batches()

    def together(table: pa.Table) -> pa.Table:
        # pairs first, so that the weight of a value is cut a logarithm of times
        parts = [(np.array(r["v"], float), np.array(r["w"], float), r["err"]) for r in table.select(["v", "w", "err"]).to_pylist()]
        while len(parts) > 1:
            parts = [merge(parts[k : k + 2], points) for k in range(0, len(parts), 2)]
        return _table({table["fi"][0].as_py(): parts[0]})

    w = F.lit(1.0) if weight is None else F.coalesce(col(weight).cast("double"), F.lit(0.0))
    values = df.select(*[col(c).cast("double").alias(f"x{i}") for i, c in enumerate(columns)], w.alias("w"))
    partials = values.mapInArrow(partial, SCHEMA).withColumn("part", F.pmod(F.spark_partition_id(), F.lit(fan)))
    return partials.groupBy("fi", "part").applyInArrow(together, SCHEMA).groupBy("fi").applyInArrow(together, SCHEMA)


def cut_points(sketch: Sketch, bins: int) -> list[float]:
    """Where to cut so that each of ``bins`` parts has about the same weight: all distinct values
    but the least, if the sketch is exact and holds no more than ``bins``."""
    v, w, err = sketch
    if err == 0 and len(v) <= bins:
        return [float(x) for x in v[1:]]
    upto = np.cumsum(w)
    at = np.searchsorted(upto, upto[-1] * (np.arange(1, bins) / bins), side="left").clip(max=len(v) - 1)
    return [float(x) for x in v[np.unique(at)]]


def column_cuts(df: DataFrame, columns: Sequence[str], bins: int, weight: str | None = None, points: int = POINTS) -> list[tuple[list[float], bool]]:
    """For each column its cut points (``bins`` at most) and whether they are all its values but the least.

    The cuts of a column are taken in the task that holds its sketch; the driver gets columns x bins numbers.
    """

    def cut(table: pa.Table) -> pa.Table:
        r = table.to_pylist()[0]
        sketch = (np.array(r["v"], float), np.array(r["w"], float), r["err"])
        whole = sketch[2] == 0 and len(sketch[0]) <= bins
        return pa.table({"fi": pa.array([r["fi"]], pa.int32()), "cuts": pa.array([cut_points(sketch, bins)], pa.list_(pa.float64())), "whole": [whole]})

    found = quantile_sketches(df, columns, weight, points).groupBy("fi").applyInArrow(cut, "fi int, cuts array<double>, whole boolean")
    cuts = {r["fi"]: (list(r["cuts"]), r["whole"]) for r in found.collect()}
    return [cuts.get(i, ([], True)) for i in range(len(columns))]
