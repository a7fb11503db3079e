"""Second-order gradient-boosted trees as Spark jobs (B-1 .. B-8).

Standard regularised boosting (public formulation: Chen & Guestrin 2016):
``gain = 1/2 [T(GL)^2/(HL+l) + T(GR)^2/(HR+l) - T(G)^2/(H+l)] - gamma`` with
``T`` the L1 soft threshold, leaf weight ``-T(G)/(H+l)``, children need
``H >= min_child_weight``.

Many models train in the same passes. The state has one row for each data row, with its bins
and an array of margins for all models (held-out rows are routed too, so out-of-fold
predictions come for free). Each depth level is one job with one shuffle:

    state -> walk the trees grown so far -> dense histograms of each partition
          -> merged by (node, block of features) -> best split of each

Gradients are whole multiples of 2**-30, so sums, and with them trees, do not depend on how rows
are partitioned. Only winning splits return to the driver (bounded by models x trees x
2^depth x blocks of features) and go back as a broadcast.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cvforge.functions.columns import col
from cvforge.functions.ordering import BROADCAST_ROWS, with_running_totals
from cvforge.functions.sketch import column_cuts
from cvforge.session import write_shared
from cvforge.spec import BoostParams

GAIN_DIGITS = 12


@dataclass
class ModelSpec:
    model_id: int
    fold: int | None  # rows of this fold are held out; None trains on every row
    features: tuple[int, ...]  # allowed feature indices into the binned array
    params: BoostParams


@dataclass
class Binned:
    df: DataFrame  # row_id, fold, y, b (array<int>, feature order of ``features``)
    thresholds: DataFrame  # fi, bin, threshold: left child iff value < threshold
    features: list[str]
    missing_bin: int | None = None
    _rows: int | None = None

    def rows(self) -> int:
        if self._rows is None:
            self._rows = self.df.count()
        return self._rows

    def bins(self) -> int:
        """Bins of the feature that has most, the one for missing values included."""
        return int(self.thresholds.agg(F.max("bin")).first()[0] or 0) + 2


@dataclass
class TrainResult:
    trees: DataFrame  # model_id, round, tree, node, is_leaf, fi, feature, bin, threshold, gain, value
    state: DataFrame  # model_id, tree, row_id, fold, y, in_train, margin after the last round
    snapshots: DataFrame | None  # model_id, round, row_id, fold, y, margin..., for recorded rounds
    n_trees: int


# ---- B-4: binning -------------------------------------------------------------------


def bin_features(
    folded: DataFrame,
    features: list[str],
    target: str,
    max_bin: int | None = 256,
    fold_col: str = "fold",
    weight: str | None = None,
) -> Binned:
    """``max_bin`` (hist): distinct values when few, else quantile cuts from one scan, by rows or
    by the column ``weight`` (``functions.sketch``); ``None`` (exact): every distinct value is a candidate, ranked without a driver round trip."""
    spark = folded.sparkSession
    if max_bin is None:
        return _bin_exact(folded, features, target, fold_col)
    cuts = [found for found, _ in column_cuts(folded, features, max_bin, weight)]
    splits = [[-math.inf] + cuts[i] + [math.inf] for i in range(len(features))]
    xs = folded.select("row_id", F.col(fold_col).alias("fold"), col(target).alias("y"),
                       *[col(f).cast("double").alias(f"_x{i}") for i, f in enumerate(features)])
    # a feature without a cut (constant or all missing) has one bin for its values and one for missing
    cut = [i for i in range(len(features)) if cuts[i]]
    if cut:
        xs = Bucketizer(
            splitsArray=[splits[i] for i in cut],
            inputCols=[f"_x{i}" for i in cut],
            outputCols=[f"_b{i}" for i in cut],
            handleInvalid="keep",
        ).transform(xs)
    bins = [F.col(f"_b{i}").cast("int") if cuts[i] else F.col(f"_x{i}").isNull().cast("int") for i in range(len(features))]
    binned = xs.select("row_id", "fold", "y", F.array(*bins).alias("b"))
    thr_rows = [(i, s, float(splits[i][s + 1])) for i in range(len(features)) for s in range(len(splits[i]) - 1)]
    thresholds = spark.createDataFrame(thr_rows, "fi int, bin int, threshold double")
    return Binned(binned, thresholds, list(features))


def _bin_exact(folded: DataFrame, features: list[str], target: str, fold_col: str) -> Binned:
    """The rank of each value among its feature's values. Rows are not shuffled for features whose
    values are few enough to go to every task; a larger feature is joined with its ranks."""
    numbers = [col(f).cast("double") for f in features]
    cells = folded.select(F.posexplode(F.array(*numbers)).alias("fi", "v")).where(F.col("v").isNotNull()).distinct().withColumn("_one", F.lit(1))
    ranked = with_running_totals(cells, ["fi"], "v", ["_one"]).select("fi", "v", (F.col("cum__one") - 1).cast("int").alias("bin"))
    ranked = write_shared(ranked, "ranked")
    nxt = ranked.select("fi", (F.col("bin") - 1).alias("bin"), F.col("v").alias("threshold"))
    thresholds = ranked.select("fi", "bin").join(nxt, ["fi", "bin"], "left").select(
        F.col("fi").cast("int").alias("fi"), "bin", F.coalesce("threshold", F.lit(math.inf)).alias("threshold")
    )
    missing = 1 << 30
    sizes = {r["fi"]: r["n"] for r in ranked.groupBy("fi").agg(F.count(F.lit(1)).alias("n")).collect()}
    small: list[int] = []
    for i in sorted(range(len(features)), key=lambda i: sizes.get(i, 0)):
        if sum(sizes.get(j, 0) for j in small) + sizes.get(i, 0) <= BROADCAST_ROWS:
            small.append(i)
    rows = folded.select("row_id", F.col(fold_col).alias("fold"), col(target).alias("y"), *[x.alias(f"_x{i}") for i, x in enumerate(numbers)])
    for i in (i for i in range(len(features)) if i not in small):
        rows = rows.join(ranked.where(F.col("fi") == i).select(F.col("v").alias(f"_x{i}"), F.col("bin").alias(f"_b{i}")), f"_x{i}", "left")
    held = ranked.where(F.col("fi").isin(small)).select("fi", "v").toArrow()
    known = {i: np.sort(held.filter(pc.equal(held["fi"], i))["v"].to_numpy()) for i in small}
    told = folded.sparkSession.sparkContext.broadcast(known)

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bins = np.empty((batch.num_rows, len(features)), np.int32)
            for i in range(len(features)):
                if i in told.value:
                    x = batch.column(f"_x{i}")
                    bins[:, i] = np.searchsorted(told.value[i], x.to_numpy(zero_copy_only=False))
                    bins[x.is_null().to_numpy(zero_copy_only=False), i] = missing
                else:
                    bins[:, i] = pc.fill_null(batch.column(f"_b{i}"), missing).to_numpy(zero_copy_only=False)
            ends = pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * len(features))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ROW_COLS[:3]), pa.ListArray.from_arrays(ends, pa.array(bins.ravel()))], [*ROW_COLS])

    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    rows = rows.select(*ROW_COLS[:3], *[f"_x{i}" if i in small else f"_b{i}" for i in range(len(features))])
    return Binned(rows.mapInArrow(code, ", ".join(f"{c} {kinds[c]}" for c in ROW_COLS[:3]) + ", b array<int>"), thresholds, list(features), missing)


# ---- B-5: draws that SQL can repeat ---------------------------------------------------


def sampled_features(spec: ModelSpec, round_no: int) -> list[int]:
    """B-5: per-tree column draw, the ``max(1, floor(rate * n))`` features least by md5 of (seed, round, feature)."""
    feats = list(spec.features)
    n = max(1, int(spec.params.colsample_bytree * len(feats)))
    if n >= len(feats):
        return feats
    key = lambda fi: (hashlib.md5(f"{spec.params.seed}|{round_no}|f{fi}".encode()).hexdigest(), fi)
    return sorted(sorted(feats, key=key)[:n])


def row_draw(seed: int, round_no: int, key: str = "row_id") -> Column:
    """B-5: a number in [0, 1) for each row and round, the same for every model: the first 32 bits of an md5."""
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), F.lit(str(round_no)), F.col(key).cast("string")).cast("binary"))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / float(1 << 32)


# ---- trees as flat arrays ---------------------------------------------------------------


class Tree:
    """A growing tree as flat arrays. Entry 0 is the root; feature -1 marks a leaf or a node still open."""

    def __init__(self) -> None:
        self.node, self.feature, self.bin, self.left, self.right, self.value = [0], [-1], [0], [0], [0], [0.0]

    def split(self, at: int, feature: int, cut: int) -> tuple[int, int]:
        self.feature[at], self.bin[at] = feature, cut
        self.left[at], self.right[at] = len(self.node), len(self.node) + 1
        for side in (1, 2):
            self.node.append(2 * self.node[at] + side)
            for column, empty in ((self.feature, -1), (self.bin, 0), (self.left, 0), (self.right, 0), (self.value, 0.0)):
                column.append(empty)
        return self.left[at], self.right[at]

    def arrays(self) -> tuple[np.ndarray, ...]:
        ints = [np.array(x, np.int32) for x in (self.feature, self.bin, self.left, self.right)]
        return (*ints, np.array(self.value))


def ends_of(tree: tuple[np.ndarray, ...], bins: np.ndarray) -> np.ndarray:
    """The entry at which each row's way down the tree ends."""
    feature, cut, left, right, _ = tree
    at, rows = np.zeros(len(bins), np.int32), np.arange(len(bins))
    while True:
        f = feature[at]
        inner = f >= 0
        if not inner.any():
            return at
        go_right = bins[rows, np.maximum(f, 0)] > cut[at]
        at = np.where(inner, np.where(go_right, right[at], left[at]), at)


# ---- B-1 .. B-6: training ---------------------------------------------------------------


TREE_SCHEMA = "model_id int, round int, tree int, node long, is_leaf boolean, fi int, bin int, gain double, value double"
#: Gradients are whole multiples of 2**-GRAD_BITS, so their sums do not depend on partitioning.
GRAD_BITS = 30
SCALE = float(1 << GRAD_BITS)
#: Bytes of dense histograms a task holds; open nodes beyond them take another pass over the rows.
HIST_BYTES = 128 << 20
#: Histograms move in blocks of so many features, each merged by itself.
FEATURE_BLOCK = 8


@dataclass
class Batch:
    """What a pass over the rows must know: the models, and the trees grown since the state was written."""

    models: list[ModelSpec]
    n_trees: int
    grown: list[dict[tuple[int, int], tuple[np.ndarray, ...]]]

    def base(self) -> np.ndarray:
        one = [math.log(m.params.base_score / (1 - m.params.base_score)) if self.n_trees == 1 else 0.0 for m in self.models]
        return np.repeat(np.array(one), self.n_trees)

    def read(self, batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Bins (rows by features), folds, labels and margins (rows by models x trees) of some rows."""
        n = batch.num_rows
        bins = batch.column("b").flatten().to_numpy(zero_copy_only=False).reshape(n, -1)
        fold = pc.fill_null(batch.column("fold"), -2).to_numpy(zero_copy_only=False)
        if "margins" in batch.schema.names:
            margins = batch.column("margins").flatten().to_numpy(zero_copy_only=False).reshape(n, -1).copy()
        else:
            margins = np.repeat(self.base()[None, :], n, axis=0)
        for trees in self.grown:
            for (m, k), tree in trees.items():
                margins[:, m * self.n_trees + k] += tree[4][ends_of(tree, bins)]
        return bins, fold, batch.column("y").to_numpy(zero_copy_only=False), margins

    def trains(self, m: int, fold: np.ndarray) -> np.ndarray:
        held = self.models[m].fold
        return np.ones(len(fold), bool) if held is None else fold != held


def gradients(margins: np.ndarray, y: np.ndarray, weight: float) -> tuple[np.ndarray, np.ndarray]:
    """B-1: first and second derivatives (rows by trees), as whole numbers of 2**-GRAD_BITS."""
    if margins.shape[1] == 1:
        p = 1.0 / (1.0 + np.exp(-margins))
        hit = (y == 1)[:, None]
        w = np.where(hit, weight, 1.0)
        g, h = (p - hit) * w, p * (1 - p) * w
    else:
        each = np.ascontiguousarray(margins.T)  # few classes, many rows
        e = np.exp(each - each.max(0))
        p = (e / e.sum(0)).T
        g, h = p - (y == np.arange(margins.shape[1])[:, None]).T, 2.0 * p * (1 - p)
    return np.rint(g * SCALE), np.maximum(np.rint(h * SCALE), 1.0)


@dataclass
class Open:
    """A node to be split: which model and tree, its entry there and its depth."""

    model: int
    tree: int
    at: int
    depth: int


@dataclass
class Level:
    """A pass that gathers the histograms of some open nodes (their position here is their slot)."""

    batch: Batch
    nodes: list[Open]
    trees: dict[tuple[int, int], tuple[np.ndarray, ...]]
    allowed: dict[int, list[int]]  # features of each model in this round
    n_features: int
    n_bins: int

    def slots(self) -> dict[tuple[int, int], tuple[int, int, np.ndarray]]:
        """For each tree the first of its slots, their number, and the slot of each of its entries."""
        found: dict[tuple[int, int], list[int]] = {}
        for s, o in enumerate(self.nodes):
            found.setdefault((o.model, o.tree), []).append(s)
        out = {}
        for key, mine in found.items():
            slot = np.full(len(self.trees[key][0]), -1, np.int64)
            slot[[self.nodes[s].at for s in mine]] = np.arange(len(mine))
            out[key] = (mine[0], len(mine), slot)
        return out

    def active(self, batch: pa.RecordBatch) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """(first slot, slots, slot, bins of the model's features, g, h) of the rows that count, tree by tree."""
        bins, fold, y, margins = self.batch.read(batch)
        drawn = batch.column("draw").to_numpy(zero_copy_only=False) if "draw" in batch.schema.names else None
        t, rows_of, grads, bins_of = self.batch.n_trees, {}, {}, {}
        for (m, k), (first, many, slot) in self.slots().items():
            p = self.batch.models[m].params
            if m not in rows_of:
                rows = self.batch.trains(m, fold)
                rows_of[m] = np.flatnonzero(rows if drawn is None else rows & (drawn < p.subsample))
                grads[m] = gradients(margins[rows_of[m], m * t : m * t + t], y[rows_of[m]], p.scale_pos_weight)
                bins_of[m] = bins[rows_of[m]]
            here = slot[ends_of(self.trees[m, k], bins_of[m])]
            found = here, bins_of[m][:, self.allowed[m]], grads[m][0][:, k], grads[m][1][:, k]
            on = here >= 0
            if on.any():
                yield first, many, *(found if on.all() else (v[on] for v in found))

    def dense(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """B-2: one histogram for each slot and block of features, summed over all rows of the partition."""
        f, b = self.n_features, self.n_bins
        sums = np.zeros((2, len(self.nodes), f, b), np.int64)
        for batch in batches:
            for first, many, slot, bins, g, h in self.active(batch):
                mine = np.array(self.allowed[self.nodes[first].model])
                cell = (slot[:, None] * f + mine[None, :]) * b + np.minimum(bins, b - 1)
                for into, x in zip(sums, (g, h), strict=True):  # whole numbers below 2**53 in a batch
                    part = np.bincount(cell.ravel(), np.repeat(x, len(mine)), many * f * b)
                    into[first : first + many] += part.reshape(many, f, b).astype(np.int64)
        for s in np.flatnonzero(sums[1].any((1, 2))).tolist():
            for k in range(0, f, FEATURE_BLOCK):
                yield pa.RecordBatch.from_pydict(
                    {"slot": pa.array([s], pa.int32()), "block": pa.array([k], pa.int32()), "sums": pa.array([sums[:, s, k : k + FEATURE_BLOCK].tobytes()], pa.binary())}
                )

    def by_slot(self, batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """(slot, bins of the one feature allowed, g, h) in the order of the rows; g and h as whole numbers."""
        for first, many, slot, bins, g, h in self.active(batch):
            place = np.argsort(slot.astype(np.int32), kind="stable") if many > 1 else np.arange(len(slot))
            slot, b, g, h = slot[place], bins[place, 0], g[place].astype(np.int64), h[place].astype(np.int64)
            cuts = [0, *(np.flatnonzero(np.diff(slot)) + 1).tolist(), len(slot)]
            for start, end in pairwise(cuts):
                yield first + int(slot[start]), b[start:end], g[start:end], h[start:end]

    def range_sums(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """B-2 of rows in order of a feature: first bin and sums of each range and slot."""
        held: dict[tuple[int, int], list[int]] = {}
        for number, batch in in_ranges(batches):
            for slot, bins, g, h in self.by_slot(batch):
                mine = held.setdefault((number, slot), [int(bins[0]), 0, 0])
                mine[1] += int(g.sum())
                mine[2] += int(h.sum())
        if held:
            columns = zip(*((*key, *mine) for key, mine in held.items()), strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, RANGE_ARROW, strict=True)], schema=RANGE_ARROW)

    def range_best(self, batches: Iterator[pa.RecordBatch], before: dict, totals: dict) -> Iterator[pa.RecordBatch]:
        """B-3 of rows in order of a feature: the task's best split of each slot. ``before``: for each
        range and slot the sums of the ranges before it, and the slot's first bin after it."""
        best: dict[int, tuple] = {}
        fi = next(iter(self.allowed.values()))[0]

        def offer(slot: int, cuts: np.ndarray, gl: np.ndarray, hl: np.ndarray) -> None:
            p = self.batch.models[self.nodes[slot].model].params
            gl, hl = gl / SCALE, hl / SCALE
            total_g, total_h = totals[slot][0] / SCALE, totals[slot][1] / SCALE
            gain, valid = split_gain(gl, hl, total_g, total_h, p)
            if valid.any():
                rounded = np.where(valid, np.round(gain, GAIN_DIGITS), -np.inf)
                at = int(np.argmax(rounded))
                key = (-float(rounded[at]), int(cuts[at]))
                if slot not in best or key < best[slot][0]:
                    best[slot] = (key, float(gain[at]), total_g, total_h, float(gl[at]), float(hl[at]))

        def close() -> None:  # the last bin of a slot in a range, unless it goes on in a later one
            for slot, (g, h, last) in held.items():
                if before[at, slot][2] != last:
                    offer(slot, np.array([last]), np.array([g]), np.array([h]))

        at, held = None, {}
        for number, batch in in_ranges(batches):
            if number != at:
                close()
                at, held = number, {}
            for slot, bins, g, h in self.by_slot(batch):
                g0, h0, last = held[slot] if slot in held else (*before[at, slot][:2], bins[0])
                gl, hl = np.append(g0, g0 + np.cumsum(g)), np.append(h0, h0 + np.cumsum(h))
                cuts = np.append(last, bins)
                ends = np.flatnonzero(cuts[1:] != cuts[:-1])
                if len(ends):
                    offer(slot, cuts[ends], gl[ends], hl[ends])
                held[slot] = (gl[-1], hl[-1], bins[-1])
        close()
        for slot, ((_, cut), *rest) in best.items():
            row = dict(zip(SPLIT_ARROW.names, (slot, fi, cut, *rest), strict=True))
            yield pa.RecordBatch.from_pylist([row], schema=SPLIT_ARROW)

    def merge(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """B-3: add the sorted partitions' histograms of each slot and block, and find the best split there.

        Sums are kept as high and low halves, so they do not overflow however many rows there are.
        """
        held: tuple[int, int] | None = None
        high = low = np.zeros(0, np.int64)
        for batch in batches:
            for slot, block, raw in zip(*(batch.column(c).to_pylist() for c in ("slot", "block", "sums")), strict=True):
                sums = np.frombuffer(raw, np.int64)
                if held != (slot, block):
                    if held is not None:
                        yield self.best(held, high, low)
                    held, high, low = (slot, block), np.zeros(len(sums), np.int64), np.zeros(len(sums), np.int64)
                high += sums >> 32
                low += sums & 0xFFFFFFFF
        if held is not None:
            yield self.best(held, high, low)

    def best(self, key: tuple[int, int], high: np.ndarray, low: np.ndarray) -> pa.RecordBatch:
        slot, block = key
        p = self.batch.models[self.nodes[slot].model].params
        # running sums of whole numbers, so that only the sums themselves are rounded
        high, low = (x.reshape(2, -1, self.n_bins).cumsum(2) for x in (high, low))
        gl, hl = (high.astype(np.float64) * 2.0**32 + low) / SCALE
        mine = set(self.allowed[self.nodes[slot].model])
        free = np.array([block + j in mine for j in range(len(gl))])
        row = {"slot": slot, "fi": None, "bin": None, "gain": None, "G": None, "H": None, "GL": None, "HL": None}
        if free.any():
            some = int(np.flatnonzero(free)[0])
            total_g, total_h = gl[some, -1], hl[some, -1]
            gain, valid = split_gain(gl, hl, total_g, total_h, p)
            valid &= free[:, None]
            row |= {"G": float(total_g), "H": float(total_h)}
            if valid.any():
                at = int(np.argmax(np.where(valid, np.round(gain, GAIN_DIGITS), -np.inf)))
                j, cut = divmod(at, self.n_bins)
                row |= {"fi": block + j, "bin": cut, "gain": float(gain[j, cut]), "GL": float(gl[j, cut]), "HL": float(hl[j, cut])}
        return pa.RecordBatch.from_pylist([row], schema=SPLIT_ARROW)


SPLIT_ARROW = pa.schema([("slot", pa.int32()), ("fi", pa.int32()), ("bin", pa.int32()), *[(c, pa.float64()) for c in ("gain", "G", "H", "GL", "HL")]])
SPLIT_SCHEMA = "slot int, fi int, bin int, gain double, G double, H double, GL double, HL double"


RANGE_ARROW = pa.schema([("range", pa.int32()), ("slot", pa.int32()), ("first", pa.int32()), ("sg", pa.int64()), ("sh", pa.int64())])
RANGE_SCHEMA = "range int, slot int, first int, sg long, sh long"


def split_gain(gl: np.ndarray, hl: np.ndarray, total_g: float, total_h: float, p: BoostParams) -> tuple[np.ndarray, np.ndarray]:
    """Gain of the cuts with these sums to the left, and which of them may be taken."""
    gr, hr = total_g - gl, total_h - hl
    score = lambda g, h: np.maximum(np.abs(g) - p.reg_alpha, 0.0) ** 2 / (h + p.reg_lambda)
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = 0.5 * (score(gl, hl) + score(gr, hr) - score(total_g, total_h)) - p.gamma
    return gain, (hl >= p.min_child_weight) & (hr >= p.min_child_weight) & (hl > 0) & (hr > 1e-12)


#: Exact features of more bins than this have no dense histograms; the rows are kept in their order.
DENSE_BINS = 1024
#: Bytes of a range of rows in order: one row group of one file, which one task reads.
RANGE_BYTES = 4 << 20
#: Sums of ranges and open nodes that the driver takes at a time.
RANGE_SUMS = 1_000_000


def in_ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.RecordBatch]]:
    """(range, some of its rows) in order; each range must come whole."""
    at, seen = None, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        ranges, places = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("range", "place"))
        for start, end in pairwise([0, *(np.flatnonzero(np.diff(ranges)) + 1).tolist(), batch.num_rows]):
            if ranges[start] != at:
                at, seen = int(ranges[start]), 0
            if places[start] != seen or places[end - 1] != seen + end - start - 1:
                raise RuntimeError("a range of rows in order was not read as a whole; use larger parquet row groups")
            seen += end - start
            yield at, batch.slice(start, end - start)


def _in_order(state: DataFrame, fi: int, parts: int) -> DataFrame:
    """The rows in order of their bin of a feature; rows of one bin may lie in several ranges."""
    bin_ = F.element_at("b", fi + 1)
    ordered = state.repartitionByRange(parts, bin_, "row_id").sortWithinPartitions(bin_, "row_id")
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    return write_shared(ordered.withColumn("range", F.spark_partition_id()).withColumn("place", place), "boost-order")


def _best_in_order(rows: DataFrame, level: Level, fi: int) -> list[tuple]:
    """B-3 with a bin for each distinct value: one pass for the sums of each range, one for the best
    split given the sums before it. No row is moved; the driver holds a row for each range and open node."""
    own = [s for s, o in enumerate(level.nodes) if fi in level.allowed[o.model]]
    if not own:
        return []
    level = replace(level, nodes=[level.nodes[s] for s in own], allowed={o.model: [fi] for o in level.nodes if fi in level.allowed[o.model]})
    told = rows.sparkSession.sparkContext.broadcast(level)
    found = rows.mapInArrow(lambda b: told.value.range_sums(b), RANGE_SCHEMA).collect()
    before: dict[tuple[int, int], tuple] = {}
    totals: dict[int, tuple[int, int]] = {}
    follows: dict[int, int] = {}  # slot: its first bin in the ranges after
    for number, slot, _, g, h in sorted(found):
        before[number, slot] = (*totals.get(slot, (0, 0)), None)
        totals[slot] = (before[number, slot][0] + g, before[number, slot][1] + h)
    for number, slot, first, *_ in sorted(found, reverse=True):
        before[number, slot] = (*before[number, slot][:2], follows.get(slot))
        follows[slot] = first
    sums = rows.sparkSession.sparkContext.broadcast((before, totals))
    best = rows.mapInArrow(lambda b: told.value.range_best(b, *sums.value), SPLIT_SCHEMA).collect()
    told.destroy()
    sums.destroy()
    none = [(slot, None, None, None, g / SCALE, h / SCALE, None, None) for slot, (g, h) in totals.items()]
    return [(own[slot], *rest) for slot, *rest in [*none, *map(tuple, best)]]


def _gather(state: DataFrame, level: Level, orders: dict[int, DataFrame]) -> dict[int, tuple]:
    """The best split of each slot: one shuffle of histograms, then a row for each node and block of
    features; and of the features in ``orders`` by two passes over the rows in their order."""
    found: list[tuple] = []
    dense = replace(level, allowed={m: [f for f in mine if f not in orders] for m, mine in level.allowed.items()})
    if any(dense.allowed[o.model] for o in level.nodes):
        told = state.sparkSession.sparkContext.broadcast(dense)
        parts = state.mapInArrow(lambda rows: told.value.dense(rows), "slot int, block int, sums binary")
        dealt = parts.repartition("slot", "block").sortWithinPartitions("slot", "block")
        found += dealt.mapInArrow(lambda rows: told.value.merge(rows), SPLIT_SCHEMA).collect()
        told.destroy()
    for fi, rows in orders.items():
        found += _best_in_order(rows, level, fi)
    best: dict[int, tuple] = {}
    for slot, fi, cut, gain, *sums in found:
        key = (math.inf if gain is None else -round(gain, GAIN_DIGITS), fi if fi is not None else -1, cut if cut is not None else -1)
        if sums[0] is not None and (slot not in best or key < best[slot][0]):
            best[slot] = (key, fi, cut, gain, *sums)
    return best


def _advance(state: DataFrame, batch: Batch) -> DataFrame:
    """The rows with the margins that the trees grown so far give them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            margins = batch.read(rows)[3]
            ends = pa.array(np.arange(0, margins.size + 1, max(1, margins.shape[1]), dtype=np.int32)[: rows.num_rows + 1])
            yield pa.RecordBatch.from_arrays([*(rows.column(c) for c in ROW_COLS), pa.ListArray.from_arrays(ends, pa.array(margins.ravel()))], [*ROW_COLS, "margins"])

    kinds = {f.name: f.dataType.simpleString() for f in state.schema.fields}
    return state.mapInArrow(run, ", ".join(f"{c} {kinds[c]}" for c in ROW_COLS) + ", margins array<double>")


ROW_COLS = ("row_id", "fold", "y", "b")


def _exploded(state: DataFrame, batch: Batch, which: list[int], round_no: int | None, held_out_only: bool) -> DataFrame:
    """(model_id[, round], tree, row_id, fold, y, in_train, margin): a row for each model, tree and data row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            _, fold, _, margins = batch.read(rows)
            for m in which:
                trains = batch.trains(m, fold)
                at = pa.array(np.flatnonzero(~trains) if held_out_only else np.arange(rows.num_rows))
                for k in range(batch.n_trees):
                    same = lambda v, kind: pa.array(np.full(len(at), v), kind)
                    columns = {"model_id": same(batch.models[m].model_id, pa.int32())}
                    if round_no is not None:
                        columns["round"] = same(round_no, pa.int32())
                    columns |= {"tree": same(k, pa.int32()), **{c: rows.column(c).take(at) for c in ROW_COLS[:3]}}
                    columns |= {"in_train": pa.array(trains).take(at), "margin": pa.array(margins[:, m * batch.n_trees + k]).take(at)}
                    yield pa.RecordBatch.from_pydict(columns)

    kinds = {f.name: f.dataType.simpleString() for f in state.schema.fields}
    head = "model_id int" + (", round int" if round_no is not None else "") + ", tree int"
    return state.mapInArrow(run, f"{head}, row_id {kinds['row_id']}, fold {kinds['fold']}, y {kinds['y']}, in_train boolean, margin double")


def train(
    binned: Binned,
    models: list[ModelSpec],
    n_classes: int,
    record_rounds: dict[int, list[int]] | None = None,
    checkpoint_every: int = 8,
    keep_trees: bool = True,
    held_out_only: bool = False,
) -> TrainResult:
    """B-6: boosting loop over rounds and depth levels for a batch of models.

    The state is one row for each data row: its bins, and the margins of all models in one
    array. A level is one pass over it: rows find their node by walking the tree grown so far,
    each partition adds up dense histograms, and these, not the rows, are shuffled once. Every
    ``checkpoint_every`` rounds the margins are written to the shared folder; trees grown since are
    walked again. No row is joined, and models past their last round are left alone.

    ``record_rounds`` asks for the margins after some rounds; with ``held_out_only`` those are
    given for the rows of each model's own fold. The driver holds the trees since the last
    write and the open nodes of a level. Trees are written as they come, or dropped without ``keep_trees``.
    """
    spark: SparkSession = binned.df.sparkSession
    n_trees = 1 if n_classes == 2 else n_classes
    exact = binned.missing_bin is not None
    record_rounds = record_rounds or {}
    state = write_shared(binned.df.select(*ROW_COLS), "boost-rows")
    n_features, seed = len(binned.features), models[0].params.seed
    orders: dict[int, DataFrame] = {}
    if exact:
        bins = {r["fi"]: r["n"] for r in binned.thresholds.groupBy("fi").agg((F.max("bin") + 1).alias("n")).collect()}
        many = sorted(fi for fi, n in bins.items() if n > DENSE_BINS and any(fi in m.features for m in models))
        n_bins = max((n for n in bins.values() if n <= DENSE_BINS), default=0) + 1  # the last one for missing values
        row_bytes = 24 + 4 * n_features + (8 * len(models) * n_trees if max(m.params.n_estimators for m in models) > checkpoint_every else 0)
        parts = -(-state.count() * row_bytes // RANGE_BYTES) or 1
        orders = {fi: _in_order(state, fi, parts) for fi in many}
    else:
        n_bins = binned.bins()
    node_bytes = 16 * n_features * max(1, n_bins)
    per_pass = max(1, min(HIST_BYTES // node_bytes, RANGE_SUMS // parts if orders else HIST_BYTES))
    pending: list[dict[tuple[int, int], tuple[np.ndarray, ...]]] = []
    tree_rows: list[tuple] = []
    written: list[DataFrame] = []
    snaps: list[DataFrame] = []
    last = max(m.params.n_estimators for m in models)
    for r in range(1, last + 1):
        live = [i for i, m in enumerate(models) if r <= m.params.n_estimators]
        allowed = {i: sampled_features(models[i], r) for i in live}
        rows, ordered = state, orders
        if any(models[i].params.subsample < 1 for i in live):
            rows, ordered = state.withColumn("draw", row_draw(seed, r)), {fi: df.withColumn("draw", row_draw(seed, r)) for fi, df in orders.items()}
        trees = {(i, k): Tree() for i in live for k in range(n_trees)}

        def leaf(i: int, k: int, at: int, G: float, H: float) -> None:
            p, tree = models[i].params, trees[i, k]
            tree.value[at] = -math.copysign(max(abs(G) - p.reg_alpha, 0.0), G) / (H + p.reg_lambda) * p.learning_rate
            tree_rows.append((models[i].model_id, r, k, tree.node[at], True, None, None, None, tree.value[at]))

        open_nodes = [Open(i, k, 0, 0) for i, k in trees]
        while open_nodes:
            deeper: list[Open] = []
            arrays = {key: trees[key].arrays() for key in {(o.model, o.tree) for o in open_nodes}}
            for start in range(0, len(open_nodes), per_pass):
                nodes = open_nodes[start : start + per_pass]
                level = Level(Batch(models, n_trees, pending), nodes, arrays, allowed, n_features, n_bins)
                for slot, (_, fi, cut, gain, G, H, GL, HL) in sorted(_gather(rows, level, ordered).items()):
                    o = nodes[slot]
                    if gain is None or gain <= 0:
                        leaf(o.model, o.tree, o.at, G, H)
                        continue
                    tree = trees[o.model, o.tree]
                    tree_rows.append((models[o.model].model_id, r, o.tree, tree.node[o.at], False, fi, cut, float(gain), None))
                    left, right = tree.split(o.at, fi, cut)
                    if o.depth + 1 >= models[o.model].params.max_depth:
                        leaf(o.model, o.tree, left, GL, HL)
                        leaf(o.model, o.tree, right, G - GL, H - HL)
                    else:
                        deeper += [Open(o.model, o.tree, left, o.depth + 1), Open(o.model, o.tree, right, o.depth + 1)]
            open_nodes = deeper
        pending = [*pending, {key: tree.arrays() for key, tree in trees.items()}]
        if asked := [i for i in live if r in record_rounds.get(models[i].model_id, ())]:
            snaps.append(_exploded(state, Batch(models, n_trees, pending), asked, r, held_out_only))
        if r % checkpoint_every == 0 and r < last:
            state, pending = write_shared(_advance(state, Batch(models, n_trees, pending)), "boost-rows"), []
            orders = {fi: _in_order(state, fi, parts) for fi in orders}
        if keep_trees and (r % checkpoint_every == 0 or r == last):
            written.append(write_shared(spark.createDataFrame(tree_rows, TREE_SCHEMA), "trees"))
            tree_rows.clear()
        elif not keep_trees:
            tree_rows.clear()
    trees_df = spark.createDataFrame([], TREE_SCHEMA)
    for part in written:
        trees_df = trees_df.unionByName(part)
    # histogram cut points are bounded (features x max_bin) and broadcast; exact-mode
    # thresholds are one row per distinct value, so the planner chooses the join there
    thresholds = binned.thresholds if exact else F.broadcast(binned.thresholds)
    trees_df = trees_df.join(thresholds, ["fi", "bin"], "left").select(
        "model_id", "round", "tree", "node", "is_leaf", "fi",
        F.when(F.col("fi").isNotNull(), F.element_at(F.array(*[F.lit(f) for f in binned.features]), F.col("fi") + 1)).alias(
            "feature"
        ),
        "bin", "threshold", "gain", "value",
    )
    snapshots = None
    for s in snaps:
        snapshots = s if snapshots is None else snapshots.unionByName(s)
    full = _exploded(state, Batch(models, n_trees, pending), list(range(len(models))), None, False)
    return TrainResult(trees_df, full, snapshots, n_trees)


def probabilities(state: DataFrame, n_classes: int, keys: tuple[str, ...] = ("model_id", "row_id")) -> DataFrame:
    """B-7: per (model, row) class probabilities and argmax class (ties -> lower class)."""
    if n_classes == 2:
        p1 = 1.0 / (1.0 + F.exp(-F.col("margin")))
        out = state.where(F.col("tree") == 0).select(
            *keys, "fold", "y", "in_train", F.array(1.0 - p1, p1).alias("probability")
        )
    else:
        trees = state.groupBy(*keys, "fold", "y", "in_train").agg(
            F.transform(F.array_sort(F.collect_list(F.struct("tree", "margin"))), lambda s: s["margin"]).alias("_m")
        )
        e = trees.withColumn("_e", F.transform("_m", lambda v: F.exp(v - F.array_max("_m"))))
        whole = F.aggregate("_e", F.lit(0.0), lambda a, v: a + v)
        out = e.select(*keys, "fold", "y", "in_train", F.transform("_e", lambda v: v / whole).alias("probability"))
    return out.withColumn("pred", argmax("probability", n_classes))


def argmax(column: str, n_classes: int) -> Column:
    """The class of the highest probability, of several the lowest class."""
    best = F.aggregate(
        F.sequence(F.lit(0), F.lit(n_classes - 1)),
        F.lit(0),
        lambda acc, k: F.when(F.element_at(column, k + 1) > F.element_at(column, acc + 1), k).otherwise(acc),
    )
    return best.cast("int")


#: Nodes of a forest that are shipped to the tasks at a time.
FOREST_NODES = 1_000_000


def forest(trees: DataFrame) -> DataFrame:
    """B-7: one row for each tree, its nodes as flat arrays in node order: (model_id, round, tree, nodes,
    features, thresholds, values). A child is found by its number, 2n + 1 or 2n + 2."""
    entry = F.struct("node", F.coalesce("fi", F.lit(-1)).alias("fi"), F.coalesce("threshold", F.lit(math.nan)).alias("threshold"), F.coalesce("value", F.lit(0.0)).alias("value"))
    flat = trees.groupBy("model_id", "round", "tree").agg(F.array_sort(F.collect_list(entry)).alias("e"))
    names = {"nodes": "node", "features": "fi", "thresholds": "threshold", "values": "value"}
    return flat.select("model_id", "round", "tree", *[F.col("e")[c].alias(n) for n, c in names.items()])


def predict(
    trees: DataFrame,
    rows: DataFrame,
    features: list[str],
    models: list[ModelSpec],
    n_classes: int,
    keys: tuple[str, ...] = ("row_id",),
) -> DataFrame:
    """B-7 on new rows: route raw feature values through a tree table (``value < threshold``
    goes left, missing goes right) and return ``(model_id, keys..., probability, pred)``.

    The forest is taken in blocks of about FOREST_NODES nodes, in order of round; each block is
    one pass that adds to the rows' margins, so no task holds more than a block.
    """
    spark = rows.sparkSession
    n_trees = 1 if n_classes == 2 else n_classes
    place = {m.model_id: i for i, m in enumerate(models)}
    base = Batch(models, n_trees, []).base()
    flat = write_shared(forest(trees), "forest")
    sizes = flat.groupBy("round").agg(F.sum(F.size("nodes")).alias("n")).orderBy("round").collect()
    blocks, held = [[]], 0
    for r, n in sizes:  # rounds of a block; a round of more nodes is a block of its own
        if held and held + n > FOREST_NODES:
            blocks.append([])
            held = 0
        blocks[-1].append(r)
        held += n
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    head = ", ".join(f"`{k}` {kinds[k]}" for k in keys) + ", x array<double>, margins array<double>"
    state = rows.select(*[col(k) for k in keys], F.array(*[col(f).cast("double") for f in features]).alias("x"), F.array(*[F.lit(float(v)) for v in base]).alias("margins"))

    def adder(block: list[tuple]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                n = batch.num_rows
                x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(n, -1)
                margins = batch.column("margins").flatten().to_numpy(zero_copy_only=False).reshape(n, -1).copy()
                for column, tree in block:
                    margins[:, column] += tree[4][raw_ends(tree, x)]
                ends = pa.array(np.arange(n + 1, dtype=np.int32) * margins.shape[1])
                yield batch.set_column(batch.schema.names.index("margins"), "margins", pa.ListArray.from_arrays(ends, pa.array(margins.ravel())))

        return add

    for number, rounds in enumerate(blocks):
        block = []
        for t in flat.where(F.col("round").isin(rounds)).orderBy("round", "model_id", "tree").collect():
            if t["model_id"] in place:
                block.append((place[t["model_id"]] * n_trees + t["tree"], flat_tree(t["nodes"], t["features"], t["thresholds"], t["values"])))
        state = state.mapInArrow(adder(block), head)
        if number + 1 < len(blocks):
            state = write_shared(state, "forest-margins")
    ids = F.array(*[F.lit(m.model_id) for m in models])
    each = state.select(*[col(k) for k in keys], F.posexplode(ids).alias("_m", "model_id"), "margins")
    own = F.slice("margins", F.col("_m") * n_trees + 1, n_trees)
    if n_trees == 1:
        p1 = 1.0 / (1.0 + F.exp(-F.element_at(own, 1)))
        probability = F.array(1.0 - p1, p1)
    else:
        e = F.transform(own, lambda v: F.exp(v - F.array_max(own)))
        probability = F.transform(e, lambda v: v / F.aggregate(e, F.lit(0.0), lambda a, w: a + w))
    out = each.select("model_id", *[col(k) for k in keys], probability.alias("probability"))
    return out.withColumn("pred", argmax("probability", n_classes))


def flat_tree(nodes: list[int], features: list[int], thresholds: list[float], values: list[float]) -> tuple[np.ndarray, ...]:
    """(feature, threshold, left, right, value) of a tree; children by their place in the arrays."""
    at = {n: i for i, n in enumerate(nodes)}
    left, right = ([at.get(2 * n + s, 0) for n in nodes] for s in (1, 2))
    return np.array(features, np.int32), np.array(thresholds), np.array(left, np.int32), np.array(right, np.int32), np.array(values)


def raw_ends(tree: tuple[np.ndarray, ...], x: np.ndarray) -> np.ndarray:
    """The entry at which each row's raw values end; missing values compare false and go right."""
    feature, threshold, left, right, _ = tree
    at, rows = np.zeros(len(x), np.int32), np.arange(len(x))
    while True:
        f = feature[at]
        inner = f >= 0
        if not inner.any():
            return at
        go_left = x[rows, np.maximum(f, 0)] < threshold[at]
        at = np.where(inner, np.where(go_left, left[at], right[at]), at)
