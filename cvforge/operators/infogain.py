"""Entropy information gain and fold-local feature ranking (E-14, I-1 .. I-9).

Plan (one shuffle for all K folds):

    modeling(fold, y, f1..fm)
      -> unpivot                          (feature, value, fold, y)
      -> groupBy(feature, value)          count per (fold, class)   [partial agg]
      -> per fold f: train = total - fold_f  (array arithmetic, no join)
      -> H(Y|X) terms per (fold, feature, value)
      -> groupBy(fold, feature)           sum of terms, value count [tiny]
      -> IG = H(Y)_f - H(Y|X)_f, row_number per fold

Missing values are imputed from each fold's training rows before the entropy, as the
workflow does: numbers with the median, text with the most frequent value.

With text features, or when folds x classes would pass ``WIDE_CELLS`` columns, classes are
rows instead of columns:

    -> groupBy(feature, value, y)       one training count per fold
    -> groupBy(feature, value)          n and sum n log n per fold
    -> groupBy(feature)                 terms and value counts per fold  [tiny]

so the plan's width depends on the number of folds alone.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from cvforge.functions.columns import col, entropy_term
from cvforge.functions.ordering import weighted_quantiles

IG_ENCODING = {
    "numeric": "encoded numeric values",
    "binary_encoded": "encoded binary values",
    "ordinal_encoded": "encoded ordinal values",
    "one_hot_encoded": "encoded one-hot dummy values",
}
FORMULA = "H(Y) - H(Y|X)"
RANK_DIGITS = 12  # ties closer than 1e-12 are broken by feature name
WIDE_CELLS = 64  # folds x classes up to which each pair has a column of its own


def entropy_of_counts(counts: Sequence[Column]) -> Column:
    """I-1: H = -sum p log2 p over class counts (0 for an empty set)."""
    total = sum(counts[1:], counts[0])
    return F.when(total > 0, -sum((entropy_term(c, total) for c in counts[1:]), entropy_term(counts[0], total)) / total).otherwise(
        F.lit(0.0)
    )


def _long_cells(modeling: DataFrame, features: Sequence[str], target: str, fold_col: str | None) -> DataFrame:
    fold = col(fold_col) if fold_col else F.lit(1)
    long = modeling.select(
        fold.alias("_fold"),
        col(target).alias("_y"),
        F.explode(
            F.array(*[F.struct(F.lit(f).alias("feature"), col(f).cast("double").alias("value")) for f in features])
        ).alias("_c"),
    )
    return long.select("_fold", "_y", "_c.feature", "_c.value")


def _class_count_cols(n_classes: int) -> list[str]:
    return [f"t{c}" for c in range(n_classes)]


def _train_cells(
    modeling: DataFrame,
    features: Sequence[str],
    target: str,
    n_classes: int,
    folds: int | None,
    fold_col: str,
) -> tuple[DataFrame, DataFrame]:
    """Per (fold, feature, value): training count per class ``t0..t{C-1}``.

    ``folds=None`` means one pseudo-fold holding every row (whole-table IG).
    Also returns per-fold class totals (fold, t0..).
    """
    k = folds or 1
    long = _long_cells(modeling, features, target, fold_col if folds else None)
    cnt = {
        (f, c): F.count_if((F.col("_fold") == f) & (F.col("_y") == c)).alias(f"c_{f}_{c}")
        for f in range(1, k + 1)
        for c in range(n_classes)
    }
    cells = long.groupBy("feature", "value").agg(*cnt.values())
    per_fold = []
    for f in range(1, k + 1):
        if folds:
            train = [
                (sum((F.col(f"c_{g}_{c}") for g in range(1, k + 1) if g != f), F.lit(0))).alias(f"t{c}")
                for c in range(n_classes)
            ]
        else:
            train = [F.col(f"c_{f}_{c}").alias(f"t{c}") for c in range(n_classes)]
        per_fold.append(F.struct(F.lit(f).alias("fold"), *train))
    exploded = cells.select("feature", "value", F.explode(F.array(*per_fold)).alias("_t")).select(
        "_t.fold", "feature", "value", *[f"_t.t{c}" for c in range(n_classes)]
    )
    tcols = _class_count_cols(n_classes)
    exploded = exploded.where(sum((F.col(t) for t in tcols[1:]), F.col(tcols[0])) > 0)
    # class totals per training fold from a two-column scan (K x C cells), not from the cells above
    fold = col(fold_col) if folds else F.lit(1)
    by_fold = modeling.select(fold.alias("_fold"), col(target).alias("_y")).groupBy().agg(
        *[F.count_if((F.col("_fold") == f) & (F.col("_y") == c)).alias(f"c_{f}_{c}") for f in range(1, k + 1) for c in range(n_classes)]
    )
    totals = by_fold.select(F.explode(F.array(*per_fold)).alias("_t")).select("_t.fold", *[f"_t.t{c}" for c in range(n_classes)])
    return exploded, totals


def _impute_missing(cells: DataFrame, n_classes: int, nullable: Sequence[str]) -> DataFrame:
    """E-14: move each fold's missing-value cell onto the training-fold median.

    Only ``nullable`` features (numeric columns coerced from text, or any numeric
    column of an uncleaned table) can hold missing values; the others skip this path.
    """
    tcols = _class_count_cols(n_classes)
    n_x = sum((F.col(t) for t in tcols[1:]), F.col(tcols[0]))
    is_nullable = F.col("feature").isin(*nullable)
    with_nulls = cells.where(is_nullable)
    clean = cells.where(~is_nullable)
    present = with_nulls.where(F.col("value").isNotNull()).withColumn("_n", n_x)
    medians = weighted_quantiles(present, ["fold", "feature"], "value", "_n", [0.5]).select(
        "fold", "feature", F.col("quantile").alias("_median")
    )
    missing = (
        with_nulls.where(F.col("value").isNull())
        .join(medians, ["fold", "feature"], "left")
        .withColumn("value", F.col("_median"))
        .drop("_median")
    )
    merged = (
        present.drop("_n")
        .unionByName(missing)
        .groupBy("fold", "feature", "value")
        .agg(*[F.sum(t).alias(t) for t in tcols])
    )
    return clean.unionByName(merged)


def _n_log_n(n: Column) -> Column:
    return F.when(n > 0, n * F.log2(n)).otherwise(F.lit(0.0))


def _by_fold(k: int, **fields: str) -> Column:
    """One struct for each fold: its number and, as ``name``, the column ``prefix + fold``."""
    return F.explode(F.array(*[F.struct(F.lit(f).alias("fold"), *[F.col(f"{p}{f}").alias(n) for n, p in fields.items()]) for f in range(1, k + 1)]))


def _impute_cells(cells: DataFrame, k: int, gappy: Sequence[str]) -> DataFrame:
    """E-14 on (feature, value, text, y, t1..tK): a fold's missing cell moves onto its median or most frequent value.

    Ties go to the smallest text. A feature without any value in a training fold keeps
    its missing cell there. Missing cells are classes x features at most.
    """
    t = [f"t{f}" for f in range(1, k + 1)]
    missing = F.col("value").isNull() & F.col("text").isNull()
    open_ = cells.where(F.col("feature").isin(*gappy))
    present, absent = open_.where(~missing), open_.where(missing)
    sizes = present.groupBy("feature", "value", "text").agg(*[F.sum(c).alias(c) for c in t])
    modes = (
        sizes.where(F.col("text").isNotNull())
        .groupBy("feature")
        .agg(*[F.min(F.when(F.col(c) > 0, F.struct((-F.col(c)).alias("n"), F.col("text").alias("text")))).alias(f"m{i}") for i, c in enumerate(t, 1)])
        .select("feature", _by_fold(k, best="m").alias("_m"))
        .select("_m.fold", "feature", F.lit(None).cast("double").alias("value"), F.col("_m.best.text").alias("text"))
    )
    numbers = sizes.where(F.col("value").isNotNull()).select("feature", "value", _by_fold(k, n="t").alias("_t")).select("_t.fold", "feature", "value", "_t.n")
    medians = weighted_quantiles(numbers, ["fold", "feature"], "value", "n", [0.5]).select(
        "fold", "feature", F.col("quantile").alias("value"), F.lit(None).cast("string").alias("text")
    )
    moved = (
        absent.select("feature", "_y", _by_fold(k, n="t").alias("_t"))
        .select("_t.fold", "feature", "_y", "_t.n")
        .where("n > 0")
        .join(modes.unionByName(medians), ["fold", "feature"], "left")
        .select("feature", "value", "text", "_y", *[F.when(F.col("fold") == i, F.col("n")).otherwise(F.lit(0)).alias(c) for i, c in enumerate(t, 1)])
    )
    filled = present.unionByName(moved).groupBy("feature", "value", "text", "_y").agg(*[F.sum(c).alias(c) for c in t])
    return cells.where(~F.col("feature").isin(*gappy)).unionByName(filled)


def _sparse_terms(
    modeling: DataFrame, features: Sequence[str], target: str, folds: int | None, fold_col: str, nullable: Sequence[str]
) -> tuple[DataFrame, DataFrame]:
    """(fold, feature, _s, _k) and (fold, _n, target_entropy) with a row, not a column, for each class."""
    k = folds or 1
    words = {f for f in features if isinstance(modeling.schema[f].dataType, StringType)}
    null = F.lit(None)
    entries = [
        F.struct(
            F.lit(f).alias("feature"),
            (null.cast("double") if f in words else F.nanvl(col(f).cast("double"), null.cast("double"))).alias("value"),
            (col(f) if f in words else null.cast("string")).alias("text"),
        )
        for f in features
    ]
    rows = modeling.where(col(target).isNotNull())
    fold = col(fold_col) if folds else F.lit(0)
    train = [F.count_if(F.col("_fold") != f).alias(f"t{f}") for f in range(1, k + 1)]
    long = rows.select(fold.alias("_fold"), col(target).alias("_y"), F.explode(F.array(*entries)).alias("_c")).select("_fold", "_y", "_c.*")
    cells = long.groupBy("feature", "value", "text", "_y").agg(*train)
    gappy = sorted(words | set(nullable))
    if gappy:
        cells = _impute_cells(cells, k, gappy)
    of = range(1, k + 1)
    values = cells.groupBy("feature", "value", "text").agg(
        *[F.sum(f"t{f}").alias(f"n{f}") for f in of], *[F.sum(_n_log_n(F.col(f"t{f}"))).alias(f"s{f}") for f in of]
    )
    per_feature = values.groupBy("feature").agg(
        *[F.sum(F.col(f"s{f}") - _n_log_n(F.col(f"n{f}"))).alias(f"_s{f}") for f in of],
        *[F.count_if(F.col(f"n{f}") > 0).alias(f"_k{f}") for f in of],
    )
    per_feature = per_feature.select("feature", _by_fold(k, _s="_s", _k="_k").alias("_t")).select("_t.fold", "feature", "_t._s", "_t._k")
    classes = rows.select(fold.alias("_fold"), col(target).alias("_y")).groupBy("_y").agg(*train)
    sums = classes.agg(*[F.sum(f"t{f}").alias(f"n{f}") for f in of], *[F.sum(_n_log_n(F.col(f"t{f}"))).alias(f"s{f}") for f in of])
    stats = sums.select(_by_fold(k, n="n", s="s").alias("_t")).select(
        "_t.fold",
        F.col("_t.n").alias("_n"),
        F.when(F.col("_t.n") > 0, F.greatest(F.lit(0.0), (_n_log_n(F.col("_t.n")) - F.col("_t.s")) / F.col("_t.n"))).otherwise(F.lit(0.0)).alias("target_entropy"),
    )
    return per_feature, stats


def _fold_stats(totals: DataFrame, n_classes: int) -> DataFrame:
    tcols = _class_count_cols(n_classes)
    return totals.select(
        "fold",
        sum((F.col(t) for t in tcols[1:]), F.col(tcols[0])).alias("_n"),
        entropy_of_counts([F.col(t) for t in tcols]).alias("target_entropy"),
    )


def _rank_table(per_feature: DataFrame, fold_stats: DataFrame, roles: dict[str, str] | None) -> DataFrame:
    # one row per fold: the broadcast is bounded by K
    joined = per_feature.join(F.broadcast(fold_stats), "fold")
    # 0 - s rather than -s: an all-zero sum must give +0.0, never -0.0
    cond = F.when(F.col("_n") > 0, (F.lit(0.0) - F.col("_s")) / F.col("_n")).otherwise(F.lit(0.0))
    role_map = roles or {}
    role = (
        F.element_at(F.create_map(*[x for k, v in role_map.items() for x in (F.lit(k), F.lit(v))]), F.col("feature"))
        if role_map
        else F.lit(None).cast("string")
    )
    role = F.coalesce(role, F.lit("encoded"))
    enc = F.create_map(*[x for k, v in IG_ENCODING.items() for x in (F.lit(k), F.lit(v))])
    ranked = joined.select(
        "fold",
        "feature",
        role.alias("role"),
        (F.col("target_entropy") - cond).alias("information_gain"),
        "target_entropy",
        cond.alias("conditional_entropy"),
        F.col("_k").alias("feature_value_count"),
        F.coalesce(F.element_at(enc, role), F.lit("encoded values")).alias("ig_encoding"),
        F.lit(FORMULA).alias("formula"),
    )
    w = Window.partitionBy("fold").orderBy(F.round("information_gain", RANK_DIGITS).desc(), F.col("feature").asc())
    return ranked.withColumn("rank", F.row_number().over(w)).select(
        "fold",
        "rank",
        "feature",
        "role",
        "information_gain",
        "target_entropy",
        "conditional_entropy",
        "feature_value_count",
        "ig_encoding",
        "formula",
    )


def fold_information_gain(
    modeling: DataFrame,
    features: Sequence[str],
    target: str,
    n_classes: int,
    folds: int | None,
    fold_col: str = "fold",
    roles: dict[str, str] | None = None,
    nullable: Sequence[str] = (),
) -> DataFrame:
    """I-4 (``folds=K``): IG ranking on each fold's training rows; I-3 (``folds=None``): whole table.

    Output: fold, rank, feature, role, information_gain, target_entropy,
    conditional_entropy, feature_value_count, ig_encoding, formula. Missing numbers are
    imputed in the ``nullable`` features, missing text in every text feature.
    """
    text = any(isinstance(modeling.schema[f].dataType, StringType) for f in features)
    if text or (folds or 1) * n_classes > WIDE_CELLS:
        return _rank_table(*_sparse_terms(modeling, features, target, folds, fold_col, nullable), roles)
    cells, totals = _train_cells(modeling, features, target, n_classes, folds, fold_col)
    if nullable:
        cells = _impute_missing(cells, n_classes, nullable)
    tcols = _class_count_cols(n_classes)
    n_x = sum((F.col(t) for t in tcols[1:]), F.col(tcols[0]))
    terms = cells.select(
        "fold",
        "feature",
        sum((entropy_term(F.col(t), n_x) for t in tcols[1:]), entropy_term(F.col(tcols[0]), n_x)).alias("_term"),
    )
    per_feature = terms.groupBy("fold", "feature").agg(
        F.sum("_term").alias("_s"), F.count(F.lit(1)).alias("_k")
    )
    return _rank_table(per_feature, _fold_stats(totals, n_classes), roles)


def information_gain(
    modeling: DataFrame,
    features: Sequence[str],
    target: str,
    n_classes: int,
    roles: dict[str, str] | None = None,
    nullable: Sequence[str] = (),
) -> DataFrame:
    """I-3: IG ranking over the whole table (rank, feature, role, IG, entropies, ...)."""
    return fold_information_gain(modeling, features, target, n_classes, None, roles=roles, nullable=nullable).drop("fold")


def selected_features(fold_ig: DataFrame, top_k: int | None) -> DataFrame:
    """I-5: (fold, rank, feature) of the top-k ranked features; ``None`` keeps every feature."""
    sel = fold_ig.select("fold", "rank", "feature")
    return sel if top_k is None else sel.where(F.col("rank") <= F.lit(int(top_k)))


def selection_frequency(fold_ig: DataFrame, top_k: int | None, total_folds: int) -> DataFrame:
    """I-6: rank, feature, selected_in_folds, total_folds, selection_frequency_pct."""
    freq = selected_features(fold_ig, top_k).groupBy("feature").agg(F.count(F.lit(1)).alias("selected_in_folds"))
    w = Window.orderBy(F.col("selected_in_folds").desc(), F.col("feature").asc())
    # one row per feature: the window runs over at most m rows
    return freq.select(
        F.row_number().over(w).alias("rank"),
        "feature",
        "selected_in_folds",
        F.lit(total_folds).cast("long").alias("total_folds"),
        (F.col("selected_in_folds") / F.lit(total_folds) * 100.0).alias("selection_frequency_pct"),
    )


def final_feature_set(frequency: DataFrame, top_k: int | None) -> DataFrame:
    """I-7: the first k rows of the frequency table (every feature for ``None``)."""
    sel = frequency.select("rank", "feature")
    return sel if top_k is None else sel.where(F.col("rank") <= F.lit(int(top_k)))


def fold_selection_table(
    fold_ig: DataFrame,
    folded: DataFrame,
    top_k: int | None,
    fold_col: str = "fold",
    feature_order: Sequence[str] | None = None,
) -> DataFrame:
    """I-9: fold, train_samples, test_samples, selected_feature_count, selected_features.

    Top-k selections list features in rank order; ``all`` lists them in column order
    (``feature_order``) when given.
    """
    sizes = folded.groupBy(F.col(fold_col).alias("fold")).agg(F.count(F.lit(1)).alias("test_samples"))
    total = F.sum("test_samples").over(Window.partitionBy(F.lit(1)))
    sizes = sizes.select("fold", (total - F.col("test_samples")).alias("train_samples"), "test_samples")
    chosen = selected_features(fold_ig, top_k)
    if top_k is None and feature_order:
        position = F.create_map(*[x for i, f in enumerate(feature_order) for x in (F.lit(f), F.lit(i + 1))])
        chosen = chosen.withColumn("rank", F.element_at(position, F.col("feature")))
    sel = chosen.groupBy("fold").agg(
        F.count(F.lit(1)).alias("selected_feature_count"),
        F.array_join(
            F.transform(F.array_sort(F.collect_list(F.struct("rank", "feature"))), lambda s: s["feature"]), ", "
        ).alias("selected_features"),
    )
    return sizes.join(sel, "fold").select(
        "fold", "train_samples", "test_samples", "selected_feature_count", "selected_features"
    )


def discretize_for_ig(
    modeling: DataFrame, features: Sequence[str], max_bin: int = 256, only: Sequence[str] | None = None
) -> DataFrame:
    """Optional: replace continuous features by quantile-bin ids before IG.

    Exact IG groups by every distinct value, so a continuous column contributes one
    cell per distinct value and fold. With this step a column holds at most
    ``max_bin`` cells; IG is then the gain of the binned feature. Columns with at
    most ``max_bin`` distinct values are unchanged in effect (one bin per value).
    """
    from cvforge.operators.boost import bin_features

    cols = list(only) if only is not None else list(features)
    binned = bin_features(modeling.select("row_id", *[col(c) for c in cols], F.lit(0).alias("_y"), F.lit(0).alias("_f")),
                          cols, "_y", max_bin=max_bin, fold_col="_f")
    ids = binned.df.select("row_id", *[F.element_at("b", i + 1).cast("double").alias(c) for i, c in enumerate(cols)])
    return modeling.drop(*cols).join(ids, "row_id")
