"""Registered queries: one Spark plan per operator, each paired with its DuckDB oracle.

Every query reads the driver's tables under ``sf_dir`` (whole tables, no row caps)
and returns a DataFrame whose doubles are rounded to ``DIGITS`` places so the
Spark result and the SQL oracle can be compared value by value.
"""

from __future__ import annotations

import uuid
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cvforge.functions.columns import strip_text
from cvforge.plans import oracle as O
from cvforge.plans.datasets import BINDINGS
from cvforge.plans.prepare import Prepared, prepare
from cvforge.session import write_shared

DIGITS = O.DIGITS
QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return deco


def round_doubles(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    return df.select(
        *[
            F.round(F.col(f"`{f.name}`"), digits).alias(f.name)
            if isinstance(f.dataType, (T.DoubleType, T.FloatType))
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


_PREPARED: dict[tuple, Prepared] = {}


def prepared(spark: SparkSession, sf_dir: str, name: str, k: int = 10) -> Prepared:
    """Prepare (clean, encode, fold) a binding once per session and input folder."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), name, k)
    if key not in _PREPARED:
        _PREPARED[key] = prepare(BINDINGS[name](spark, sf_dir), k=k, materialize=True)
    return _PREPARED[key]


def whole(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table as given, all columns: what the audits read."""
    from cvforge.plans.datasets import read

    return read(spark, sf_dir, name)


# ---- K: folds --------------------------------------------------------------------

for _name in ("lineitem", "documents", "orders", "events"):
    _b = O.SQL_BINDINGS[_name]()

    def _folds(spark, sf_dir, _name=_name):
        p = prepared(spark, sf_dir, _name)
        return p.folded.select(*p.encoded.key_cols, "row_id", "fold")

    register(
        f"folds_{_name}",
        f"WITH {O.ctes(_b)} SELECT {', '.join(O.q(k) for k in _b.keys)}, row_id, fold FROM folded",
    )(_folds)

    def _encoded(spark, sf_dir, _name=_name):
        p = prepared(spark, sf_dir, _name)
        return p.encoded.df

    register(
        f"encoded_{_name}",
        f"WITH {O.ctes(_b)} SELECT "
        + ", ".join(
            [O.q(k) for k in _b.keys]
            + [O.q(n) for n in _b.feature_names]
            + [O.q(_b.target)]
        )
        + " FROM enc",
    )(_encoded)

    def _ig(spark, sf_dir, _name=_name):
        from cvforge.operators.infogain import information_gain

        p = prepared(spark, sf_dir, _name)
        return round_doubles(
            information_gain(p.folded, p.features, p.target, p.n_classes, roles=p.roles(), nullable=p.nullable)
        )

    register(f"ig_rank_{_name}", O.ig_sql(_b, None))(_ig)

    def _fold_ig(spark, sf_dir, _name=_name):
        from cvforge.operators.infogain import fold_information_gain

        p = prepared(spark, sf_dir, _name)
        return round_doubles(
            fold_information_gain(
                p.folded, p.features, p.target, p.n_classes, p.k, roles=p.roles(), nullable=p.nullable
            )
        )

    register(f"fold_ig_{_name}", O.ig_sql(_b, 10))(_fold_ig)


# ---- Q / E / X: audit, roles, exploration ------------------------------------------


def _clean_raw(p: Prepared) -> DataFrame:
    return p.clean


for _name in ("lineitem", "documents", "orders", "events"):
    _b = O.SQL_BINDINGS[_name]()

    _w = O.WHOLE[_name]

    def _raw_audit(spark, sf_dir, _name=_name):
        from cvforge.operators.audit import raw_audit

        return raw_audit(whole(spark, sf_dir, _name), O.WHOLE[_name].target)

    register(f"raw_audit_{_name}", O.raw_audit_sql(_w))(_raw_audit)

    def _profile(spark, sf_dir, _name=_name):
        from cvforge.operators.audit import column_profile

        return column_profile(whole(spark, sf_dir, _name))

    register(f"column_profile_{_name}", O.profile_sql(_w, "raw"))(_profile)

    def _clean_profile(spark, sf_dir, _name=_name):
        from cvforge.operators.audit import column_profile

        return column_profile(prepared(spark, sf_dir, _name).clean)

    register(f"clean_profile_{_name}", O.profile_sql(_b, "clean"))(_clean_profile)

    def _stats(spark, sf_dir, _name=_name):
        from cvforge.operators.audit import cleaning_stats

        return cleaning_stats(whole(spark, sf_dir, _name))

    register(f"cleaning_stats_{_name}", O.cleaning_stats_sql(_w))(_stats)

    def _summary(spark, sf_dir, _name=_name):
        from cvforge.operators.audit import cleaning_stats, preprocessing_summary

        return preprocessing_summary(cleaning_stats(whole(spark, sf_dir, _name)))

    register(f"preprocessing_summary_{_name}", O.preprocessing_summary_sql(_w))(_summary)

    def _clean_rows(spark, sf_dir, _name=_name):
        return prepared(spark, sf_dir, _name).clean

    register(
        f"clean_rows_{_name}", f"WITH {O.ctes(_b)} SELECT * FROM clean"
    )(_clean_rows)

    def _quality(spark, sf_dir, _name=_name):
        from cvforge.operators.audit import quality_check

        p = prepared(spark, sf_dir, _name)
        return quality_check(p.clean, p.encoded.df, p.target)

    register(f"quality_check_{_name}", O.quality_check_sql(_b))(_quality)

    def _roles(spark, sf_dir, _name=_name):
        from cvforge.operators.encode import feature_role_table

        p = prepared(spark, sf_dir, _name)
        return feature_role_table(p.clean, p.binding.spec, [c for c, _ in O.SQL_BINDINGS[_name]().source_roles])

    register(f"feature_roles_{_name}", O.feature_roles_sql(_b))(_roles)

    def _enc_roles(spark, sf_dir, _name=_name):
        from cvforge.operators.encode import encoded_role_table

        p = prepared(spark, sf_dir, _name)
        return encoded_role_table(p.clean, p.binding.spec, [c for c, _ in O.SQL_BINDINGS[_name]().source_roles])

    register(f"encoded_roles_{_name}", O.encoded_roles_sql(_b))(_enc_roles)

    def _labels(spark, sf_dir, _name=_name):
        from cvforge.operators.encode import label_mapping_table

        p = prepared(spark, sf_dir, _name)
        return label_mapping_table(p.clean, p.target)

    register(f"label_mapping_{_name}", O.label_mapping_sql(_b))(_labels)

    def _target_dist(spark, sf_dir, _name=_name):
        from cvforge.operators.audit import target_distribution

        p = prepared(spark, sf_dir, _name)
        return round_doubles(target_distribution(p.clean, p.target))

    register(f"target_distribution_{_name}", O.target_distribution_sql(_b))(_target_dist)

    def _num_summary(spark, sf_dir, _name=_name):
        from cvforge.operators.audit import numeric_summary

        p = prepared(spark, sf_dir, _name)
        return round_doubles(numeric_summary(p.clean, O.SQL_BINDINGS[_name]().numeric_sources), 4)

    register(
        f"numeric_summary_{_name}", O.numeric_summary_sql(_b, _b.numeric_sources, "clean", 4)
    )(_num_summary)

    def _enc_summary(spark, sf_dir, _name=_name):
        from cvforge.operators.audit import numeric_summary

        p = prepared(spark, sf_dir, _name)
        return round_doubles(numeric_summary(p.encoded.df, p.features), 4)

    register(
        f"encoded_summary_{_name}", O.numeric_summary_sql(_b, _b.feature_names, "enc", 4)
    )(_enc_summary)

    def _cat_summary(spark, sf_dir, _name=_name):
        from cvforge.operators.audit import categorical_summary

        p = prepared(spark, sf_dir, _name)
        return categorical_summary(p.clean, O.SQL_BINDINGS[_name]().categorical_sources)

    if _b.categorical_sources:
        register(
            f"categorical_summary_{_name}", O.categorical_summary_sql(_b, _b.categorical_sources)
        )(_cat_summary)

    def _fold_sizes(spark, sf_dir, _name=_name):
        from cvforge.operators.split import fold_sizes

        return fold_sizes(prepared(spark, sf_dir, _name).folded)

    register(f"fold_sizes_{_name}", O.fold_sizes_sql(_b))(_fold_sizes)

    def _fold_classes(spark, sf_dir, _name=_name):
        from cvforge.operators.audit import fold_class_distribution

        p = prepared(spark, sf_dir, _name)
        return round_doubles(fold_class_distribution(p.folded, p.encoded.target.label(F.col(p.target))))

    register(f"fold_class_distribution_{_name}", O.fold_class_sql(_b))(_fold_classes)


# Duplicates, gaps and padded text, made of lineitem: the branches that the given tables do not reach.


def gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whole(spark, sf_dir, "lineitem").selectExpr(
        "l_linenumber AS line",
        "nullif(l_quantity, 7) AS quantity",
        "CASE WHEN l_suppkey % 3 = 0 THEN concat('  ', l_linestatus, chr(9)) ELSE l_linestatus END AS status",
        "CASE WHEN l_partkey % 11 > 0 THEN concat(' ', cast(l_partkey % 5 AS string), ' ') END AS part",
        "l_returnflag AS returned",
    )


_GAPS = O.GAPS


def _gaps_encoded(spark, sf_dir):
    from cvforge.operators.audit import clean_dataset
    from cvforge.operators.encode import encode_features
    from cvforge.spec import FeatureSpec

    spec = FeatureSpec(target="returned", numeric=("line", "quantity", "part"), binary={"status": {"F": 0, "O": 1}})
    return encode_features(clean_dataset(gaps(spark, sf_dir)), spec).df


def _gaps_audit(fn):
    def run(spark, sf_dir):
        from cvforge.operators import audit

        return fn(audit, gaps(spark, sf_dir))

    return run


register("raw_audit_gaps", O.raw_audit_sql(_GAPS))(_gaps_audit(lambda a, df: a.raw_audit(df, "returned")))
register("column_profile_gaps", O.profile_sql(_GAPS, "raw"))(_gaps_audit(lambda a, df: a.column_profile(df)))
register("cleaning_stats_gaps", O.cleaning_stats_sql(_GAPS))(_gaps_audit(lambda a, df: a.cleaning_stats(df)))
register("preprocessing_summary_gaps", O.preprocessing_summary_sql(_GAPS))(_gaps_audit(lambda a, df: a.preprocessing_summary(a.cleaning_stats(df))))
register("clean_rows_gaps", f"WITH {O.clean_cte(_GAPS)} SELECT * FROM clean")(_gaps_audit(lambda a, df: a.clean_dataset(df)))
register("encoded_gaps", O.GAPS_ENCODED)(_gaps_encoded)


# ---- I-4, E-14: gaps filled from each fold's training rows; a thousand classes ------------


def gaps_folded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whole(spark, sf_dir, "lineitem").selectExpr(
        "cast(l_orderkey % 10 + 1 AS int) AS fold",
        "CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END AS y",
        "l_linenumber AS line",
        "nullif(l_quantity, 7) AS quantity",
        "CASE WHEN l_suppkey % 3 > 0 THEN l_linestatus END AS status",
        "CASE WHEN l_partkey % 11 > 0 THEN concat('p', l_partkey % 5) END AS part",
    )


def _fold_ig_gaps(spark, sf_dir):
    from cvforge.operators.infogain import fold_information_gain

    return round_doubles(fold_information_gain(gaps_folded(spark, sf_dir), ["line", "quantity", "status", "part"], "y", 3, 10, nullable=["quantity"]))


def _fold_ig_parts(spark, sf_dir):
    from cvforge.operators.infogain import fold_information_gain

    rows = whole(spark, sf_dir, "lineitem").selectExpr(
        "cast(l_orderkey % 10 + 1 AS int) AS fold", "cast(l_partkey % 1000 AS int) AS y",
        "l_quantity AS quantity", "l_discount AS discount", "l_returnflag AS flag", "l_linenumber AS line",
    )
    return round_doubles(fold_information_gain(rows, ["quantity", "discount", "flag", "line"], "y", 1000, 10))


register("fold_ig_gaps", O.class_rows_ig_sql(O.IG_GAPS, ["line", "quantity"], ["status", "part"], 10))(_fold_ig_gaps)
register("fold_ig_thousand_classes", O.class_rows_ig_sql(O.IG_PARTS, ["quantity", "discount", "line"], ["flag"], 10))(_fold_ig_parts)


# ---- I-5 .. I-9: fold-local selection ------------------------------------------------

SELECTION_TOP_K = {"lineitem": 3, "documents": 10, "orders": 1, "events": 1}

for _name, _k in SELECTION_TOP_K.items():
    _b = O.SQL_BINDINGS[_name]()

    def _fold_ig(spark, sf_dir, _name=_name):
        from cvforge.operators.infogain import fold_information_gain

        p = prepared(spark, sf_dir, _name)
        return fold_information_gain(p.folded, p.features, p.target, p.n_classes, p.k, roles=p.roles(), nullable=p.nullable)

    def _sel(spark, sf_dir, _name=_name, _k=_k, _fold_ig=_fold_ig):
        from cvforge.operators.infogain import selected_features

        return selected_features(_fold_ig(spark, sf_dir), _k)

    register(f"selected_features_{_name}", O.selected_sql(_b, _k))(_sel)

    def _freq(spark, sf_dir, _name=_name, _k=_k, _fold_ig=_fold_ig):
        from cvforge.operators.infogain import selection_frequency

        return round_doubles(selection_frequency(_fold_ig(spark, sf_dir), _k, 10))

    register(f"selection_frequency_{_name}", O.frequency_sql(_b, _k))(_freq)

    def _final(spark, sf_dir, _name=_name, _k=_k, _fold_ig=_fold_ig):
        from cvforge.operators.infogain import final_feature_set, selection_frequency

        return final_feature_set(selection_frequency(_fold_ig(spark, sf_dir), _k, 10), _k)

    register(f"final_features_{_name}", O.final_features_sql(_b, _k))(_final)

    def _fold_sel(spark, sf_dir, _name=_name, _k=_k, _fold_ig=_fold_ig):
        from cvforge.operators.infogain import fold_selection_table

        return fold_selection_table(_fold_ig(spark, sf_dir), prepared(spark, sf_dir, _name).folded, _k)

    register(f"fold_selection_{_name}", O.fold_selection_sql(_b, _k))(_fold_sel)


# ---- M: metrics on fixed, data-derived scores ----------------------------------------


def scored(spark: SparkSession, sf_dir: str, name: str) -> tuple[Prepared, DataFrame]:
    """The folded table with a fixed score expression (no model) and its argmax class."""
    p = prepared(spark, sf_dir, name)
    f = p.folded
    if name == "lineitem":
        score = F.least(F.greatest(F.col("l_discount") * 5.0 + F.col("l_tax") * 5.0, F.lit(0.0)), F.lit(1.0))
    elif name == "documents":
        score = F.col("n_chars") / (F.col("n_chars") + 1000.0)
    elif name == "events":
        score = F.col("value") / (F.col("value") + 50.0)
    else:
        score = None
    if score is not None:
        out = f.select("fold", F.col(p.target).alias("y"), score.alias("score"), (score > 0.5).cast("int").alias("pred"))
    else:
        out = f.select("fold", F.col(p.target).alias("y"), F.pmod(F.col("o_orderkey"), F.lit(3)).cast("int").alias("pred"))
    return p, out


for _name in ("lineitem", "documents", "orders", "events"):
    _b = O.SQL_BINDINGS[_name]()
    _has_score = O.SCORES[_name][0] is not None

    def _fold_metrics(spark, sf_dir, _name=_name, _has_score=_has_score):
        from cvforge.operators.metrics import fold_metric_table

        p, df = scored(spark, sf_dir, _name)
        t = p.encoded.target
        return round_doubles(
            fold_metric_table(df, p.n_classes, t.positive_label, score="score" if _has_score else None)
        )

    register(f"fold_metrics_{_name}", O.fold_metrics_sql(_name, _b))(_fold_metrics)

    def _pooled(spark, sf_dir, _name=_name, _has_score=_has_score):
        from cvforge.operators.metrics import classification_scores

        p, df = scored(spark, sf_dir, _name)
        t = p.encoded.target
        return round_doubles(
            classification_scores(df, [], p.n_classes, t.positive_label, score="score" if _has_score else None)
        )

    register(f"pooled_metrics_{_name}", O.pooled_metrics_sql(_name, _b))(_pooled)

    def _summary_m(spark, sf_dir, _name=_name, _has_score=_has_score):
        from cvforge.operators.metrics import fold_metric_table, fold_summary

        p, df = scored(spark, sf_dir, _name)
        t = p.encoded.target
        fm = fold_metric_table(df, p.n_classes, t.positive_label, score="score" if _has_score else None)
        return round_doubles(fold_summary(fm))

    register(f"fold_summary_{_name}", O.fold_summary_sql(_name, _b))(_summary_m)

    def _cm(spark, sf_dir, _name=_name):
        from cvforge.operators.metrics import confusion_matrix

        p, df = scored(spark, sf_dir, _name)
        return confusion_matrix(df, p.encoded.target.classes)

    register(f"confusion_matrix_{_name}", O.confusion_sql(_name, _b))(_cm)


# ---- B: first boosting round (SQL-checkable) ---------------------------------------------


def _first_split(spark, sf_dir, name):
    from cvforge.operators.boost import ModelSpec, bin_features, train
    from cvforge.spec import BoostParams

    p = prepared(spark, sf_dir, name)
    binned = bin_features(p.folded, p.features, p.target, max_bin=None)
    params = BoostParams(n_estimators=1, max_depth=1, learning_rate=0.3)
    models = [ModelSpec(f, f, tuple(range(len(p.features))), params) for f in range(1, p.k + 1)]
    res = train(binned, models, p.n_classes)
    # gain/GL/HL of the chosen split come from the split table; recompute GL/HL of the root split
    root = res.trees.where((F.col("round") == 1) & (F.col("node") == 0) & ~F.col("is_leaf"))
    # one row for each model: the sums of all of them in one pass
    left = [(r["model_id"], (F.col("fold") != r["model_id"]) & (F.element_at("b", r["fi"] + 1) <= r["bin"])) for r in root.collect()]
    aggs = [a for m, on in left for a in (F.sum(F.when(on, 0.5 - F.col("y"))).alias(f"g{m}"), (F.count_if(on) * 0.25).alias(f"h{m}"))]
    sums = binned.df.agg(*aggs).select(F.explode(F.array(*[F.struct(F.lit(m).alias("model_id"), F.col(f"g{m}").alias("grad_left"), F.col(f"h{m}").alias("hess_left")) for m, _ in left])).alias("s")) if left else None
    stats = sums.select("s.*") if left else spark.createDataFrame([], "model_id int, grad_left double, hess_left double")
    out = root.join(stats, "model_id").select(
        F.col("model_id").alias("fold"), "feature", "threshold", "gain", "grad_left", "hess_left"
    )
    return round_doubles(out.select("fold", "feature", "threshold", F.round("gain", 8).alias("gain"),
                                    F.round("grad_left", 8).alias("grad_left"), F.round("hess_left", 8).alias("hess_left")))


for _name in ("lineitem", "documents", "events"):
    register(f"first_split_{_name}", O.first_split_sql(O.SQL_BINDINGS[_name]()))(
        lambda spark, sf_dir, _name=_name: _first_split(spark, sf_dir, _name)
    )


# ---- G: screening, grid search, comparison, out-of-fold results (rows-only) --------------
# Iterative training has no SQL form; these run the whole workflow on the documents
# binding (every labelled document) with a small grid, and the driver checks rows.

WORKFLOW_DATASET = "documents"


def _workflow_config():
    from cvforge.spec import BoostParams, GridSpec

    grid = GridSpec(
        top_k=(None, 5, 10),
        learning_rates=(0.1, 0.3),
        max_depths=(2,),
        n_estimators=(2, 3),
        subsamples=(1.0,),
        colsample_bytree=(0.8, 1.0),
    )
    return grid, BoostParams(n_estimators=3, max_depth=2)


_WORKFLOWS: dict[tuple, object] = {}


def workflow(spark: SparkSession, sf_dir: str):
    from cvforge.plans.workflow import run_workflow

    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    if key not in _WORKFLOWS:
        grid, base = _workflow_config()
        _WORKFLOWS[key] = run_workflow(prepared(spark, sf_dir, WORKFLOW_DATASET), grid, base=base)
    return _WORKFLOWS[key]


_WORKFLOW_TABLES = {
    "default_screen": "defaults",
    "screened_feature_count": "screened",
    "grid_results": "grid",
    "best_by_feature_count": "best_by_count",
    "default_vs_grid": "comparison",
    "main_summary": "main_summary",
    "supporting_summary": "supporting_summary",
    "final_main_ranking": "final_main",
    "final_supporting_ranking": "final_supporting",
    "oof_predictions": "predictions",
    "oof_fold_metrics": "fold_metrics",
    "oof_fold_selection": "fold_selection",
    "oof_selection_frequency": "selection_frequency",
    "oof_pooled_scores": "oof_scores",
}

for _q, _attr in _WORKFLOW_TABLES.items():
    register(f"{_q}_{WORKFLOW_DATASET}")(
        lambda spark, sf_dir, _attr=_attr: getattr(workflow(spark, sf_dir), _attr)
    )


# ---- B-1..B-8, G-21, G-22: out-of-fold predictions of whole boosting rounds -------------

OOF_ROUNDS, OOF_DEPTH, OOF_RATE = 2, 2, 0.3
_OOF: dict[tuple, object] = {}


def _oof(spark, sf_dir, name):
    """One model a fold with all features, a bin for each distinct value."""
    from cvforge.operators.boost import bin_features
    from cvforge.operators.search import oof_predictions
    from cvforge.spec import BoostParams

    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), name)
    if key not in _OOF:
        p = prepared(spark, sf_dir, name)
        binned = bin_features(p.folded, p.features, p.target, max_bin=None)
        params = {"top_k": None, "learning_rate": OOF_RATE, "max_depth": OOF_DEPTH, "n_estimators": OOF_ROUNDS, "subsample": 1.0, "colsample_bytree": 1.0}
        lists = {f: list(p.features) for f in range(1, p.k + 1)}
        _OOF[key] = (p, write_shared(oof_predictions(binned, lists, params, p.n_classes, BoostParams()), "oof"))
    return _OOF[key]


def _oof_predictions(spark, sf_dir, name):
    from cvforge.operators.report import prediction_table

    p, probs = _oof(spark, sf_dir, name)
    return prediction_table(probs, p.encoded.target.classes)


def _oof_confusion(spark, sf_dir, name):
    _, probs = _oof(spark, sf_dir, name)
    return probs.groupBy("fold", F.col("y").cast("int").alias("actual"), F.col("pred").alias("predicted")).agg(F.count(F.lit(1)).alias("rows"))


def _orders_fold_metrics(spark, sf_dir):
    from cvforge.operators.metrics import fold_metric_table

    p, probs = _oof(spark, sf_dir, "orders")
    return round_doubles(fold_metric_table(probs.select("fold", "y", "pred"), p.n_classes, p.encoded.target.positive_label, score=None))


for _name, _classes in (("orders", ["F", "O", "P"]), ("lineitem", ["No", "Yes"])):
    _b = O.SQL_BINDINGS[_name]()
    register(f"oof_predictions_{_name}", O.oof_predictions_sql(_b, _classes, OOF_ROUNDS, OOF_DEPTH, OOF_RATE))(
        lambda spark, sf_dir, _name=_name: _oof_predictions(spark, sf_dir, _name)
    )
    register(f"oof_confusion_{_name}", O.oof_confusion_sql(_b, len(_classes), OOF_ROUNDS, OOF_DEPTH, OOF_RATE))(
        lambda spark, sf_dir, _name=_name: _oof_confusion(spark, sf_dir, _name)
    )
register("oof_fold_metrics_orders", O.oof_fold_metrics_sql("orders", O.SQL_BINDINGS["orders"](), OOF_ROUNDS, OOF_DEPTH, OOF_RATE))(_orders_fold_metrics)


# ---- B-5: rows drawn for each round -----------------------------------------------------


def _row_draws(spark, sf_dir):
    from cvforge.operators.boost import row_draw

    folded = prepared(spark, sf_dir, "orders").folded
    every = [folded.select(F.lit(r).alias("round"), "row_id", (row_draw(42, r) < 0.8).alias("drawn")) for r in (1, 2, 3)]
    return every[0].unionByName(every[1]).unionByName(every[2])


register("row_draws_orders", O.row_draws_sql(O.SQL_BINDINGS["orders"](), 42, 0.8))(_row_draws)


# ---- B-7: a model of the labelled documents, applied to all documents -------------------


def _predict_unlabelled(spark, sf_dir):
    """Class and probability of every document without a label, by one model of all labelled ones."""
    from cvforge.operators.boost import ModelSpec, bin_features, predict, train
    from cvforge.spec import BoostParams

    p = prepared(spark, sf_dir, "documents")
    binned = bin_features(p.folded, p.features, p.target)
    model = ModelSpec(0, None, tuple(range(len(p.features))), BoostParams(n_estimators=20, max_depth=4))
    trees = train(binned, [model], p.n_classes).trees
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id")
    return predict(trees, encode_unlabelled(docs.join(labels, "doc_id", "left_anti"), p), p.features, [model], p.n_classes, keys=("doc_id",))


def encode_unlabelled(docs: DataFrame, p) -> DataFrame:
    """The encoded features of documents that have no target, as the labelled ones have them."""
    columns = []
    for f in p.features:
        source = next((c for c in ("lang", "source") if f.startswith(f"{c}_")), None)
        one = F.col("n_chars") if source is None else (strip_text(F.col(source)) == F.lit(f[len(source) + 1 :])).cast("int")
        columns.append(one.cast("double").alias(f))
    return docs.select("doc_id", *columns)


register("predict_unlabelled_documents")(_predict_unlabelled)


# ---- B-4: bins of the default tree method, features of at most 256 values ------------


def _hist_bins(spark, sf_dir, name):
    from cvforge.functions.sketch import column_cuts

    p = prepared(spark, sf_dir, name)
    found = column_cuts(p.folded, p.features, 256)
    rows = [(f, i, cut) for f, (cuts, whole_) in zip(p.features, found, strict=True) if whole_ for i, cut in enumerate(cuts)]
    return spark.createDataFrame(rows, "feature string, bin int, threshold double")


for _name in ("lineitem", "documents", "orders", "events"):
    register(f"hist_bins_{_name}", O.hist_bins_sql(O.SQL_BINDINGS[_name](), 256))(lambda s, d, _name=_name: _hist_bins(s, d, _name))


# ---- S-4, S-5: written tables bound to their run; one of them is written anew afterwards ------------


def _sealed_tables(spark, sf_dir):
    from cvforge.functions.fingerprints import dataset_fingerprint
    from cvforge.operators.encode import feature_role_table
    from cvforge.operators.search import configuration_signature
    from cvforge.operators.split import fold_sizes
    from cvforge.session import checkpoint_dir
    from cvforge.sources.tables import seal_tables, verify_tables, write_table

    p = prepared(spark, sf_dir, "lineitem")
    out = f"{checkpoint_dir(spark)}/sealed-{uuid.uuid4().hex}"
    tables = {
        "encoded": p.encoded.df,
        "fold_sizes": fold_sizes(p.folded),
        "roles": feature_role_table(p.clean, p.binding.spec, [c for c, _ in O.SQL_BINDINGS["lineitem"]().source_roles]),
    }
    for name, df in tables.items():
        write_table(df, f"{out}/{name}")
    signature = configuration_signature({"cv_splits": p.k, "target": p.target})
    seal_tables(spark, out, list(tables), signature, dataset_fingerprint(p.binding.raw))
    write_table(tables["fold_sizes"].where("fold > 1"), f"{out}/fold_sizes")
    return verify_tables(spark, out, signature)


_b = O.SQL_BINDINGS["lineitem"]()
register(
    "sealed_tables_lineitem",
    f"WITH {O.ctes(_b)} SELECT 'encoded' AS name, count(*) AS rows, true AS intact FROM enc UNION ALL SELECT 'fold_sizes', count(DISTINCT fold) - 1, false FROM folded "
    f"UNION ALL SELECT 'roles', count(*), true FROM ({O.feature_roles_sql(_b)})",
)(_sealed_tables)


# ---- G: progress, ranking and reports over a progress table made of lineitem ------------

from cvforge.plans import ranking as R  # noqa: E402

for _name, _fn in R.QUERIES.items():
    register(f"{_name}_lineitem", R.SQL[_name])(_fn)

register(
    "prediction_table_lineitem",
    f"WITH {O.ctes(O.SQL_BINDINGS['lineitem']())}, s AS (SELECT *, {O.SCORES['lineitem'][0]} AS score FROM folded) "
    "SELECT row_id AS source_row_index, fold, CASE returned WHEN 0 THEN 'No' ELSE 'Yes' END AS actual_label, "
    "CASE WHEN score > 0.5 THEN 'Yes' ELSE 'No' END AS predicted_label, (score > 0.5) = (returned = 1) AS is_correct, "
    'round(1 - score, 4) AS "probability_No", round(score, 4) AS "probability_Yes" FROM s',
)(R.predictions)
