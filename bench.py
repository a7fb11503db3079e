"""Benchmark: headline operators at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from cvforge.session import build_session  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))


def _sf(path: str) -> float | str:
    base = os.path.basename(path.rstrip("/"))
    try:
        return float(base.replace("sf", ""))
    except ValueError:
        return base


def main() -> None:
    spark = build_session(master=f"local[{CPUS}]", shuffle_partitions=CPUS * 2, app="cvforge-bench")
    spark.sparkContext.setLogLevel("ERROR")
    from cvforge.operators.audit import cleaning_stats, raw_audit
    from cvforge.operators.boost import ModelSpec, bin_features, train
    from cvforge.operators.infogain import fold_information_gain
    from cvforge.operators.metrics import fold_metric_table
    from cvforge.plans.datasets import lineitem_returns
    from cvforge.plans.prepare import prepare
    from cvforge.spec import BoostParams

    times: dict[str, float] = {}

    def timed(name, fn):
        t = time.time()
        out = fn()
        times[name] = round(time.time() - t, 3)
        return out

    b = lineitem_returns(spark, SF_DIR)
    timed("audit_lineitem", lambda: raw_audit(b.raw, b.spec.target).collect())
    timed("cleaning_stats_lineitem", lambda: cleaning_stats(b.raw).collect())
    p = timed("prepare_encode_folds_lineitem", lambda: prepare(b, k=10, materialize=True))
    timed(
        "fold_ig_lineitem",
        lambda: fold_information_gain(
            p.folded, p.features, p.target, p.n_classes, 10, roles=p.roles(), nullable=p.nullable
        ).collect(),
    )
    score = F.least(F.greatest(F.col("l_discount") * 5.0 + F.col("l_tax") * 5.0, F.lit(0.0)), F.lit(1.0))
    scored = p.folded.select("fold", F.col(p.target).alias("y"), score.alias("score"), (score > 0.5).cast("int").alias("pred"))
    timed("fold_metrics_lineitem", lambda: fold_metric_table(scored, 2, 1).collect())
    binned = timed("bin_hist_lineitem", lambda: bin_features(p.folded, p.features, p.target, max_bin=256))
    binned.df.persist()
    binned.df.count()
    params = BoostParams(n_estimators=2, max_depth=3)
    for n_models in (1, 10, 100):
        models = [ModelSpec(i, (i % 10) + 1, tuple(range(len(p.features))), params) for i in range(n_models)]
        t = time.time()
        train(binned, models, p.n_classes)
        times[f"boost_round_{n_models}_models"] = round((time.time() - t) / params.n_estimators, 3)
    binned.df.unpersist()

    # end to end: default screen, 24-combination grid x 10 folds, four-setup comparison, OOF
    from cvforge.plans.datasets import document_quality
    from cvforge.plans.workflow import run_workflow
    from cvforge.spec import GridSpec

    grid = GridSpec(
        top_k=(None, 5, 10), learning_rates=(0.1, 0.3), max_depths=(2,), n_estimators=(2, 3),
        subsamples=(1.0,), colsample_bytree=(0.8, 1.0),
    )
    docs = prepare(document_quality(spark, SF_DIR), k=10, materialize=True)
    timed(
        "workflow_documents_grid24",
        lambda: run_workflow(docs, grid, base=BoostParams(n_estimators=3, max_depth=2)).predictions.count(),
    )
    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "total_seconds", "value": total, "unit": "sec", "queries": times, "sf": _sf(SF_DIR)}))
    spark.stop()


if __name__ == "__main__":
    main()
