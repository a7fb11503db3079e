"""Print the executed (AQE final) plan shape of headline operators: python tools_plans.py [sf_dir]"""
import re
import sys

sys.path.insert(0, "/root/repo")
from pyspark.sql import functions as F  # noqa: E402

from cvforge.operators.audit import cleaning_stats, numeric_summary, raw_audit  # noqa: E402
from cvforge.operators.boost import bin_features  # noqa: E402
from cvforge.operators.infogain import fold_information_gain  # noqa: E402
from cvforge.operators.metrics import fold_metric_table  # noqa: E402
from cvforge.plans.datasets import lineitem_returns  # noqa: E402
from cvforge.plans.prepare import prepare  # noqa: E402
from cvforge.session import build_session  # noqa: E402

sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
spark = build_session(shuffle_partitions=16)
spark.sparkContext.setLogLevel("ERROR")


def shape(name, df):
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    final = plan.split("+- == Initial Plan ==")[0]
    ex = len(re.findall(r"Exchange (hashpartitioning|rangepartitioning|SinglePartition|RoundRobin)", final))
    single = final.count("Exchange SinglePartition")
    bc = final.count("BroadcastExchange")
    reused = final.count("ReusedExchange")
    partial = len(re.findall(r"functions=\[partial_", final))
    scans = re.findall(r"FileScan parquet \S*\[([^\]]*)\].*?(PushedFilters: \[[^\]]*\])", final)
    cols = "; ".join(f"[{c}] {p}" for c, p in scans) or "(reads checkpointed data)"
    print(f"| {name} | {ex} | {single} | {bc} | {reused} | {partial} | {cols} |")


b = lineitem_returns(spark, sf)
print("| Operator | Shuffles | to one partition | Broadcasts | Reused | Partial aggs | Scan columns / pushed filters |")
print("| --- | --- | --- | --- | --- | --- | --- |")
shape("Q-1 raw audit", raw_audit(b.raw, b.spec.target))
shape("Q-5 cleaning stats", cleaning_stats(b.raw))
p = prepare(b, k=10, materialize=True)
shape("X-2 numeric summary (exact quartiles)", numeric_summary(p.clean, ["l_quantity", "l_extendedprice"]))
shape("I-4 fold IG (10 folds)", fold_information_gain(p.folded, p.features, p.target, p.n_classes, 10, roles=p.roles()))
score = F.least(F.greatest(F.col("l_discount") * 5.0 + F.col("l_tax") * 5.0, F.lit(0.0)), F.lit(1.0))
scored = p.folded.select("fold", F.col(p.target).alias("y"), score.alias("score"), (score > 0.5).cast("int").alias("pred"))
shape("M-14 fold metrics incl. AUC/AP", fold_metric_table(scored, 2, 1))
bn = bin_features(p.folded, p.features, p.target, max_bin=256)
shape("B-4 histogram binning", bn.df)
