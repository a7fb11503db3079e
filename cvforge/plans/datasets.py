"""Bindings of the workflow to the driver's tables.

Each binding returns the raw modeling input (keys, features, target text) and
the ``FeatureSpec`` declaring the role of every column.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cvforge.spec import FeatureSpec

LINEITEM_KEYS = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")


@dataclass
class Binding:
    name: str
    raw: DataFrame
    spec: FeatureSpec


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def lineitem_returns(spark: SparkSession, sf_dir: str) -> Binding:
    """D2: is a line returned (``l_returnflag = 'R'``)? Binary line status and four numeric columns."""
    li = read(spark, sf_dir, "lineitem")
    raw = li.select(
        *LINEITEM_KEYS,
        "l_linestatus",
        "l_quantity",
        "l_extendedprice",
        "l_discount",
        "l_tax",
        F.when(F.col("l_returnflag") == "R", F.lit("Yes")).otherwise(F.lit("No")).alias("returned"),
    )
    spec = FeatureSpec(
        target="returned",
        positive_class="Yes",
        numeric=("l_quantity", "l_extendedprice", "l_discount", "l_tax"),
        binary={"l_linestatus": {"F": 0, "O": 1}},
        exclude=LINEITEM_KEYS,
        key_cols=LINEITEM_KEYS,
    )
    return Binding("lineitem", raw, spec)


def document_quality(spark: SparkSession, sf_dir: str) -> Binding:
    """D1: ``labels`` joined to ``documents``; target quality (0/1), nominal lang/source, numeric length."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    labels = read(spark, sf_dir, "labels").select("doc_id", F.col("quality").cast("string").alias("quality"))
    raw = docs.join(labels, "doc_id").select("doc_id", "lang", "source", "n_chars", "quality")
    spec = FeatureSpec(
        target="quality",
        positive_class="1",
        numeric=("n_chars",),
        nominal={"lang": ("de", "en", "es", "fr"), "source": None},
        exclude=("doc_id",),
        key_cols=("doc_id",),
    )
    return Binding("documents", raw, spec)


def order_status(spark: SparkSession, sf_dir: str) -> Binding:
    """D3: three-class order status; ordinal priority, numeric total price."""
    orders = read(spark, sf_dir, "orders")
    raw = orders.select("o_orderkey", "o_orderpriority", "o_totalprice", "o_orderstatus")
    spec = FeatureSpec(
        target="o_orderstatus",
        positive_class=None,
        numeric=("o_totalprice",),
        ordinal={
            "o_orderpriority": {
                "1-URGENT": 0,
                "2-HIGH": 1,
                "3-MEDIUM": 2,
                "4-NOT SPECIFIED": 3,
                "5-LOW": 4,
            }
        },
        exclude=("o_orderkey",),
        key_cols=("o_orderkey",),
    )
    return Binding("orders", raw, spec)


def event_purchases(spark: SparkSession, sf_dir: str) -> Binding:
    """D4: purchase vs other events; numeric value and hour of day."""
    ev = read(spark, sf_dir, "events")
    raw = ev.select(
        "event_id",
        "value",
        F.hour("ts").alias("hour"),
        F.when(F.col("event_type") == "purchase", F.lit("Yes")).otherwise(F.lit("No")).alias("purchased"),
    )
    spec = FeatureSpec(
        target="purchased",
        positive_class="Yes",
        numeric=("value", "hour"),
        exclude=("event_id",),
        key_cols=("event_id",),
    )
    return Binding("events", raw, spec)


BINDINGS = {
    "lineitem": lineitem_returns,
    "documents": document_quality,
    "orders": order_status,
    "events": event_purchases,
}
