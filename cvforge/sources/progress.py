"""Grid progress: an append-only Parquet table with a commit log (S-2, S-3).

    <path>/batches/signature=../batch=../   the rows of one batch, in a folder of its own
    <path>/log/signature=../batch=../       one row once the batch is whole: its first number and size

Every folder has one writer, so writers do not meet in a committer's temporary files. A log
entry is one file that its write's commit moves into place, so a batch is seen as a whole or
not at all; a batch without an entry, of a writer that was killed, is never read.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cvforge.spec import REPORT_METRICS

PROGRESS_SCHEMA = (
    "top_k int, learning_rate double, max_depth int, n_estimators int, subsample double, colsample_bytree double, "
    + ", ".join(f"mean_cv_{m} double, std_cv_{m} double" for m in REPORT_METRICS)
    + ", status string, seq long, signature string"
)


PLACES = 20  # bits of a row's place in its batch; as many tell writers apart, above them counts the caller
LOG_SCHEMA = "first_seq long, rows long, signature string, batch string"
BATCH_SCHEMA = PROGRESS_SCHEMA.replace("seq long", "place long") + ", batch string"


def _stored(spark: SparkSession, path: str, schema: str, signature: str | None) -> DataFrame:
    try:
        df = spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        df = spark.createDataFrame([], schema)
    return df if signature is None else df.where(F.col("signature") == signature)


def read_progress(spark: SparkSession, path: str, signature: str | None = None) -> DataFrame:
    """S-2: rows of committed batches (empty when nothing was written); only ``signature``'s folders when given.

    ValueError if a committed batch does not hold as many rows as its log entry tells.
    """
    log = _stored(spark, f"{path}/log", LOG_SCHEMA, signature)
    staged = _stored(spark, f"{path}/batches", BATCH_SCHEMA, signature)
    held = staged.groupBy("signature", "batch").agg(F.count("*").alias("held"))
    lost = log.join(held, ["signature", "batch"], "left").where(F.coalesce("held", F.lit(0)) != F.col("rows")).first()
    if lost:
        raise ValueError(f"progress at {path}: batch {lost.batch} should have {lost.rows} rows, found {lost.held or 0}")
    rows = staged.join(log.drop("rows"), ["signature", "batch"]).withColumn("seq", F.col("first_seq") + F.col("place"))
    return rows.select(*[c.split()[0] for c in PROGRESS_SCHEMA.split(", ")])


def stage_batch(rows: DataFrame, path: str, signature: str) -> str:
    """Write one batch of completed combinations (one small file) where readers do not see it yet; its name."""
    batch = uuid.uuid4().hex
    cols = [c.split()[0] for c in BATCH_SCHEMA.split(", ")][:-2]
    numbered = rows.coalesce(1).withColumn("place", F.monotonically_increasing_id())
    numbered.select(*cols).write.parquet(f"{path}/batches/signature={signature}/batch={batch}")
    return batch


def commit_batch(spark: SparkSession, path: str, signature: str, batch: str, first_seq: int) -> None:
    """Make a staged batch visible. Writers that pass the same ``first_seq`` (a multiple of 2^40) still get numbers of their own."""
    schema = ", ".join(c for c in BATCH_SCHEMA.split(", ")[:-2])
    size = spark.read.schema(schema).parquet(f"{path}/batches/signature={signature}/batch={batch}").count()
    own = first_seq + ((int(batch, 16) % (1 << PLACES)) << PLACES)
    entry = spark.createDataFrame([(own, size)], "first_seq long, rows long")
    entry.coalesce(1).write.parquet(f"{path}/log/signature={signature}/batch={batch}")


def append_progress(rows: DataFrame, path: str, signature: str, first_seq: int) -> None:
    """S-3: stage one batch and commit it."""
    commit_batch(rows.sparkSession, path, signature, stage_batch(rows, path, signature), first_seq)
