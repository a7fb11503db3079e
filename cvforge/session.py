"""Session helpers: building a local session for tests/bench and resolving the
shared checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(master: str = "local[8]", shuffle_partitions: int = 8, app: str = "cvforge") -> SparkSession:
    """A session for tests and the bench. On a cluster, use the cluster's own session."""
    return (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        # superseded round states are removed from the checkpoint folder once unreferenced
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the folder must be set by the cluster (a shared filesystem).
    Only in local mode, when nothing is set, a fresh scratch folder is created.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; set it to a shared folder before running on a cluster"
        )
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="cvforge-ckpt-"))
    return sc.getCheckpointDir()


def reliable_checkpoint(df, eager: bool = True):
    """Cut lineage by writing ``df`` to the shared checkpoint folder (survives executor loss)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)


def write_shared(df, name: str):
    """Write ``df`` as Parquet under the shared checkpoint folder and read it back.

    Cuts lineage like a checkpoint, but later scans prune columns and push filters down.
    The folder belongs to this application's checkpoint folder and holds disposable data.
    """
    path = f"{checkpoint_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shared_root(spark: SparkSession) -> str:
    """The shared folder itself, above this application's part of it: for what another run takes up."""
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    return (configured or checkpoint_dir(spark).rstrip("/").rpartition("/")[0]).rstrip("/")
