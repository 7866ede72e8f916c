"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every session of ours wants. Shuffle partitions are left to the
# caller / cluster config: on a cluster they are sized to the data, locally
# to the cores.
_DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # MLlib iterations and RDD-level shuffles serialise with Kryo
    "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app: str = "medalla", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in _DEFAULTS.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used as
    is. Only a local-mode session without one (tests, benches) gets a fresh
    folder of its own; a cluster session without one is an error, because a
    machine-local folder would not survive the loss of an executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not re.match(r"local(\[|$)", sc.master):  # local-cluster has executors of its own
        raise RuntimeError("set spark.checkpoint.dir to a shared folder for this cluster")
    local = tempfile.mkdtemp(prefix="medalla-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir()


def scratch_root(spark: SparkSession, label: str) -> str:
    """A fresh folder under the session's (shared) checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark)}/{label}-{uuid.uuid4().hex[:12]}"


def materialize(df, label: str = "stage"):
    """Write ``df`` as a Parquet table into a fresh folder under the shared
    checkpoint folder and return it read back: the lineage stops here, the
    data survive the loss of any executor, and later readers scan compact
    columnar files instead of recomputing the plan."""
    spark = df.sparkSession
    path = scratch_root(spark, label)
    df.write.mode("overwrite").parquet(path)
    table = spark.read.schema(df.schema).parquet(path)  # known schema: no inference job
    table.scratch_path = path
    return table


def release(*tables) -> None:
    """Deletes the folders of tables that ``materialize`` returned. For those
    whose successor is written: whatever reads them later, fails."""
    for t in tables:
        path = t.sparkSession._jvm.org.apache.hadoop.fs.Path(t.scratch_path)
        path.getFileSystem(t.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
