"""Session settings the operators rely on, and the shared folder for stage tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Calendar arithmetic is local-time arithmetic, so the zone is pinned; skewed
# joins are split by AQE even where that costs one more exchange; page texts are
# large, so Arrow batches towards Python are kept short; a repeated JSON key keeps its
# last value instead of failing the page.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "128KB",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "256",
    "spark.sql.variant.allowDuplicateKeys": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the run-time settings to an existing session."""
    for key, value in RUNTIME_SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def build_session(app: str = "relist", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach; named by the cluster in spark.checkpoint.dir.

    Only a local master may fall back to a temporary folder.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not root:
        root = sc.getCheckpointDir()
    if not root:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        root = tempfile.mkdtemp(prefix="relist-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder path of the shared folder."""
    return f"{shared_dir(spark)}/relist/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str, stage: str | None = None) -> DataFrame:
    """Write a stage to the shared folder and read it back.

    Cuts lineage and keeps an expensive stage from running once per consumer; the
    files outlive any executor. `stage` groups the stages of one job for release().
    """
    path = f"{stage}/{name}-{uuid.uuid4().hex}" if stage else scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(spark: SparkSession, stage: str) -> None:
    """Remove the stage tables of a finished job."""
    target = spark._jvm.org.apache.hadoop.fs.Path(stage)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
