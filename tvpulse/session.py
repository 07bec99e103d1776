"""SparkSession construction and the shared checkpoint folder."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.caseSensitive": "false",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def cluster_conf(shuffle_partitions: int = 8000) -> dict:
    """Settings for the large-cluster case (about 100 TB of logs).

    Start with many shuffle partitions and let AQE coalesce them to about
    256 MB each; split scans at 256 MB; let AQE split skewed join partitions
    and turn joins into broadcasts only for sides measured under 64 MB at
    runtime. Pass as ``get_session(conf=cluster_conf())``."""
    return {
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64m",
        "spark.sql.files.maxPartitionBytes": "256m",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
        "spark.sql.autoBroadcastJoinThreshold": "10m",
        "spark.sql.parquet.aggregatePushdown": "true",
    }


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "tvpulse", conf: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the engine's defaults.

    On a cluster leave ``master`` unset and size ``shuffle_partitions`` to the
    data (AQE coalesces small ones); tests pass ``local[*]`` and 8.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULT_CONF)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, registering it with the context.

    The cluster names it in ``spark.checkpoint.dir``; only when that is unset
    (local tests) a scratch folder is created and recorded in the session.
    """
    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) \
        or spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="tvpulse-ckpt-")
        spark.conf.set("spark.checkpoint.dir", configured)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(configured)
    return configured


def output_dir(spark: SparkSession) -> str:
    """Shared folder for written tables and the model registry.

    ``tvpulse.output.dir`` when the deployment sets it, else a folder under
    the shared checkpoint directory (never a machine-local path on a cluster).
    """
    configured = spark.conf.get("tvpulse.output.dir", None)
    if configured:
        return configured.rstrip("/")
    return checkpoint_dir(spark).rstrip("/") + "/tvpulse-output"
