"""Session construction for tests and the bench, and the shared scratch location."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "sigscore", extra: dict | None = None) -> SparkSession:
    """A local session with AQE on, UI off and UTC timestamps (tests and bench only)."""
    builder = (SparkSession.builder.master(master).appName(app_name)
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.sql.adaptive.enabled", "true")
               .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
               .config("spark.sql.adaptive.skewJoin.enabled", "true")
               .config("spark.sql.session.timeZone", "UTC")
               .config("spark.sql.execution.arrow.pyspark.enabled", "true")
               .config("spark.driver.memory", "16g"))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for written intermediate tables.

    Taken from ``spark.checkpoint.dir`` (the cluster's shared checkpoint location). Only when the
    session names none do we fall back to a folder under the session's warehouse, which is
    shared storage on a cluster as well, and register it as the checkpoint dir.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    context = _context(spark)
    if not root and context is not None:
        root = context.getCheckpointDir()
    if not root:
        root = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_sigscore_scratch"
        if context is not None:
            context.setCheckpointDir(root)
    return root.rstrip("/")


def _context(spark: SparkSession):
    """The SparkContext, or None on a session without one (Spark Connect)."""
    try:
        return spark.sparkContext
    except Exception:  # a Connect session has no SparkContext
        return None


def default_parallelism(spark: SparkSession) -> int:
    """The session's default task parallelism."""
    context = _context(spark)
    if context is not None:
        return context.defaultParallelism
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique location under the scratch root."""
    return f"{scratch_root(spark)}/sigscore/{name}_{uuid.uuid4().hex[:12]}"


def materialise(df, name: str):
    """Write a frame to the shared scratch folder and read it back: a cut of the lineage that
    survives lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove_folder(spark: SparkSession, path: str) -> bool:
    """Delete a folder that this library wrote; False where the session cannot (Spark Connect)."""
    if _context(spark) is None:
        return False
    jvm = spark._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(folder, True)


def unique_name(prefix: str) -> str:
    """A table or view name that no other call returns."""
    return f"{prefix}_{uuid.uuid4().hex[:12]}"


# Sizing for a large cluster run (hundreds of TB). Applied by the job's entry point only where
# the cluster configuration leaves a setting unset: ~256 MB scan splits and shuffle partitions
# (AQE coalesces the generous initial shuffle count), skew splitting for joins and for the
# rebalance before partitioned writes, and an explicit overwrite mode.
CLUSTER_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.shuffle.partitions": "4000",
    "spark.sql.sources.partitionOverwriteMode": "static",
}


def apply_cluster_defaults(spark: SparkSession,
                           defaults: dict[str, str] | None = None) -> dict[str, str]:
    """Set each default that the session does not set explicitly; return what was applied."""
    applied = {}
    for key, value in (CLUSTER_DEFAULTS if defaults is None else defaults).items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)
            applied[key] = value
    return applied
