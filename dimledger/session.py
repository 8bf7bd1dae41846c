"""Session construction and cluster-owned settings."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

# Settings every query in this package is written against. AQE re-plans joins
# from runtime sizes (the size check behind broadcast), splits skewed shuffle
# partitions and coalesces small ones.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    "spark.ui.enabled": "false",
    # PySpark 4 records the Python call site of every Column function for
    # error messages, several JVM round trips each; plans here are built from
    # hundreds of expressions, so that costs seconds of driver time per query.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(master: str | None = None, app: str = "dimledger",
                  shuffle_partitions: int | None = None,
                  conf: dict[str, str] | None = None) -> SparkSession:
    """Create (or reuse) a session with the package defaults.

    ``master`` is left to ``spark-submit`` when not given. On a cluster the
    shuffle partition count should follow the data size (≈128-256 MB per
    partition after AQE coalescing), so it is only set when asked for.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULT_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()


def checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """Shared folder for lineage cuts and intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``; that value always wins.
    ``fallback`` is only used where the setting is absent (local tests), and
    is then registered so ``DataFrame.checkpoint()`` writes there too.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        configured = spark.sparkContext.getCheckpointDir()
    if configured:
        return configured
    if fallback is None:
        raise RuntimeError("spark.checkpoint.dir is not set and no fallback was given")
    os.makedirs(fallback, exist_ok=True)
    spark.sparkContext.setCheckpointDir(fallback)
    return fallback
