"""Session construction with the settings the analyses assume."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Settings every analysis relies on.  Timestamps in the inputs are
# TIMESTAMP_NTZ, so the session zone only matters for literals; UTC keeps
# the oracle comparison stable.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    # checkpointed data is removed once unreferenced
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # Python call-site capture for error messages costs several JVM round
    # trips per Column function; plans here are built from hundreds of them
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def get_session(master: str | None = None, app_name: str = "storelens",
                shuffle_partitions: int | None = None,
                extra_conf: dict[str, str] | None = None) -> SparkSession:
    """Build (or reuse) a session with the library defaults.

    Without ``master`` the one that is configured holds (``spark-submit --master``,
    ``spark-defaults.conf``); where none is, Spark itself takes ``local[*]``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra_conf or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
