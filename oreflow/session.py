"""Session settings the layers rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # One key may hold a third of a fact table: let AQE split it in joins even
    # where that costs one more shuffle afterwards.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # ``ds`` is a string everywhere; partition discovery must not make it a date.
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    # Session windows are merged inside each task before the shuffle.
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
}


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else has built."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def build_session(
    app_name: str = "oreflow",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    **extra: str,
) -> SparkSession:
    """A session for jobs and tests.

    On a cluster leave ``master`` and ``shuffle_partitions`` unset: both come
    from the deployment. AQE coalesces a generous shuffle width on its own.
    """
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in {**RUNTIME_SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for stream progress: ``spark.checkpoint.dir`` of the session.

    There is no other choice: progress in a folder made up here would be lost
    at the next start, and everything would land twice.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return configured
