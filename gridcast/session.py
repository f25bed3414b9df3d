"""Session settings and the one way gridcast cuts lineage."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def utc_session(spark: SparkSession) -> SparkSession:
    """All timestamps are UTC instants, so the session zone must be UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


# fixed values: settings that must be chosen when the session is built
BUILD_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    # Recording a Python call site per column expression costs several round
    # trips to the JVM each, which shows in plans of hundreds of columns.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def shared_folder(spark: SparkSession) -> str:
    """The folder that the driver and all executors share: spark.checkpoint.dir.

    Only where it is unset and the master is local does this choose one.
    """
    context = spark.sparkContext
    shared = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if shared is None:
        shared = context.getCheckpointDir()
    if shared is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        shared = tempfile.mkdtemp(prefix="gridcast-checkpoint-")
        context.setCheckpointDir(shared)
    return shared


def _checkpoint_dir(spark: SparkSession) -> None:
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))


def settle(df: DataFrame) -> DataFrame:
    """Write `df` once to the checkpoint folder and continue from the copy.

    Used where a result far smaller than its input is read more than once, so
    the input is scanned once. The copy outlives lost executors.
    """
    _checkpoint_dir(df.sparkSession)
    return df.checkpoint()
