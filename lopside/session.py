"""Session settings and the one place that cuts lineage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "lopside", master: str | None = None, **conf) -> SparkSession:
    """A session with AQE, skew-join handling and UTC; keyword settings win.

    Setting names are written with ``__`` for the dots:
    ``build_session(spark__sql__shuffle__partitions=8)``.
    """
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    settings.update({k.replace("__", "."): str(v) for k, v in conf.items()})
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, named by ``spark.checkpoint.dir``."""
    context = spark.sparkContext
    folder = context.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def durable(df: DataFrame) -> DataFrame:
    """Compute ``df`` once and keep it in the shared folder.

    Used where one table feeds several later passes. A reliable checkpoint
    survives the loss of executors and gives every pass the same rows.
    """
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def buckets_for(spark: SparkSession) -> int:
    """How many ranges a sorted pass of moderate size is cut into; large ones go by their rows."""
    return max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))
