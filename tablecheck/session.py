"""Session defaults and the shared staging folder."""

from __future__ import annotations

import uuid
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
#: Where the frames that `pin` returned are staged.
_staged: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


def build_session(app_name: str = "tablecheck", master: str | None = None, **conf: str) -> SparkSession:
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def staging_root(spark: SparkSession) -> str:
    """This application's folder in storage that all executors share: below the checkpoint folder
    that the cluster names, else the one that is set, else the warehouse folder, which is local if the
    warehouse is: a cluster must name one of the two in storage that its executors share."""
    context = spark.sparkContext
    root = spark.conf.get(CHECKPOINT_CONF, None) or context.getCheckpointDir()
    if not root:
        root = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_staging"
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(root)
    return f"{root.rstrip('/')}/tablecheck-{context.applicationId}"


def staging_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder; no two calls get the same one."""
    return f"{staging_root(spark)}/{name}-{uuid.uuid4().hex}"


def drop_staged(spark: SparkSession) -> bool:
    """Deletes all tables that this application has staged; frames that read them are void."""
    return delete_path(spark, staging_root(spark))


def delete_path(spark: SparkSession, name: str) -> bool:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def discard(*frames: DataFrame) -> None:
    """Deletes what `pin` has written for these frames, which nothing may read any more."""
    for frame in frames:
        path = _staged.pop(frame, None)
        if path:
            delete_path(frame.sparkSession, path)


def pin(df: DataFrame, name: str = "stage", by: str | None = None) -> DataFrame:
    """Writes the rows as a table in the shared folder and reads them back.

    This cuts the lineage, lets every later reader see the same rows whatever
    executors are lost, and unlike a checkpoint it can be read column by column. Rows are in a folder
    for each value of `by`, so a reader of one value reads no other."""
    spark = df.sparkSession
    path = staging_path(spark, name)
    (df.write.partitionBy(by) if by else df.write).parquet(path)
    held = spark.read.schema(df.schema).parquet(path)
    _staged[held] = path
    return held
