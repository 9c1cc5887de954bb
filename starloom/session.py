"""Session settings and the shared scratch area."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
}


def session(app: str = "starloom", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir; where that is unset, one inside the warehouse, which all share too."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    return (shared or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch").rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, path: str) -> DataFrame:
    """Write `df` once to a folder that all executors share and read it back.

    Cuts the lineage in a way that outlives lost executors, and gives Catalyst real file sizes, so that
    its own size check decides whether a later join may broadcast the table.
    """
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def settle(df: DataFrame) -> DataFrame:
    """Compute `df` once, into files in the shared folder that Spark's cleaner removes when nothing refers to them.

    For what a returned plan still needs. What reads them outlives lost executors and never computes `df` again.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(scratch_root(df.sparkSession))
    return df.checkpoint()
