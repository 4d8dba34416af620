"""Where jobs put intermediate files: the shared folder the cluster or the session names, never one of their own."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach: spark.checkpoint.dir, or the session's checkpoint folder."""
    context = spark.sparkContext
    current = context.getCheckpointDir()
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if not current:
            context.setCheckpointDir(configured)
        return configured
    if current:
        return current
    raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path nobody has written to."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: later stages restart from files, not from the whole lineage."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)
