"""Where intermediate tables go."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the session names; without one, a folder below the warehouse."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    return (root or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints").rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder name below the shared folder."""
    return f"{checkpoint_root(spark)}/lawtree/{name}-{uuid.uuid4().hex}"


def checkpointed(df):
    """Write ``df`` to the shared folder and read it back, so that its lineage ends there."""
    path = scratch_path(df.sparkSession, "cut")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
