"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def configure(spark: SparkSession) -> SparkSession:
    """Settings every job relies on: UTC days, string partition keys, splitting of skewed joins."""
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.sources.partitionColumnTypeInference.enabled", "false")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a scratch folder only in local mode."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
    scratch = tempfile.mkdtemp(prefix="folioforge-")
    spark.sparkContext.setCheckpointDir(scratch)
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def work_path(spark: SparkSession, label: str) -> str:
    """A path no other run uses, inside the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write once, read back: cuts lineage and fixes the rows for every later use.

    A written table, unlike a cached one, survives the loss of executors.
    """
    path = work_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
