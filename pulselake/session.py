"""Session settings and the shared folder for staged data."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Session settings the operators rely on.
REQUIRED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Lets a join on (device_id, event_date) reuse a partitioning on device_id alone.
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
}


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the operators rely on to an existing session."""
    for key, value in REQUIRED.items():
        spark.conf.set(key, value)
    return spark


def build_session(name: str = "pulselake", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return prepare(builder.getOrCreate())


def shared_dir(spark: SparkSession) -> str:
    """Root for staged tables: ``spark.checkpoint.dir`` of the session.

    Only where the session names none and runs on one machine a temporary folder is made.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    require_local(spark.sparkContext.master)
    root = tempfile.mkdtemp(prefix="pulselake-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def require_local(master: str) -> None:
    """Refuse a folder of one machine where executors run on others."""
    if not re.fullmatch(r"local(\[[^\]]*\])?", master):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/pulselake/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str) -> DataFrame:
    """The frame written to the shared folder and read back.

    For a frame that feeds several branches of a plan: it is computed once, its lineage ends,
    and the planner knows its size.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession, path: str) -> None:
    """Delete a staged table that nothing reads any more."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop_path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    fs.delete(hadoop_path, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists, on whichever file system it names."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop_path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    return fs.exists(hadoop_path)
