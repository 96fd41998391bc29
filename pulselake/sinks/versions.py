"""A small table kept as whole versions, one for each micro-batch of a stream.

A version is a folder ``00000017-<batch>`` with the table as it was after that batch. A batch
that runs again after a crash finds its own label and starts from the version before it, so it
writes the same rows once more. Readers see the newest complete version.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from pulselake.session import path_exists, release

#: Versions that stay: the newest, and the one its batch starts from when it runs again.
KEPT = 2


@dataclass(frozen=True)
class Version:
    number: int
    label: str

    @property
    def folder(self) -> str:
        return f"{self.number:08d}-{self.label}"


def versions(spark: SparkSession, path: str) -> list[Version]:
    """Complete versions, oldest first; only folder names are read."""
    if not path_exists(spark, path):
        return []
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    names = [status.getPath().getName() for status in fs.listStatus(root)]
    found = [n.split("-", 1) for n in names if path_exists(spark, f"{path}/{n}/_SUCCESS")]
    return sorted((Version(int(n), label) for n, label in found), key=lambda v: v.number)


def batch_label(spark: SparkSession, batch_id: int) -> str:
    """Name of a micro-batch: the id its checkpoint gave the stream, and the batch's number.

    A stream that starts over with a new checkpoint has another id, so its batches are new.
    """
    stream = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
    return f"{stream or 'batch'}-{batch_id}"


def place(spark: SparkSession, path: str, label: str) -> tuple[Version | None, Version]:
    """The version a batch starts from and the one it is to write."""
    before = [v for v in versions(spark, path) if v.label != label]
    own = [v for v in versions(spark, path) if v.label == label]
    if own:
        before = [v for v in before if v.number < own[-1].number]
        return (before[-1] if before else None), own[-1]
    last = before[-1] if before else None
    return last, Version(last.number + 1 if last else 0, label)


def read_version(spark: SparkSession, path: str, version: Version | None, schema: StructType) -> DataFrame:
    if version is None:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{path}/{version.folder}")


def read_newest(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The newest complete version; empty before the first."""
    found = versions(spark, path)
    return read_version(spark, path, found[-1] if found else None, schema)


def write_version(df: DataFrame, path: str, version: Version) -> None:
    """Write one version and drop those that nothing needs any more."""
    spark = df.sparkSession
    df.write.mode("overwrite").parquet(f"{path}/{version.folder}")
    for old in versions(spark, path)[:-KEPT]:
        release(spark, f"{path}/{old.folder}")
