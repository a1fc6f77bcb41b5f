"""Intermediate results of a run on storage that the cluster shares."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from tallyboard.errors import TallyError


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path that all tasks see. Without ``spark.checkpoint.dir`` only a
    local session has one."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise TallyError("set spark.checkpoint.dir to a folder that the cluster shares")
        folder = "file://" + tempfile.mkdtemp(prefix="run-")
    return f"{folder.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(rows: DataFrame, name: str) -> DataFrame:
    """``rows``, written once to storage that the cluster shares and read back,
    for results that look at them several times. The table goes when the
    process ends."""
    spark = rows.sparkSession
    path = shared_path(spark, name)
    rows.write.parquet(path)
    atexit.register(_delete_at_exit, spark, path)
    return spark.read.schema(rows.schema).parquet(path)


def _delete_at_exit(spark: SparkSession, path: str) -> None:
    try:
        delete(spark, path)
    except Exception:  # the session may be gone by then
        return


def _located(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())


def delete(spark: SparkSession, path: str) -> None:
    folder, system = _located(spark, path)
    system.delete(folder, True)


def is_complete(spark: SparkSession, path: str) -> bool:
    """Whether Spark has marked a folder as written with all its files."""
    marker, system = _located(spark, f"{path}/_SUCCESS")
    return system.exists(marker)


def child_folders(spark: SparkSession, path: str) -> list[str]:
    folder, system = _located(spark, path)
    return [s.getPath().getName() for s in system.listStatus(folder) if s.isDirectory()]


class Scratch:
    """A folder of one run, in ``spark.checkpoint.dir`` or else under the output
    folder, removed when the run ends. What is kept there is read back, so that
    neither its many uses nor a lost executor cause the extract to be read again.
    """

    def __init__(self, spark: SparkSession, out: str):
        self.spark = spark
        self.path = f"{spark.conf.get('spark.checkpoint.dir', None) or out}/_run-{uuid.uuid4().hex}"

    def keep(self, data: DataFrame, name: str) -> DataFrame:
        # By position: filter columns may differ in case alone, which files cannot.
        stored = data.toDF(*(f"c{i}" for i in range(len(data.columns))))
        stored.write.parquet(f"{self.path}/{name}")
        return self.spark.read.schema(stored.schema).parquet(f"{self.path}/{name}").toDF(*data.columns)

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *problem) -> None:
        delete(self.spark, self.path)
