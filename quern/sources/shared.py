"""The folder that driver and executors share, and places in it for one run."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The session's checkpoint folder. Only where all run in one process may the session have none."""
    context = spark.sparkContext._jsc.sc()
    if not context.getCheckpointDir().isDefined():
        at = spark.conf.get("spark.checkpoint.dir", None)
        if not at and not context.isLocal():
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir(at or tempfile.mkdtemp(prefix="quern-"))
    return context.getCheckpointDir().get()


def scratch(spark: SparkSession, what: str) -> str:
    """A new path in the shared folder, removed when the session's process ends."""
    at = f"{shared_folder(spark)}/{what}-{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(at)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(path)
    files.deleteOnExit(path)
    return at


def kept_folder(spark: SparkSession, what: str, key: str) -> str:
    """The path in the shared folder for what is derived from ``key``: the same for every call of an application, removed when its process ends."""
    at = f"{shared_folder(spark)}/{what}-{uuid.uuid5(uuid.NAMESPACE_URL, key).hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(at)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(path)
    files.deleteOnExit(path)
    return at


def written(df: DataFrame, what: str = "step") -> DataFrame:
    """``df`` written as Parquet to the shared folder and read again: computed once, and it outlives executors. :func:`dropped` removes it, or the end of the process."""
    at = f"{scratch(df.sparkSession, what)}/rows"
    df.write.parquet(at)
    return df.sparkSession.read.schema(df.schema).parquet(at)


def dropped(*tables: DataFrame) -> None:
    """Removes what :func:`written` wrote for these."""
    for df in tables:
        for at in {f.rpartition("/rows/")[0] for f in df.inputFiles()}:
            path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(at)
            path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)
