"""Tables written once and read by several jobs, in the folder that driver and executors share."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The session's ``spark.checkpoint.dir``.

    Where none is set, a session on one machine (as in tests) takes a folder of its own
    until it ends; a cluster has to name one.
    """
    conf = spark.sparkContext.getConf()
    folder = spark.conf.get("spark.checkpoint.dir", None) or conf.get("spark.checkpoint.dir", None)
    if not folder:
        master = spark.sparkContext.master or ""
        if master != "local" and not master.startswith("local["):
            raise ValueError("spark.checkpoint.dir has to name a folder that driver and executors share")
        folder = tempfile.mkdtemp(prefix="spark-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def written(df: DataFrame, name: str, *partitions: str) -> DataFrame:
    """``df`` as a table written once in the shared folder and read back."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.partitionBy(*partitions).parquet(path)
    out = spark.read.schema(df.schema).parquet(path).select(*df.columns)
    out.written_to = path
    return out


def discard(*tables: DataFrame) -> None:
    """Deletes what `written` made of the tables, none of which is read any more."""
    for df in tables:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df.written_to)
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def file_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of all files under the path."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(at).getLength()


def file_stamp(spark: SparkSession, *paths: str) -> str:
    """Names, lengths and times of all files under the paths, as one text; a path that isn't there is an error."""
    found = []
    for p in paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(p)
        files = path.getFileSystem(spark._jsc.hadoopConfiguration()).listFiles(path, True)
        while files.hasNext():
            s = files.next()
            found.append(f"{s.getPath()}:{s.getLen()}:{s.getModificationTime()}")
    return ";".join(sorted(found))
