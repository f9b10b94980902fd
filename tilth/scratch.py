"""Tables written once in the shared scratch folder to cut lineage.

The folder is ``spark.checkpoint.dir``, which every executor and the driver
must be able to reach.  All tables of an application are in one folder below it, which is deleted when the application's JVM
ends; tables that a later round replaces are deleted at once.  Only a local session that leaves it unset gets a
temporary folder of its own; a cluster session without it is an error.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL: dict[str, str] = {}
#: Folders that are deleted at the end.
_LEFT: set[str] = set()


def scratch_root(spark: SparkSession) -> str:
    """The URI of the shared folder, without a trailing slash."""
    conf = spark.sparkContext.getConf()
    root = conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL:
        _LOCAL[app] = tempfile.mkdtemp(prefix="spark-scratch-")
        atexit.register(shutil.rmtree, _LOCAL[app], ignore_errors=True)
    return _LOCAL[app]


def scratch_path(spark: SparkSession, tag: str) -> str:
    """A fresh path under the application's part of the shared folder; nothing is created yet."""
    folder = f"{scratch_root(spark)}/tilth-{spark.sparkContext.applicationId}"
    if folder not in _LEFT:
        jvm = spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(folder)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(p)
        _LEFT.add(folder)
    return f"{folder}/{tag}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    The result no longer depends on what made it, so a lost executor costs a
    reread and not a recomputation.
    """
    spark = df.sparkSession
    path = scratch_path(spark, tag)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.scratch = path
    return out


def replaced(old: DataFrame, df: DataFrame, tag: str) -> DataFrame:
    """``materialize(df, tag)``, and the table ``old`` that it was made from is deleted.

    For rounds, each of which needs the one before only.
    """
    out = materialize(df, tag)
    discard(old.sparkSession, old.scratch)
    return out


def discard(spark: SparkSession, path: str) -> None:
    """Delete one scratch path through Hadoop's file system API."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
