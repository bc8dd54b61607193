"""Session settings and the shared folder for tables that cut lineage."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh path under the folder that all executors share.

    The cluster names it in ``spark.checkpoint.dir``. Only where that is unset
    and the master is local (tests) a temporary folder is used instead.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="cadenza-")
        spark.conf.set("spark.checkpoint.dir", root)
    path = f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _MADE.append(path)
    return path


#: Folders this process has made; they are removed when it ends, or by discard_all.
_MADE: list[str] = []


def discard(spark: SparkSession, path: str) -> None:
    """Remove a folder of the shared file system that nothing reads any more."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


@atexit.register
def discard_all() -> None:
    """Remove all folders made so far; results that were read from them are gone with them."""
    spark = SparkSession.getActiveSession()
    while _MADE:
        path = _MADE.pop()
        try:
            if spark is not None:
                discard(spark, path)
        except Exception:  # the session has ended before: the folders stay
            return


def written(df: DataFrame, name: str) -> DataFrame:
    """Write df once to the shared folder and read it back: its lineage ends there,
    so a lost executor costs no recomputation of what lies before."""
    spark = df.sparkSession
    path = shared_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
