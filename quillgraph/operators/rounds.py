"""Tables that iterations write, so that a round doesn't hang on all before it."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own: list[str] = []


def new_folder(spark: SparkSession) -> str:
    """The path of a new folder below that of spark.checkpoint.dir. Where that is unset, a local session has a temporary
    folder; on a cluster, whose executors don't share one, it is an error. The folder goes when the driver ends."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder and not spark.sparkContext.master.startswith("local["):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    if not folder:
        _own[:] = _own or [tempfile.mkdtemp(prefix="quillgraph-")]
        folder = "file://" + _own[0]
    path = f"{folder.rstrip('/')}/rounds/{uuid.uuid4().hex}"
    made = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = made.getFileSystem(spark._jsc.hadoopConfiguration())
    system.mkdirs(made)
    system.deleteOnExit(made)
    return path


def settle(df: DataFrame) -> DataFrame:
    """Cut the lineage of an iteration: a table in a new folder."""
    spark = df.sparkSession
    path = new_folder(spark)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete a settled table that nothing reads any more."""
    spark = df.sparkSession
    for name in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if "/rounds/" in name:
            path = spark._jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
