"""Durable cuts of a plan: intermediate results in the folder that driver and executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """A new folder name below ``spark.checkpoint.dir``. Where it is unset, a session on one machine, as in tests, uses
    /tmp; on a cluster that is an error, since no machine's own folder is shared."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = "/tmp/checkpoints"
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(base)
    return f"{base.rstrip('/')}/{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """Write and reread: the plan starts anew here, and a lost executor costs no earlier work."""
    spark, path = df.sparkSession, shared_dir(df.sparkSession)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def forget(df: DataFrame) -> None:
    """Remove the folders of cuts, or a union of cuts, that nothing reads any more."""
    jvm, conf = df.sparkSession.sparkContext._jvm, df.sparkSession.sparkContext._jsc.hadoopConfiguration()
    for name in {file.rpartition("/")[0] for file in df.inputFiles()}:
        folder = jvm.org.apache.hadoop.fs.Path(name)
        folder.getFileSystem(conf).delete(folder, True)
