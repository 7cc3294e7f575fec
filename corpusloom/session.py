"""The folder that driver and executors share, and cutting a frame's lineage there."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder that the session names in spark.checkpoint.dir; where none is set, a temporary one in local mode (tests), else an error."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = sc.getConf().get("spark.checkpoint.dir")
        if not folder and sc.master.split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="corpusloom-"))
    return sc.getCheckpointDir()


def checkpointed(df: DataFrame) -> DataFrame:
    """df as a Parquet table in the shared folder: what follows starts from its files, whichever executors are lost, and knows its size."""
    path = f"{shared_dir(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def saved(spark: SparkSession):
    """A function that cuts a frame's lineage."""
    shared_dir(spark)
    return checkpointed
