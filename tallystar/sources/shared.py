"""Where intermediate tables go: the shared folder that the cluster names."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    A local session without the setting gets a temporary folder of its own; a cluster
    without it is an error, since a machine-local folder would be lost with the machine.
    """
    folder = spark.conf.get(SETTING, None)
    if folder:
        return folder
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError(f"set {SETTING} to a folder that all executors can reach")
    folder = context.getCheckpointDir() or tempfile.mkdtemp(prefix="tallystar-")
    return folder


def checkpointed(df: DataFrame) -> DataFrame:
    """The rows written to the shared folder once, with partitions and order kept."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
    return df.checkpoint()


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing else uses.

    What is written there goes when the application ends, since results may be read until then.
    """
    path = f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(place)
    return path
