"""Where intermediate tables go: the shared folder the cluster names."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from millrace.errors import ConfigError
from millrace.storage import qualified

CHECKPOINT_SETTING = "spark.checkpoint.dir"


def work_root(spark: SparkSession) -> str:
    """The shared scratch folder of this session.

    ``spark.checkpoint.dir`` wins, then the context's checkpoint folder. Only a local master, where driver and
    executors are one process, falls back to a fresh temporary folder.
    """
    context = spark.sparkContext
    named = spark.conf.get(CHECKPOINT_SETTING, None) or context.getConf().get(CHECKPOINT_SETTING) or context.getCheckpointDir()
    if named:
        return qualified(spark, named).rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ConfigError(f"set {CHECKPOINT_SETTING} to a folder that all executors share")
    root = "file://" + tempfile.mkdtemp(prefix="millrace-")
    spark.conf.set(CHECKPOINT_SETTING, root)
    _delete_at_exit(spark, root)
    return root


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A new, not yet existing path below the work root."""
    path = f"{work_root(spark)}/{label}-{uuid.uuid4().hex}"
    _delete_at_exit(spark, path)
    return path


def checkpointed(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared folder, so that its rows and their
    partitioning stay the same for every later use and after lost executors."""
    spark = df.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(work_root(spark) + "/checkpoints")
    return df.checkpoint(eager=True)


def _delete_at_exit(spark: SparkSession, path: str) -> None:
    context = spark.sparkContext
    hadoop_path = context._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(context._jsc.hadoopConfiguration()).deleteOnExit(hadoop_path)
