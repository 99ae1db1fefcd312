"""The shared folder for checkpoints and hand-over tables."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Only a local session without the setting gets a folder of its own, which
    goes when the session's process ends; a cluster must name one that all its
    machines see.
    """
    sc = spark.sparkContext
    named = spark.conf.get(SETTING, None) or sc.getConf().get(SETTING) or sc.getCheckpointDir()
    if named:
        return named
    if not sc.master.startswith("local"):
        raise ValueError(f"set {SETTING} to a folder that all executors can reach")
    own = tempfile.mkdtemp(prefix="vacantia-")
    atexit.register(shutil.rmtree, own, ignore_errors=True)
    sc.setCheckpointDir(own)
    return sc.getCheckpointDir()


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def settle(df: DataFrame) -> DataFrame:
    """Compute once: write the table to the shared folder and read it back, which cuts the lineage."""
    path = new_path(df.sparkSession, "settled")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def settle_partitions(df: DataFrame) -> DataFrame:
    """Like ``settle``, by a reliable checkpoint that keeps partitions and their order."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return df.checkpoint()
