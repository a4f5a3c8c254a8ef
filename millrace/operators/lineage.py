"""Cutting lineage in a folder that all executors share, and sizes of what may be broadcast."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A broadcast side may hold this many bytes; beyond it every operator has a shuffled way.
BROADCAST_BYTES = 64 << 20


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder of the cluster; a folder of our own only in local mode where none is set (tests)."""
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
        if not named:
            if sc.master.split("[")[0] != "local":
                raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
            named = tempfile.mkdtemp(prefix="millrace-checkpoint-")
            atexit.register(shutil.rmtree, named, ignore_errors=True)
        sc.setCheckpointDir(named)
    return sc._jsc.sc().getCheckpointDir().get()


def cut(df: DataFrame) -> DataFrame:
    """Write df to the checkpoint folder once and read it from there: survives lost executors."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def new_folder(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing uses yet."""
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def small(df: DataFrame, row_bytes: int) -> DataFrame:
    """df, written once, and broadcast where its checked size allows."""
    df = cut(df)
    return F.broadcast(df) if df.count() * row_bytes <= BROADCAST_BYTES else df
