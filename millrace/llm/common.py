"""Helpers shared by the corpus operators: table access, lineage cuts, sizes."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: A broadcast side may hold this many bytes; beyond it every operator here has a shuffled way.
BROADCAST_BYTES = 64 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder of the cluster; a folder of our own only in local mode where none is set (tests)."""
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
        if not named and not sc.master.split("[")[0] == "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        if not named:
            named = tempfile.mkdtemp(prefix="millrace-checkpoint-")
            atexit.register(shutil.rmtree, named, ignore_errors=True)
        sc.setCheckpointDir(named)
    return sc._jsc.sc().getCheckpointDir().get()


def cut(df: DataFrame) -> DataFrame:
    """Write df to the checkpoint folder once and read it from there: survives lost executors."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_key(text: Column) -> Column:
    """Tells apart rows that share an id: a row is (id, text_key); exactly repeated rows are one."""
    return F.xxhash64(text)


def keyed_rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(_key, _row) of each document: of rows that repeat id and text one stays, the first by a hash of all columns.

    A group limit before the shuffle leaves one row of a group for each task, however many repeat it.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    rows = docs.select(F.struct(F.col(id_col).alias("id"), text_key(F.col(text_col)).alias("th")).alias("_key"), row.alias("_row"))
    nth = F.row_number().over(Window.partitionBy("_key").orderBy(F.xxhash64("_row")))
    return rows.withColumn("_nth", nth).filter("_nth = 1").select("_key", "_row")


def vocabulary_dir() -> str:
    return os.environ.get("MILLRACE_TOKENIZERS", "/opt/tokenizers")


def written(df: DataFrame, name: str) -> DataFrame:
    """df written as Parquet in the shared folder, and read from there."""
    path = f"{checkpoint_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
