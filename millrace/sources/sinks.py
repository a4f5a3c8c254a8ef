"""Writing tables and reports; replaced only once the new content is complete."""

from __future__ import annotations

import json
import uuid
from typing import Any

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators.lineage import cut
from millrace.operators.mixture import chunks, free_name
from millrace.sources import files


def codec(name: str | None) -> str:
    return "none" if name in (None, "none", "null") else name


def with_index(df: DataFrame, order: str, name: str = "__index_level_0__") -> DataFrame:
    """The row number in the order's sequence, from 0; ties by a hash of the row. Ranges are numbered by tasks of their own."""
    tie = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    ranges = df.select(row.alias("row"), F.col(f"`{order}`").alias("key"), tie.alias("tie")).repartitionByRange("key", "tie").sortWithinPartitions("key", "tie")
    rows = cut(ranges.select("row", F.monotonically_increasing_id().alias("at")))  # written: both uses below see the same ranges
    part = F.shiftrightunsigned("at", 33)
    sizes = rows.groupBy(part.alias("part")).agg(F.count("*").alias("n"))  # a row for each range
    before = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rows = rows.withColumn("part", part).join(F.broadcast(sizes.select("part", before.alias("before"))), "part")
    number = F.col("before") + F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
    return rows.select(*[F.col("row").getField(c).alias(c) for c in df.columns], number.alias(name))


def write_parquet(df: DataFrame, path: str, compression: str | None = "snappy", rows_per_file: int | None = None, index: str | None = None) -> None:
    """A folder of Parquet files under one schema, at most rows_per_file rows each; it takes the place of path when done."""
    df = with_index(df, index) if index else df
    writer = df.write.option("compression", codec(compression))
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    stage = f"{path.rstrip('/')}.{uuid.uuid4().hex}.tmp"
    writer.parquet(stage)
    swap(stage, path)


def write_chunks(df: DataFrame, path: str, size: int, key: str, seed: int = 42) -> None:
    """A file for each chunk of `size` rows in hash order, whole and alone in it: all chunks but the last are full, and the last ends its task."""
    numbered = chunks(df, size, key, seed, name := free_name(df))
    rows = numbered.repartition(name).sortWithinPartitions(name).drop(name)
    stage = f"{path.rstrip('/')}.{uuid.uuid4().hex}.tmp"
    rows.write.option("maxRecordsPerFile", size).parquet(stage)
    swap(stage, path)


def swap(new: str, path: str) -> None:
    """new in the place of path; what was there goes last."""
    old = f"{path.rstrip('/')}.{uuid.uuid4().hex}.old"
    there = files.exists(path)
    if there:
        files.move(path, old)
    files.move(new, path)
    if there:
        files.remove(old)


def write_json(report: dict[str, Any], path: str) -> None:
    stage = f"{path}.{uuid.uuid4().hex}.tmp"
    files.write_text(stage, json.dumps(report, indent=2, ensure_ascii=False))
    swap(stage, path)


def write_jsonl(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def append_jsonl(df: DataFrame, path: str) -> None:
    """Lines after those that are there; a batch becomes visible whole, so writers need no lock."""
    df.write.mode("append").json(path)


def push(df: DataFrame, root: str, name: str, config: str = "default", revision: str = "main") -> str:
    """A dataset under its name, configuration and revision; the folder is its address."""
    path = f"{root}/{name}/config={config}/revision={revision}"
    files.make_folder(path.rpartition("/")[0])
    write_parquet(df, path)
    return path
