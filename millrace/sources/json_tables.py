"""JSON and JSON lines to tables, with errors that name the line, and struct keys aligned."""

from __future__ import annotations

import json
import sys
from typing import IO

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.sources import files
from millrace.sources.sinks import write_parquet

_WRONG = "_not_an_object"


def detect_format(path: str) -> str:
    """json or jsonl, by the name, else by the first character that isn't blank."""
    low = path.lower().removesuffix(".gz")
    if low.endswith((".jsonl", ".ndjson", ".jsonlines")):
        return "jsonl"
    if low.endswith(".json"):
        return "json"
    first = SparkSession.active().read.text(path).select(F.ltrim(F.regexp_replace("value", r"[\t\r]", " ")).alias("value")).filter("value <> ''").first()
    return "json" if first is not None and first.value[0] in "[{" else "jsonl"


def read_json(spark: SparkSession, path: str) -> DataFrame:
    """A root object is a row, a root array its objects; anything else is an error. Tasks parse the files."""
    rows = spark.read.option("multiLine", "true").option("columnNameOfCorruptRecord", _WRONG).json(path)
    if _WRONG not in rows.columns:
        return rows
    rest = [c for c in rows.columns if c != _WRONG]
    if not rest or rows.filter(F.col(_WRONG).isNotNull()).limit(1).collect():
        raise ValueError(f"{path}: expected an object or an array of objects")
    return rows.drop(_WRONG)


def read_jsonl(spark: SparkSession, path: str) -> DataFrame:
    """Blank lines are skipped; the first bad line of the first bad file is named. Lines are checked and parsed by tasks."""
    lines = spark.read.text(path).filter("trim(value) <> ''")
    good = F.expr("try_parse_json(value)").isNotNull() & (F.substring(F.ltrim("value"), 1, 1) == "{")
    if not lines.filter(~good).isEmpty():
        _name_bad_line(spark, path, good)
    return spark.read.json(path)


def _name_bad_line(spark: SparkSession, path: str, good) -> None:
    """Raise for the first bad line; its number is counted over the blocks that tasks read."""
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"))
    bad = lines.filter((F.trim("value") != "") & ~good).orderBy("file", "block", "at").first()
    blocks = lines.filter(F.col("file") == bad.file).groupBy("block").agg(F.count("*").alias("n"), F.min("at").alias("first")).collect()
    number = sum(b.n for b in blocks if b.block < bad.block) + next(bad["at"] - b["first"] for b in blocks if b.block == bad.block) + 1
    where = f"{bad.file.removeprefix('file://')}:{number}"
    try:
        json.loads(bad.value)
    except ValueError as error:
        raise ValueError(f"{where}: {error}") from error
    raise ValueError(f"{where}: expected an object")


def read_any(spark: SparkSession, path: str, kind: str = "auto") -> DataFrame:
    kind = detect_format(path) if kind == "auto" else kind
    return {"json": read_json, "jsonl": read_jsonl}[kind](spark, path)


def read_stdin(spark: SparkSession, kind: str = "auto", stream: IO[str] | None = None) -> DataFrame:
    """JSON lines piped to the driver."""
    if kind not in ("auto", "jsonl"):
        raise ValueError("standard input is read as JSON lines")
    rows = []
    for at, line in enumerate(stream or sys.stdin, 1):
        if line.strip():
            try:
                value = json.loads(line)
            except ValueError as error:
                raise ValueError(f"<stdin>:{at}: {error}") from error
            if not isinstance(value, dict):
                raise ValueError(f"<stdin>:{at}: expected an object")
            rows.append(line)
    return spark.read.json(spark.sparkContext.parallelize(rows))


def convert(spark: SparkSession, source: str, target: str, compression: str = "snappy", rows_per_file: int | None = None, index: str | None = None) -> None:
    """A JSON file as Parquet; see sinks.write_parquet."""
    if not files.exists(source):
        raise FileNotFoundError(source)
    write_parquet(read_any(spark, source), target, compression, rows_per_file, index)
