"""Resuming interrupted generation: what is done, what is left, and back-filling results."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions import text as t
from millrace.functions.cot import is_error


def left_to_do(rows: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Rows whose md5(key) isn't among the finished ones."""
    digest = lambda: F.md5(F.col(key).cast("string").cast("binary"))
    return rows.withColumn("_key", digest()).join(done.select(digest().alias("_key")).distinct(), "_key", "left_anti").drop("_key")


def backfill(rows: DataFrame, finished: DataFrame, key: str, column: str) -> DataFrame:
    """rows with the column of the finished ones, where there is one."""
    known = finished.select(F.col(key), F.col(column).alias("_new"))
    old = F.col(column) if column in rows.columns else F.lit(None).cast(finished.schema[column].dataType)
    return rows.join(known, key, "left").withColumn(column, F.coalesce("_new", old)).drop("_new")


def pending(rows: DataFrame, column: str = "cot_content") -> DataFrame:
    """Rows without text; an error text counts as done until it is removed."""
    return rows.filter(t.safe(F.col(column)) == "")


def without_errors(rows: DataFrame, column: str = "cot_content") -> DataFrame:
    return rows.filter(~is_error(F.col(column)))
